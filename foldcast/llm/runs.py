"""Periodic runs of words, found by block convolution.

A run is a longest stretch of words that repeats with a smallest period of q words, at least
``COPIES * q`` and at least ``LEAST`` words long. At scale L (8, 16, 32, ...) the words are cut
into blocks of L. A run whose period is from L up to 2 L holds a whole block that occurs again one
period later: the run less one period has at least 2 L - 1 words. The first scale covers all
periods below 16 in the same way, as every run has ``LEAST`` words. So for every block the sum of
squared differences to each place of its following window is worked out modulo a prime by a
number-theoretic transform; it is zero wherever the block occurs. The distances are seeds:
neighbouring blocks with one distance are one stretch, which is lengthened word by word at both
ends, by less than a block. A stretch that is long enough is checked word by word, so a sum that
is a multiple of the prime does no harm. Blocks with a word that does not come again within the
window cannot occur there and are left out.

A stretch of period d inside a run of a smaller period is that run's own. Scales go upwards, so
smaller periods are known, and seeds that lie in their runs are dropped before they are lengthened.

Texts of a batch are one sequence with a mark between them that equals nothing; memory grows with
``words.CHUNK_BYTES`` and with the longest text.

Defined results: a NULL, empty or wordless text has no runs and collapses to the empty text;
repeated rows give the same; an empty table gives no rows. Input columns named like an output
column are replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from foldcast.llm.scratch import aside
from foldcast.llm.words import chunks, coded, split, text_of

LEAST, COPIES = 24, 3
#: Words of the smallest block; its distances are all below twice that.
FIRST = 8
#: A prime with roots of unity of every power of two up to 2 ** 23, and a generator.
PRIME, GENERATOR = 998_244_353, 3
#: Numbers that are transformed or compared at once.
CELLS = 1 << 18
RUN = "array<struct<start: long, length: long, period: long>>"


@functools.cache
def _roots(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half."""
    root = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    powers = np.ones(half, np.uint64)
    step, known = root, 1
    while known < half:
        powers[known:2 * known] = powers[:known] * np.uint64(step) % PRIME
        step, known = step * step % PRIME, 2 * known
    return powers


def forward(rows: np.ndarray) -> np.ndarray:
    """Transform of every row; its terms are in bit-reversed order."""
    count, size = rows.shape
    half = size // 2
    while half:
        pairs = rows.reshape(count, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1]
        rows = np.stack([(a + b) % PRIME, (a + (PRIME - b)) * _roots(half, False) % PRIME], 2)
        half //= 2
    return rows.reshape(count, size)


def backward(rows: np.ndarray) -> np.ndarray:
    """The rows whose transforms, in bit-reversed order, are given."""
    count, size = rows.shape
    half = 1
    while half < size:
        pairs = rows.reshape(count, -1, 2, half)
        a, b = pairs[:, :, 0], pairs[:, :, 1] * _roots(half, True) % PRIME
        rows = np.stack([(a + b) % PRIME, (a + (PRIME - b)) % PRIME], 2)
        half *= 2
    return rows.reshape(count, size) * np.uint64(pow(size, PRIME - 2, PRIME)) % PRIME


def matches(blocks: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Block and place of every occurrence of a row of ``blocks`` in its row of ``windows``, and
    of places whose sum of squared differences is a multiple of the prime."""
    count, length = blocks.shape
    width = windows.shape[1]
    size = 1 << (width - 1).bit_length()
    turned = np.zeros((count, size), np.uint64)
    turned[:, -np.arange(length) % size] = blocks
    padded = np.zeros((count, size), np.uint64)
    padded[:, :width] = windows
    product = backward(forward(turned) * forward(padded) % PRIME)
    places = width - length + 1
    squares = np.zeros((count, width + 1), np.uint64)
    np.cumsum(windows * windows % PRIME, axis=1, out=squares[:, 1:])
    own = (blocks * blocks % PRIME).sum(1)
    both = own[:, None] + squares[:, length:] - squares[:, :places]
    return np.nonzero(both % PRIME == 2 * product[:, :places] % PRIME)


def _next(codes: np.ndarray) -> np.ndarray:
    """Distance from every word to its next occurrence; the length of the sequence if none."""
    order = np.argsort(codes, kind="stable")
    out = np.full(len(codes), len(codes), np.int64)
    same = codes[order[1:]] == codes[order[:-1]]
    out[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return out


def _seeds(codes: np.ndarray, ends: np.ndarray, after: np.ndarray, reach: np.ndarray, scale: int,
           ) -> tuple[np.ndarray, np.ndarray]:
    """Blocks of ``scale`` words and the distances at which they occur again, by distance."""
    least, most = (1, 2 * scale - 1) if scale == FIRST else (scale, 2 * scale - 1)
    count = len(codes) // scale
    first = np.arange(count) * scale
    text = np.searchsorted(ends, first, side="right")
    starts = np.concatenate([[0], ends[:-1] + 1])
    fits = (first + scale <= ends[text]) & (ends[text] - starts[text] >= max(LEAST, COPIES * least))
    fits &= after[:count * scale].reshape(count, scale).max(1) <= most
    fits &= reach[first] < first + most + scale
    chosen = np.flatnonzero(fits)
    values = np.concatenate([codes, np.zeros(2 * most + scale, codes.dtype)]).astype(np.uint64) % PRIME
    width = scale + most - least
    step = max(1, CELLS // (1 << (width - 1).bit_length()))
    blocks, distances = [], []
    for low in range(0, len(chosen), step):
        own = chosen[low:low + step]
        at = own[:, None] * scale
        block, place = matches(values[at + np.arange(scale)], values[at + least + np.arange(width)])
        blocks.append(own[block])
        distances.append(place + least)
    block = np.concatenate(blocks) if blocks else np.empty(0, np.int64)
    distance = np.concatenate(distances) if distances else np.empty(0, np.int64)
    order = np.lexsort((block, distance))
    return block[order], distance[order]


def _lengthen(codes: np.ndarray, first: np.ndarray, last: np.ndarray, distance: np.ndarray,
              scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches ``first`` to ``last`` (past its end) in which words ``distance`` apart are equal,
    as far as they go; less than a block is missing at either end."""
    first, last = first.copy(), last.copy()
    for edge, way in ((first, -1), (last, 1)):
        open_ = np.arange(len(edge))
        for _ in range(scale):
            at = edge[open_] - 1 if way < 0 else edge[open_]
            inside = (at >= 0) & (at + distance[open_] < len(codes))
            open_, at = open_[inside], at[inside]
            equal = codes[at] == codes[at + distance[open_]]
            open_ = open_[equal]
            if not len(open_):
                break
            edge[open_] += way
    return first, last


def _checked(codes: np.ndarray, first: int, last: int, distance: int) -> list[tuple[int, int, int]]:
    """The stretches between ``first`` and ``last`` that hold word by word: start, length, period."""
    # a sum that was a multiple of the prime may reach past the end
    last = min(last, len(codes) - distance)
    odd = np.flatnonzero(codes[first:last] != codes[first + distance:last + distance]) + first
    cuts = [first - 1, *odd.tolist(), last]
    return [(a + 1, b - a - 1 + distance, distance) for a, b in zip(cuts, cuts[1:])
            if b - a - 1 + distance >= max(LEAST, COPIES * distance)]


def _aligned(block: np.ndarray, distance: np.ndarray, runs: np.ndarray, scale: int) -> np.ndarray:
    """Which seeds can be of a run of that period.

    Where a block and its copy lie in two runs of one period of half a block at most, words
    ``distance`` apart stop being equal at the first end that either run has, unless both runs
    begin or both end that far apart; such a stretch is too short.
    """
    small = runs[runs[:, 2] <= scale // 2]
    out = np.ones(len(block), bool)
    if not len(small):
        return out
    small = small[np.argsort(small[:, 0], kind="stable")]
    end = small[:, 0] + small[:, 1]
    furthest = np.maximum.accumulate(np.where(end == np.maximum.accumulate(end), np.arange(len(end)), 0))

    def holder(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.searchsorted(small[:, 0], at, side="right") - 1
        run = furthest[np.maximum(place, 0)]
        return run, (place >= 0) & (end[run] >= at + scale)

    (x, within), (y, again) = holder(block * scale), holder(block * scale + distance)
    both = within & again & (small[x, 2] == small[y, 2])
    out[both] = ((small[y, 0] - small[x, 0] == distance) | (end[y] - end[x] == distance))[both]
    return out


def runs_of(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and smallest period of every run of a sequence.

    ``ends`` are the places of the marks that end the texts, whose codes equal no other.
    """
    runs = np.empty((0, 3), np.int64)
    longest = int(np.diff(np.concatenate([[-1], ends])).max()) - 1 if len(ends) else 0
    after = _next(codes)
    scale = FIRST
    while longest >= LEAST and (scale == FIRST or COPIES * scale <= longest):
        reach = _reach(len(codes), runs)
        block, distance = _seeds(codes, ends, after, reach, scale)
        # distances of the first scale may be multiples of one another, so they go one by one
        for low, high in _bounds(distance, one_by_one=scale == FIRST):
            b, d = block[low:high], distance[low:high]
            if scale == FIRST:
                reach = _reach(len(codes), runs)
            if scale > FIRST or d[0] <= FIRST:
                new = reach[b * scale] < b * scale + d + scale
                b, d = b[new], d[new]
            able = _aligned(b, d, runs, scale)
            b, d = b[able], d[able]
            if not len(b):
                continue
            head = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]) | (b[1:] != b[:-1] + 1)])
            tail = np.r_[head[1:], len(b)] - 1
            first, last = _lengthen(codes, b[head] * scale, (b[tail] + 1) * scale, d[head], scale)
            long = last - first + d[head] >= np.maximum(LEAST, COPIES * d[head])
            stretches = set(zip(first[long].tolist(), last[long].tolist(), d[head][long].tolist()))
            found = sorted({r for x in stretches for r in _checked(codes, *x)})
            if found:
                found = np.array(found, np.int64)
                runs = np.concatenate([runs, found[found[:, 0] + found[:, 1] > reach[found[:, 0]]]])
        scale *= 2
    runs = runs[np.lexsort((runs[:, 2], runs[:, 0]))]
    return runs[:, 0], runs[:, 1], runs[:, 2]


def _bounds(distance: np.ndarray, one_by_one: bool) -> list[tuple[int, int]]:
    if not one_by_one:
        return [(0, len(distance))]
    cuts = np.flatnonzero(np.diff(distance)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(distance)])) if len(distance) else []


def _reach(size: int, runs: np.ndarray) -> np.ndarray:
    """For every place, how far the known runs go that begin there or before."""
    reach = np.zeros(size, np.int64)
    np.maximum.at(reach, runs[:, 0], runs[:, 0] + runs[:, 1])
    return np.maximum.accumulate(reach)


def _marked(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Words of all texts, their offsets, and their codes with a mark of its own after each text."""
    words, offsets = split(texts)
    codes, distinct = coded(words)
    ends = offsets[1:] + np.arange(len(texts))
    whole = np.empty(len(codes) + len(texts), np.int64)
    inside = np.ones(len(whole), bool)
    inside[ends] = False
    whole[inside], whole[ends] = codes, len(distinct) + np.arange(len(texts))
    return words, offsets, whole, ends


def _found(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The runs of each text, and the text without their repeated words."""
    words, offsets, whole, ends = _marked(texts)
    starts, lengths, periods = runs_of(whole, ends)
    text = np.searchsorted(ends, starts, side="right")
    own = starts - (offsets[text] + text)
    # places without the marks
    first, last = starts - text + periods, starts - text + lengths
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, first, 1)
    np.add.at(edge, last, -1)
    keep = np.cumsum(edge)[:-1] == 0
    kept = np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(kept), words.filter(pa.array(keep)))
    counts = np.bincount(text, minlength=len(texts))
    fields = pa.StructArray.from_arrays(
        [pa.array(own), pa.array(lengths), pa.array(periods)], ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), fields)
    return runs, pc.binary_join(lists, " ")


def periodic_runs(docs: DataFrame) -> DataFrame:
    """``docs`` with the ``runs`` of ``text`` (word numbers, by start and period) and the text
    ``collapsed`` to the first period of each."""
    rows, back = aside(docs.drop("runs", "collapsed"), ["text"])
    names = rows.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                runs, collapsed = _found(text_of(part))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], runs, collapsed],
                    names=[*names, "runs", "collapsed"])

    schema = rows.limit(0).selectExpr("*", f"cast(null as {RUN}) as runs", "'' as collapsed").schema
    return back(rows.mapInArrow(run, schema), "runs", "collapsed")
