"""Near-duplicate groups by SimHash, compared in bit planes.

A text's fingerprint has a bit where over half of its shingles' hashes have it. Equal fingerprints
are one from the start. Two fingerprints that differ in at most ``RADIUS`` bits agree in all but
``RADIUS`` of any cut into parts, so each is filed under every choice of ``parts - RADIUS`` parts;
``parts`` grows with the number of fingerprints, which keeps buckets of unrelated ones small.

In a task the fingerprints of whole buckets lie in lanes, 64 to a word, one plane of words per bit.
A fingerprint is held against a word of its bucket at a time: the bit planes are added up in
carry-save counters, 64 distances at once, and a word is given up as soon as all of its lanes are
past the radius. Links of a bucket are given as a forest, never as all pairs. A bucket of more than
``BUCKET`` fingerprints is dealt out into pairs of blocks, so a task holds a bounded number of
them; each then goes to ceil(n / BUCKET) pairs.

Defined results: a NULL, empty or wordless text has the fingerprint 0, which is linked like any
other; repeated rows are of one component; a component is named by the smallest id in it (NULL if
it has none); an empty table gives no rows. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.llm.components import labels_of
from foldcast.llm.scratch import aside, kept
from foldcast.llm.words import chunks, coded, split, text_of
from foldcast.operators.joins import lookup_join

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
#: Fingerprints of one bucket that are compared in one go, and how many of them, if they are
#: unrelated, a bucket should have on average.
BUCKET, CROWD = 1 << 14, 8
#: Words of lanes that are counted at once.
CELLS = 1 << 14
TEXT_BYTES = 1 << 20


def shingle_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles of all texts, repeats included, and the offset of each text's first."""
    import xxhash

    words, offsets = split(pc.ascii_lower(texts))
    counts = np.diff(offsets)
    starts = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
    upto = np.concatenate([[0], np.cumsum(starts)])
    owner = np.repeat(np.arange(len(texts)), starts)
    first = np.arange(len(owner)) - upto[owner] + offsets[owner]
    width = np.minimum(counts, SHINGLE)[owner]
    joined = words.take(pa.array(first))
    for step in range(1, SHINGLE):
        more = pa.array(np.where(step < width, first + step, 0))
        longer = pc.binary_join_element_wise(joined, words.take(more), " ")
        joined = pc.if_else(pa.array(step < width), longer, joined)
    codes, distinct = coded(joined)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(s, SEED) for s in distinct.to_pylist()), np.uint64, len(distinct))
    return hashes[codes], upto


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The fingerprint of every text."""
    hashes, upto = shingle_hashes(texts)
    out = np.zeros(len(texts), np.uint64)
    some = np.flatnonzero(np.diff(upto))
    if len(some):
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, upto[some], axis=0, dtype=np.int32)
        most = 2 * counts > np.diff(upto)[some][:, None]
        out[some] = np.packbits(most, axis=1, bitorder="little").view(np.uint64).ravel()
    return out


def fingerprint(docs: DataFrame) -> DataFrame:
    """``docs`` with the ``fingerprint`` of ``text``, as a (signed) long, in place of ``text``."""
    rows, back = aside(docs.drop("fingerprint"), ["text"])
    names = [n for n in rows.columns if n != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", TEXT_BYTES):
                found = fingerprints(text_of(part)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], pa.array(found)],
                    names=[*names, "fingerprint"])

    schema = rows.limit(0).drop("text").selectExpr("*", "0L as fingerprint").schema
    found = rows.mapInArrow(run, schema)
    return back(found.withColumn("text", F.lit(None).cast("string")), "fingerprint").drop("text")


def tables(count: int) -> list[int]:
    """Masks of the bits that a bucket's fingerprints share, for so many fingerprints.

    The bits are cut into the fewest parts for which unrelated fingerprints meet rarely.
    """
    parts = RADIUS + 1
    while parts < 10 and count > CROWD << (BITS * (parts - RADIUS) // parts):
        parts += 1
    cuts = [BITS * i // parts for i in range(parts + 1)]
    masks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in itertools.combinations(masks, parts - RADIUS)]


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of fingerprints: a row per bit, 64 fingerprints to a word."""
    lanes = -(-len(values) // 64) * 64
    bits = np.zeros((lanes, 64), np.uint8)
    bits[:len(values)] = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def _low(n: np.ndarray) -> np.ndarray:
    """Words whose lowest ``n`` bits (0 to 64) are set."""
    full = n >= 64
    return np.where(full, ~np.uint64(0), (np.uint64(1) << np.where(full, 0, n).astype(np.uint64)) - np.uint64(1))


def forest(values: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of links that join all ``i < j < last[i]`` that differ in at most ``RADIUS`` (3) bits.

    Lanes that are joined to a fingerprint already count as too far, so the links of a crowd are
    not found again and again.
    """
    flat, n = planes(values), len(values)
    begin, end = (np.arange(n) + 1) // 64, -(-last // 64)
    upto = np.concatenate([[0], np.cumsum(np.maximum(end - begin, 0))])
    root = list(range(n))
    labels = np.full(64 * flat.shape[1], -1, np.int32)
    labels[:n] = root
    left, right = [], []
    for low in range(0, int(upto[-1]), CELLS):
        cell = np.arange(low, min(low + CELLS, int(upto[-1])))
        own = np.searchsorted(upto, cell, side="right") - 1
        word = begin[own] + cell - upto[own]
        # so do lanes at or before the fingerprint itself or past its bucket
        past = _low(np.clip(own + 1 - 64 * word, 0, 64)) | ~_low(np.clip(last[own] - 64 * word, 0, 64))
        if left:
            same = labels.reshape(-1, 64)[word] == labels[own][:, None]
            past |= np.packbits(same, axis=1, bitorder="little").view(np.uint64).ravel()
        ones, twos = np.zeros(len(cell), np.uint64), np.zeros(len(cell), np.uint64)
        bits = values[own]
        for k in range(BITS):
            if k % 8 == 0:
                live = np.flatnonzero(~past)
                if not len(live):
                    break
                if len(live) < len(past):
                    own, word, bits = own[live], word[live], bits[live]
                    past, ones, twos = past[live], ones[live], twos[live]
            differ = flat[k][word] ^ (np.uint64(0) - ((bits >> np.uint64(k)) & np.uint64(1)))
            carry = ones & differ
            ones ^= differ
            past |= twos & carry
            twos ^= carry
        hits = np.unpackbits((~past).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        at, lane = np.nonzero(hits)
        known = len(left)
        for x, y in zip(own[at].tolist(), (64 * word[at] + lane).tolist()):
            a, b = _find(root, x), _find(root, y)
            if a != b:
                root[b] = a
                left.append(x)
                right.append(y)
        if len(left) > known:
            labels[:n] = [_find(root, x) for x in range(n)]
    return np.array(left, np.int64), np.array(right, np.int64)


def _find(root: list[int], x: int) -> int:
    while root[x] != x:
        root[x] = root[root[x]]
        x = root[x]
    return x


def _links(table: pa.Table) -> pa.RecordBatch:
    """Links between the fingerprints of whole buckets, which lie one after the other."""
    values = table.column("fp").to_numpy().view(np.uint64)
    keys = np.stack([table.column(c).to_numpy() for c in GROUP], 1)
    fresh = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(1), True])
    last = np.repeat(fresh[1:], np.diff(fresh))
    left, right = forest(values, last)
    signed = values.view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(signed[left]), pa.array(signed[right])], names=["a", "b"])


GROUP = ["table", "key", "i", "j"]
#: Rows that are compared in one go, if they end with a bucket.
ROWS = 1 << 14


def links(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Links ``a``, ``b`` that join all different fingerprints ``fp`` (stored) that belong together."""
    masks = tables(prints.count())
    keyed = [F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(
        F.lit(m - (1 << 64) if m >> 63 else m)).alias("key")) for t, m in enumerate(masks)]
    filed = prints.select("fp", F.explode(F.array(*keyed)).alias("at")).select(
        "fp", "at.table", "at.key")
    large = filed.groupBy("table", "key").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > bucket)
    dealt = lookup_join(filed, large, ["table", "key"], ["fp"])
    blocks = F.ceil(F.coalesce("n", F.lit(1)) / bucket).cast("int")
    own = F.pmod(F.xxhash64(F.lit("block"), "fp"), blocks).cast("int")
    dealt = dealt.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))).select(
        "fp", "table", "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < ROWS:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            keys = [table.column(c).to_numpy() for c in GROUP]
            same = np.logical_and.reduce([k == k[-1] for k in keys])
            cut = int(np.argmax(same))  # the last bucket may go on
            if cut:
                yield _links(table.slice(0, cut))
                held = table.slice(cut).to_batches()
        if held:
            yield _links(pa.Table.from_batches(held).combine_chunks())

    ordered = dealt.repartition(*GROUP).sortWithinPartitions(*GROUP)
    return ordered.mapInArrow(run, "a long, b long")


def components(prints: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``fp`` and its ``component_id`` for all different fingerprints of ``prints`` (stored)."""
    different = kept(prints.groupBy(F.col("fingerprint").alias("fp")).agg(
        F.min("doc_id").alias("first_id")), "sim-different")
    found = kept(links(different, bucket).distinct(), "sim-links")
    rooted = different.join(labels_of(found).withColumnRenamed("copy", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(named, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """``docs`` with ``fingerprint`` and ``component_id`` in place of ``text``."""
    rows, back = aside(docs.drop("fingerprint", "component_id"), ["doc_id", "text"])
    printed = kept(fingerprint(rows), "sim-prints")
    named = components(printed, bucket).withColumnRenamed("fp", "fingerprint")
    found = lookup_join(printed, named, ["fingerprint"], printed.columns)
    return back(found.withColumn("text", F.lit(None).cast("string")),
                "fingerprint", "component_id").drop("text")


def hex_of(fingerprint: Column) -> Column:
    """A fingerprint as 16 hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fingerprint), 16, "0"))
