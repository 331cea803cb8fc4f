"""Toxic passages as maximum-scoring segments, with extreme-value calibration.

Units are words, their plain forms (without accents, inner punctuation and digits for letters), the
runs of 3 to 6 letters in them, their ends marked, and pairs of words next to each other or with
one word between. Their log-odds between toxic and clean documents use Dirichlet priors in
proportion to how common the unit is; a word scores the best of its significant units, and all
other words share one slightly negative score. A linear scan finds every maximal scoring segment of
a text. The chance of such a segment in clean text of that length follows the extreme-value law of
local scores: its decay comes from the unit table, its scale from clean documents. The evidence of
all significant segments adds up. Units come from three quarters of the training sample; the law
and the evidence needed come from the other quarter, which units found by chance do not fit.

Defined results: a NULL, empty or wordless text has score 0 and no passage; repeated rows score
alike; without labels of both kinds, or without a significant unit, every score is 0; an empty
table gives no rows. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import functools
import math
import re
import string
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.llm.labelled import with_labels
from foldcast.llm.scratch import aside, kept
from foldcast.llm.words import chunks, coded, owners, split, text_of

#: Lengths of the runs of letters, a word's two end marks included, and distances of paired words.
LETTERS, GAPS = (3, 4, 5, 6), (1, 2)
EDGES = string.punctuation + "«»“”„‘’…¿¡–—"
#: Signs that stand for letters.
SIGNS = str.maketrans("0134578@$!", "oieastbasi")
#: A unit is a candidate if this share of the toxic documents has it, so the list of candidates
#: is at most (units per document) / SHARE long.
SHARE, LEAST = 0.004, 5
#: Weight of the prior, which shares out in proportion to how common units are, and its least.
PRIOR, LEAST_PRIOR = 50.0, 0.5
#: A unit is significant if chance alone would give fewer than this many of the candidates so high
#: a log-odds; and it must be this telling (5 times as common, by the lower end of its range).
#: Units that are very telling (20 times) come first: others must be so in the words that are left.
BY_CHANCE, TELLING, FIRST = 0.05, math.log(5.0), math.log(20.0)
#: One in so many of the sample's documents is kept for the law and the threshold.
CALIBRATION = 4
#: A segment counts if clean text of that length has such a one with at most this chance.
CHANCE = 0.05
#: How much a share of clean documents weighs against as large a share of toxic ones.
CLEAN = 4.0
#: Words whose units are worked out at once.
WORDS = 1 << 14
#: Words whose scores a task remembers.
KNOWN = 1 << 18


@dataclass(frozen=True)
class Model:
    """Units (as keys, ascending) and their scores, the score of all other words, and the law of
    scores in clean text."""

    keys: np.ndarray
    scores: np.ndarray
    other: float = -1e-9
    decay: float = 1.0
    scale: float = 1.0
    needed: float = 10.0

    @functools.cached_property
    def sieve(self) -> "Sieve":
        return Sieve(self.keys)

    def hits(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys that are units, and their scores."""
        at, place = self.sieve.find(keys)
        return at, self.scores[place]


class Sieve:
    """Finds the few of many keys that are in a sorted list: first by their last bits."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        self.bits = np.uint64((1 << max(12, (16 * len(keys)).bit_length())) - 1)
        self.table = np.zeros(int(self.bits) + 1, bool)
        self.table[keys & self.bits] = True

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the keys that are listed, and where in the list they are."""
        at = np.flatnonzero(self.table[keys & self.bits])
        if not len(at):
            return at, at
        place = np.minimum(np.searchsorted(self.keys, keys[at]), len(self.keys) - 1)
        right = self.keys[place] == keys[at]
        return at[right], place[right]


def _mix(a: np.ndarray, b) -> np.ndarray:
    """One 64-bit key of two."""
    x = (a ^ np.uint64(b) if np.isscalar(b) else a ^ b) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


#: Words that have another plain form.
NOT_PLAIN = re.compile(r"[^a-z]|([a-z])\1")


def plain(word: str) -> str:
    """A word without accents, signs for letters, inner punctuation and doubled letters."""
    letters = [c for c in unicodedata.normalize("NFKD", word).translate(SIGNS) if c.isalpha()]
    return "".join(c for i, c in enumerate(letters) if i == 0 or c != letters[i - 1])


def bare_words(distinct: pa.Array) -> pa.Array:
    return pc.utf8_trim(pc.utf8_lower(distinct), characters=EDGES)


def word_keys(bare: list[str]) -> np.ndarray:
    """A key per word; 0 for nothing but punctuation."""
    import xxhash

    return np.array([xxhash.xxh64_intdigest(w) if w else 0 for w in bare], np.uint64)


def word_units(bare: list[str], keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Word number and key of all units inside the words: themselves, plain forms, runs of letters."""
    import xxhash

    own = np.flatnonzero(keys)
    of, found = [own], [keys[own]]
    forms = [(i, plain(w)) for i, w in enumerate(bare) if NOT_PLAIN.search(w)]
    forms = [(i, f) for i, f in forms if f]
    of.append(np.array([i for i, _ in forms], np.int64))
    found.append(np.array([xxhash.xxh64_intdigest(f, 1) for _, f in forms], np.uint64))
    text = "".join(f"^{w}$" for w in bare)
    letters = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64)
    word = np.repeat(np.arange(len(bare)), [len(w) + 2 for w in bare])
    run = letters
    for n in range(2, max(LETTERS) + 1):
        run = _mix(run[:len(run) - 1], letters[n - 1:]) if len(run) else run
        if n in LETTERS:
            whole = np.flatnonzero(word[:len(run)] == word[n - 1:]) if len(run) else np.empty(0, np.int64)
            of.append(word[whole])
            found.append(_mix(run[whole], n))
    return np.concatenate(of), np.concatenate(found)


def pair_units(keys: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every distance: places of the later words, and the keys of the pairs."""
    owner = owners(offsets)
    for gap in GAPS:
        later = np.arange(gap, len(keys))
        later = later[(owner[later] == owner[later - gap]) & (keys[later] != 0) & (keys[later - gap] != 0)]
        yield later, _mix(_mix(keys[later - gap], gap), keys[later])


#: The key under which all words are counted.
EVERY = 1


def _document_counts(batch: pa.RecordBatch, only: Sieve | None, left_by: Model | None = None,
                     ) -> pd.DataFrame:
    """Per unit, how many toxic and clean documents of a batch have it, and how many words there.

    With ``left_by``, words that have a unit of that model are left out."""
    words, offsets = split(text_of(batch))
    codes, distinct = coded(words)
    owner, label = owners(offsets), batch.column("label").to_numpy(zero_copy_only=False)
    bare = bare_words(distinct).to_pylist()
    keys = word_keys(bare)
    left = np.ones(len(codes), bool)
    if left_by is not None:
        left = ~np.isfinite(_best(bare, keys, codes, offsets, left_by))
    word, unit = word_units(bare, keys)
    if only is not None:
        known, _ = only.find(unit)
        word, unit = word[known], unit[known]
    number, names = pd.factorize(unit)
    once = pd.unique(word * max(1, len(names)) + number)
    once.sort()
    word, number = once // max(1, len(names)), once % max(1, len(names))
    first = np.searchsorted(word, np.arange(len(bare) + 1))
    # each different word of a text and how often it is there, then its units
    pairs, times = np.unique((owner * max(1, len(bare)) + codes)[left], return_counts=True)
    text, word = pairs // max(1, len(bare)), pairs % max(1, len(bare))
    many = (first[1:] - first[:-1])[word]
    at = np.repeat(first[word] - (np.cumsum(many) - many), many) + np.arange(many.sum())
    found = [(np.repeat(text, many), number[at], np.repeat(times, many), names)]
    for gap, (later, unit) in zip(GAPS, pair_units(keys[codes] if len(codes) else keys, offsets)):
        both = left[later] & left[later - gap]
        later, unit = later[both], unit[both]
        if only is not None:
            known, _ = only.find(unit)
            later, unit = later[known], unit[known]
        number, names = pd.factorize(unit)
        found.append((owner[later], number, np.ones(len(later), np.int64), names))
    lengths = np.diff(offsets)
    parts = [pd.DataFrame({"unit": [EVERY], "toxic": [label.sum()], "clean": [len(label) - label.sum()],
                           "toxic_words": [lengths[label > 0].sum()],
                           "clean_words": [lengths[label == 0].sum()]}).astype("int64")]
    for text, number, times, names in found:
        n = max(1, len(names))
        hits = np.bincount(number, weights=times, minlength=len(names))
        bad = np.bincount(number, weights=times * label[text], minlength=len(names))
        pairs = pd.unique(text * n + number)
        of, what = pairs // n, pairs % n
        toxic = np.bincount(what, weights=label[of], minlength=len(names))
        every = np.bincount(what, minlength=len(names))
        parts.append(pd.DataFrame({
            "unit": names.view(np.int64), "toxic": toxic, "clean": every - toxic,
            "toxic_words": bad, "clean_words": hits - bad}).astype("int64"))
    return pd.concat(parts)


def unit_counts(rows: DataFrame, only: np.ndarray | None = None, left_by: Model | None = None,
                ) -> DataFrame:
    """Documents with each unit and words that have it, by label, summed up per batch before they
    are shuffled. The unit ``EVERY`` stands for all words. ``only`` are the (sorted) units wanted."""
    wanted = None if only is None else Sieve(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text", 1 << 20):
                yield pa.RecordBatch.from_pandas(
                    _document_counts(part, wanted, left_by), preserve_index=False)

    names = ["toxic", "clean", "toxic_words", "clean_words"]
    return rows.select("label", "text").mapInArrow(
        run, "unit long, " + ", ".join(f"{n} long" for n in names)).groupBy("unit").agg(
        *[F.sum(n).alias(n) for n in names])


def log_odds(toxic: Column, clean: Column, toxic_all: float, clean_all: float,
             ) -> tuple[Column, Column]:
    """Log-odds ratio of shares under a Dirichlet prior, and its standard error."""
    prior = F.greatest(PRIOR * (toxic + clean) / (toxic_all + clean_all), F.lit(LEAST_PRIOR))
    a, b = toxic + prior, clean + prior
    rest_a = F.greatest(toxic_all + PRIOR - toxic, F.lit(1e-9))
    rest_b = F.greatest(clean_all + PRIOR - clean, F.lit(1e-9))
    return F.ln(a / rest_a) - F.ln(b / rest_b), F.sqrt(1 / a + 1 / b)


def excess(toxic: Column, clean: Column, toxic_all: float, clean_all: float) -> Column:
    """How unlikely so many toxic documents are if labels meant nothing, as a z-score: the root of
    the likelihood ratio, which holds for units that no clean document has."""
    every, all_ = toxic + clean, toxic_all + clean_all
    terms = [F.when(n > 0, n * F.ln(n * all_ / (every * of))).otherwise(0.0)
             for n, of in ((toxic, toxic_all), (clean, clean_all))]
    root = F.sqrt(F.greatest(2 * (terms[0] + terms[1]), F.lit(0.0)))
    return F.when(toxic * clean_all > clean * toxic_all, root).otherwise(-root)


def least_z(candidates: int) -> float:
    """The z-score that chance gives ``BY_CHANCE`` of so many candidates."""
    low, high = 0.0, 40.0
    for _ in range(60):
        z = (low + high) / 2
        low, high = (z, high) if candidates * math.erfc(z / math.sqrt(2)) / 2 > BY_CHANCE else (low, z)
    return high


def decay_of(scores: np.ndarray, chances: np.ndarray) -> float:
    """The positive root of sum(chance * exp(root * score)) = 1."""
    low, high = 0.0, 1.0
    value = lambda x: float(np.sum(chances * np.expm1(np.minimum(x * scores, 700.0))))
    while value(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if value(middle) < 0 else (low, middle)
    return high


def segments(positions: np.ndarray, scores: np.ndarray, other: float, length: int,
             ) -> list[tuple[float, int, int]]:
    """All maximal scoring segments (score, first word, last word) of one text, in linear time.

    ``positions`` and ``scores`` are the words that are not ``other``. A candidate keeps the
    total before and after it; it is joined to the nearest earlier one that starts lower, if
    that one also ends lower.
    """
    found: list[tuple[float, float, int, int]] = []  # total before, total after, first, last
    total, at = 0.0, 0
    for position, score in zip(positions.tolist(), scores.tolist()):
        total += other * (position - at)
        at = position + 1
        before, total = total, total + score
        if score <= 0:
            continue
        left, first = before, position
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][0] >= left:
                k -= 1
            if k < 0 or found[k][1] >= total:
                found.append((left, total, first, position))
                break
            left, first = found[k][0], found[k][2]
            del found[k:]
    return [(after - before, first, last) for before, after, first, last in found]


def _best(bare: list[str], keys: np.ndarray, codes: np.ndarray, offsets: np.ndarray, model: Model,
          known: dict[int, float] | None = None) -> np.ndarray:
    """The best score of every word's units; minus infinity without one. ``known`` remembers the
    scores of words by their keys."""
    best = np.full(len(bare), -np.inf)
    new = np.arange(len(bare))
    if known is not None:
        held = [known.get(k) for k in keys.tolist()]
        new = np.array([i for i, x in enumerate(held) if x is None], np.int64)
        best = np.array([-np.inf if x is None else x for x in held])
    for low in range(0, len(new), WORDS):
        part = new[low:low + WORDS]
        word, unit = word_units([bare[i] for i in part], keys[part])
        at, score = model.hits(unit)
        np.maximum.at(best, part[word[at]], score)
    if known is not None:
        if len(known) > KNOWN:
            known.clear()
        known.update(zip(keys[new].tolist(), best[new].tolist()))
    out = best[codes] if len(codes) else np.empty(0)
    if len(codes):
        for later, unit in pair_units(keys[codes], offsets):
            at, score = model.hits(unit)
            out[later[at]] = np.maximum(out[later[at]], score)
    return out


def word_scores(texts: pa.Array, model: Model, known: dict[int, float] | None = None,
                ) -> tuple[np.ndarray, np.ndarray]:
    """The score of every word of all texts (minus infinity: none of its own), and the offsets."""
    words, offsets = split(texts)
    codes, distinct = coded(words)
    bare = bare_words(distinct).to_pylist()
    return _best(bare, word_keys(bare), codes, offsets, model, known), offsets


def _scan(texts: pa.Array, model: Model, known: dict[int, float],
          ) -> tuple[list[int], list[float], list[list[dict]]]:
    best, offsets = word_scores(texts, model, known)
    hit = np.flatnonzero(np.isfinite(best))
    bounds = np.searchsorted(hit, offsets)
    lengths = np.diff(offsets)
    evidence, passages = [], []
    for i, n in enumerate(lengths.tolist()):
        own = hit[bounds[i]:bounds[i + 1]]
        total, spans = 0.0, []
        if len(own):
            for score, first, last in segments(own - offsets[i], best[own], model.other, n):
                strength = strength_of(score, n, model)
                if strength >= -math.log(CHANCE):
                    total += strength
                    spans.append({"first": first, "last": last, "score": score})
        evidence.append(total)
        passages.append(spans)
    return lengths.tolist(), evidence, passages


def strength_of(score: float, words: int, model: Model) -> float:
    """Minus the logarithm of the chance of a segment this good in clean text this long."""
    expected = math.log(max(model.scale * words, 1e-9)) - model.decay * score
    if expected <= -30:
        return -expected
    return -math.log(-math.expm1(-math.exp(min(expected, 700.0))))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``words``, ``evidence`` and the significant ``passages`` (word numbers)."""
    rest = docs.drop("words", "evidence", "passages")
    names = rest.columns
    span = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, float] = {}
        for batch in batches:
            for part in chunks(batch, "text"):
                lengths, evidence, passages = _scan(text_of(part), model, known)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], pa.array(lengths, pa.int64()),
                     pa.array(evidence, pa.float64()), pa.array(passages, pa.list_(span))],
                    names=[*names, "words", "evidence", "passages"])

    schema = rest.limit(0).selectExpr(
        "*", "0L as words", "0D as evidence",
        "cast(null as array<struct<first: int, last: int, score: double>>) as passages").schema
    return rest.mapInArrow(run, schema)


def significant(counts: DataFrame, toxic_docs: int, clean_docs: int, candidates: int, least: float,
                ) -> Model:
    """Units that matter by their documents, and whose words tell at least so much."""
    words = counts.where(F.col("unit") == EVERY).first()
    z = excess(F.col("toxic"), F.col("clean"), float(toxic_docs), float(clean_docs))
    score, spread = log_odds(F.col("toxic_words"), F.col("clean_words"),
                             float(words["toxic_words"]), float(words["clean_words"]))
    table = counts.where(F.col("unit") != EVERY).where(z >= least_z(candidates)).select(
        "unit", score.alias("score"), spread.alias("spread")).where(
        F.col("score") - 2 * F.col("spread") >= least).toPandas()
    keys = table["unit"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(keys)
    return Model(keys[order], table["score"].to_numpy(float)[order])


def _joined(a: Model, b: Model) -> Model:
    """Units of both; of a unit that both have, the score of the first."""
    new = ~np.isin(b.keys, a.keys)
    keys, scores = np.concatenate([a.keys, b.keys[new]]), np.concatenate([a.scores, b.scores[new]])
    order = np.argsort(keys)
    return Model(keys[order], scores[order])


def fit(docs: DataFrame, sample: DataFrame) -> Model | None:
    """Learn unit scores and the calibration from the sample's documents."""
    rows = kept(with_labels(docs.select("doc_id", "text"), sample).withColumn("_aside", F.pmod(
        F.xxhash64(F.lit("calibration"), "doc_id"), F.lit(CALIBRATION)) == 0), "toxic-rows")
    totals = {(r["_aside"], r["label"]): r["n"] for r in rows.groupBy("_aside", "label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    toxic_docs, clean_docs = totals.get((False, 1), 0), totals.get((False, 0), 0)
    if not toxic_docs or not clean_docs:
        return None
    learnt, held = rows.where("not _aside"), rows.where("_aside")
    if min(totals.get((True, 1), 0), totals.get((True, 0), 0)) < LEAST:
        held = rows  # too few to keep any aside
    candidates = np.array(sorted(r[0] for r in unit_counts(learnt.where("label = 1")).where(
        F.col("toxic") >= max(LEAST, math.ceil(SHARE * toxic_docs))).where(
        F.col("unit") != EVERY).select("unit").collect()), np.int64).view(np.uint64)
    counts = kept(unit_counts(learnt, candidates), "toxic-units")
    found = significant(counts, toxic_docs, clean_docs, len(candidates), FIRST)
    rest = significant(counts, toxic_docs, clean_docs, len(candidates), TELLING)
    if len(found.keys):
        # what is telling at all, in the words that the first ones leave
        counts = kept(unit_counts(learnt, rest.keys, found), "toxic-rest")
        rest = significant(counts, toxic_docs, clean_docs, len(candidates), TELLING)
    found = _joined(found, rest)
    if not len(found.keys):
        return None
    model = found
    # how often scored words are met, per word, in toxic and in clean documents
    a, b = scored_rates(learnt, model), scored_rates(held.where("label = 0"), model)
    other = min(-1e-3, math.log((1 - min(a[1][0] / a[1][1], 0.999)) / (1 - min(b[0][0] / b[0][1], 0.999))))
    values, chances = np.array([*b[0][2], other]), np.array([*b[0][3], b[0][1] - b[0][0]]) / b[0][1]
    model = replace(model, other=other, decay=decay_of(values, chances))
    # scale: maximum likelihood over the clean documents' best segments
    best = best_segments(held.where("label = 0"), model).agg(
        F.count(F.lit(1)), F.sum(F.col("words") * F.exp(-model.decay * F.col("best")))).first()
    model = replace(model, scale=max(1e-12, best[0] / max(best[1] or 1.0, 1e-9)))
    return replace(model, needed=needed_evidence(held, model))


def scored_rates(rows: DataFrame, model: Model) -> dict[int, tuple]:
    """Per label: scored words, all words, and the counts of each score (rounded)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, float] = {}
        for batch in batches:
            for part in chunks(batch, "text"):
                best, offsets = word_scores(text_of(part), model, known)
                label = part.column("label").to_numpy(zero_copy_only=False)[owners(offsets)]
                score = np.where(np.isfinite(best), np.round(best, 1), -1.0)
                counts = pd.DataFrame({"label": label, "score": score})
                counts = counts.groupby(["label", "score"]).size().rename("n").reset_index()
                yield pa.RecordBatch.from_pandas(
                    counts.astype({"label": "int32", "n": "int64"}), preserve_index=False)

    found = rows.select("label", "text").mapInArrow(run, "label int, score double, n long").groupBy(
        "label", "score").agg(F.sum("n").alias("n")).toPandas()
    out = {}
    for label in (0, 1):
        own = found[found["label"] == label]
        hits = own[own["score"] >= 0]
        out[label] = (float(hits["n"].sum()), float(max(1, own["n"].sum())),
                      hits["score"].to_numpy(), hits["n"].to_numpy(float))
    return out


def best_segments(rows: DataFrame, model: Model) -> DataFrame:
    """``words`` and the score of the ``best`` segment, 0 where there is none."""
    loose = replace(model, decay=0.0, scale=1e-9)  # every segment counts
    found = scan(rows.select("text"), loose).where("words > 0")
    return found.select("words", F.coalesce(F.array_max("passages.score"), F.lit(0.0)).alias("best"))


def needed_evidence(rows: DataFrame, model: Model) -> float:
    """The evidence from which documents count as toxic: the least share of wrong ones, that of
    clean documents weighing ``CLEAN`` times."""
    bins = scan(rows, model).groupBy(
        "label", F.least(F.round("evidence", 1), F.lit(100.0)).alias("bin")).agg(
        F.count(F.lit(1)).alias("n")).toPandas()
    edges = np.arange(3.0, 40.0, 0.1)
    toxic, clean = bins[bins["label"] == 1], bins[bins["label"] == 0]
    lost = [toxic["n"][toxic["bin"] < e].sum() / max(1, toxic["n"].sum())
            + CLEAN * clean["n"][clean["bin"] >= e].sum() / max(1, clean["n"].sum()) for e in edges]
    best = np.flatnonzero(np.array(lost) <= min(lost) + 1e-9)
    return float(edges[best[len(best) // 2]])


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` (0.5 where the evidence is as much as needed) and ``passages``."""
    if model is None:
        return docs.drop("score", "passages").selectExpr(
            "*", "0D as score",
            "cast(array() as array<struct<first: int, last: int, score: double>>) as passages")
    rows, back = aside(docs.drop("score", "passages"), ["text"])
    odds = F.col("evidence") / (F.col("evidence") + F.lit(model.needed))
    return back(scan(rows, model), odds.alias("score"), "passages")
