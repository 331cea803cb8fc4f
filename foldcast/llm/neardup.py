"""Near-duplicate groups by consistent weighted sampling over TF-IDF shingles.

Words are lower-cased and stripped of outer punctuation. A shingle is five words (all words of a
shorter text), its weight its count in the text times the mean inverse document frequency of its
words. Frequencies are counted over all documents; words in fewer than ``RARE`` of the documents
share the highest value, so the table of the others is at most (words per document) / RARE long
and can be broadcast whatever the size of the corpus.

Improved consistent weighted sampling gives each text ``BANDS * ROWS`` samples; texts that agree
on all samples of a band are candidates, and exact copies are one text from the start. In a band's
bucket all texts are compared with the bucket's hub by weighted Jaccard similarity. Where a bucket
then holds more than one class, members of different classes are compared, in large buckets block
by block. No bucket is capped, and no pair of a bucket stays uncompared unless its ends are of one
class already.

Defined results: a NULL text counts as empty; equal texts are always of one class, empty ones
too; texts without a word are alike only if equal; repeated rows count as one document with its
class repeated; a class is named by the smallest id in it (NULL if it has none); an empty table
gives no rows. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import functools
import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.llm.components import labels_of
from foldcast.llm.scratch import aside, kept, small_batches
from foldcast.llm.words import chunks, coded, owners, split, text_of
from foldcast.operators.joins import lookup_join

EDGES = string.punctuation + "«»“”„‘’…¿¡–—"
WORDS, FLOOR = 5, 0.8
#: Sums of weights are rounded, each path's in its own order; a pair this near the floor is at it.
ROUNDING = 1e-9
BANDS, ROWS = 16, 5
#: Share of documents below which a word is rare.
RARE = 0.001
#: Buckets up to PAIRED texts are compared pair by pair, larger ones in blocks of about BLOCK
#: texts and BLOCK_BYTES of text.
PAIRED, BLOCK, BLOCK_BYTES, SLICE = 16, 256, 4 << 20, 2048
_TABLE = 1 << 14
#: Shingles that are sampled at once.
_STRIP = 1 << 14


def word_codes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit digests of all words of all texts that are more than punctuation, and offsets."""
    import xxhash

    words, offsets = split(texts, ascii_space=False)
    codes, distinct = coded(words)
    bare = pc.utf8_trim(pc.utf8_lower(distinct), characters=EDGES)
    full = pc.greater(pc.binary_length(bare), 0).to_numpy(zero_copy_only=False)
    digest = np.array([xxhash.xxh64_intdigest(w) for w in bare.to_pylist()], np.uint64)
    keep = full[codes] if len(codes) else np.empty(0, bool)
    upto = np.concatenate([[0], np.cumsum(keep)])
    return (digest[codes[keep]] if len(codes) else np.empty(0, np.uint64)), upto[offsets]


def document_frequencies(docs: DataFrame) -> DataFrame:
    """``word`` (digest) and ``docs`` for every word, summed up per batch before the shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                digests, offsets = word_codes(text_of(part))
                number, names = pd.factorize(digests)
                pairs = pd.unique(owners(offsets) * max(1, len(names)) + number)
                counts = np.bincount(pairs % max(1, len(names)), minlength=len(names))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names.view(np.int64)), pa.array(counts.astype(np.int64))],
                    names=["word", "docs"])

    return docs.select("text").mapInArrow(run, "word long, docs long").groupBy("word").agg(
        F.sum("docs").alias("docs"))


class Weights:
    """Inverse document frequencies: of the common words by table, of the others one value."""

    def __init__(self, common: dict[int, int], total: int):
        self.words = np.array(sorted(common), np.int64).view(np.uint64)
        order = np.argsort(self.words)
        counts = np.array([common[w] for w in sorted(common)], float)
        self.words, self.idf = self.words[order], np.log1p(total / counts[order])
        self.rare = float(np.log1p(1 / RARE))

    def of(self, digests: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(digests), self.rare)
        place = np.minimum(np.searchsorted(self.words, digests), len(self.words) - 1)
        return np.where(self.words[place] == digests, self.idf[place], self.rare)


def learn_weights(docs: DataFrame) -> Weights:
    total = docs.count()
    common = document_frequencies(docs).where(F.col("docs") >= max(2.0, RARE * total))
    with small_batches(docs.sparkSession):
        found = common.collect()
    return Weights({r["word"]: r["docs"] for r in found}, total)


def shingles(texts: pa.Array, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different shingles of every text, sorted by text and digest: text number, digest, weight."""
    digests, offsets = word_codes(texts)
    idf = weights.of(digests)
    counts = np.diff(offsets)
    width = np.minimum(counts, WORDS)
    starts = np.maximum(counts - WORDS + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), starts)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts) + offsets[owner]
    hashed = np.zeros(len(owner), np.uint64)
    weight = np.zeros(len(owner))
    for step in range(WORDS):
        there = step < width[owner]
        at = np.where(there, first + step, 0)
        if len(digests):
            mixed = (hashed ^ digests[at]) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            hashed = np.where(there, mixed ^ (mixed >> np.uint64(32)), hashed)
            weight += np.where(there, idf[at], 0.0)
    weight /= np.maximum(width[owner], 1)
    order = np.lexsort((hashed, owner))
    owner, hashed, weight = owner[order], hashed[order], weight[order]
    fresh = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (hashed[1:] != hashed[:-1])]
                           ) if len(owner) else np.empty(0, np.int64)
    times = np.diff(np.r_[fresh, len(owner)])
    return owner[fresh], hashed[fresh], weight[fresh] * times


@functools.cache
def _draws(sample: int) -> tuple[np.ndarray, ...]:
    """Tables of one sample's random numbers: 1/r, r, ln c and beta, looked up by digest bits."""
    rng = np.random.default_rng(1000 + sample)
    r = rng.gamma(2.0, 1.0, _TABLE)
    c = rng.gamma(2.0, 1.0, _TABLE)
    return tuple(x.astype(np.float32) for x in (1 / r, r, np.log(c), rng.random(_TABLE)))


def samples(owner: np.ndarray, digests: np.ndarray, weights: np.ndarray, count: int) -> np.ndarray:
    """For each text and sample, the smallest ln a of its shingles, which are sorted by text.

    ln a = ln c - r (t - beta + 1) with t = floor(ln w / r + beta); its value stands for the
    sampled pair (shingle, t), since it depends on nothing else. All samples of ``_STRIP``
    shingles are drawn before the next, in buffers that stay in the processor's cache; a text
    that spans strips keeps the smallest of them.
    """
    starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][:len(owner)])
    out = np.full((count, len(starts)), np.inf, np.float32)
    width = min(_STRIP, len(owner))
    bits, index = np.empty(width, np.uint64), np.empty(width, np.uint64)
    value, looked_up = np.empty(width, np.float32), np.empty(width, np.float32)
    beta_of = np.empty(width, np.float32)
    mask, one = np.uint64(_TABLE - 1), np.float32(1)
    for low in range(0, len(owner), _STRIP):
        digest = digests[low:low + _STRIP]
        n = len(digest)
        log_weight = np.log(weights[low:low + n]).astype(np.float32)
        x, at, v, found, b = bits[:n], index[:n], value[:n], looked_up[:n], beta_of[:n]
        place = at.view(np.int64)
        first, last = np.searchsorted(starts, low, "right") - 1, np.searchsorted(starts, low + n)
        here = np.maximum(starts[first:last] - low, 0)
        for k in range(count):
            inverse, r, log_c, beta = _draws(k)
            # three independent slices of a scramble of the digest
            np.bitwise_xor(digest, np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1), out=x)
            np.multiply(x, np.uint64(0xD6E8FEB86659FD93), out=x)
            np.bitwise_xor(x, np.right_shift(x, np.uint64(32), out=at), out=x)
            np.bitwise_and(np.right_shift(x, np.uint64(28), out=at), mask, out=at)
            np.take(beta, place, out=b, mode="clip")
            np.bitwise_and(x, mask, out=at)
            np.take(inverse, place, out=v, mode="clip")
            np.floor(np.add(np.multiply(log_weight, v, out=v), b, out=v), out=v)
            np.add(np.subtract(v, b, out=v), one, out=v)
            np.multiply(np.take(r, place, out=found, mode="clip"), v, out=v)
            np.bitwise_and(np.right_shift(x, np.uint64(14), out=at), mask, out=at)
            np.subtract(np.take(log_c, place, out=found, mode="clip"), v, out=v)
            least = out[k, first:last]
            np.minimum(least, np.minimum.reduceat(v, here), out=least)
    return np.ascontiguousarray(out.T)


def signatures(docs: DataFrame, weights: Weights) -> DataFrame:
    """``doc_id``, ``copy`` (digest of the text) and the ``bands``; NULL bands without words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                owner, digests, weight = shingles(text_of(part), weights)
                keys = np.zeros((part.num_rows, BANDS), np.int64)
                some = np.zeros(part.num_rows, bool)
                if len(owner):
                    raw = samples(owner, digests, weight, BANDS * ROWS).view(np.uint32)
                    own = np.unique(owner)
                    some[own] = True
                    key = np.zeros((len(own), BANDS), np.uint64)
                    for row in range(ROWS):
                        key = (key ^ raw[:, row::ROWS]) * np.uint64(0x9E3779B97F4A7C15)
                        key ^= key >> np.uint64(29)
                    keys[own] = key.view(np.int64)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(keys.ravel()), BANDS)
                lists = pc.if_else(pa.array(some), lists.cast(pa.list_(pa.int64())),
                                   pa.scalar(None, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("copy"), lists],
                    names=["doc_id", "copy", "bands"])

    rows = docs.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("copy"),
                       "text")
    return rows.mapInArrow(run, "doc_id long, copy string, bands array<long>")


def similarities(pairs: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """``pairs`` (``left`` and ``right`` copies) with their weighted Jaccard similarity.

    Each text is fetched once per pair; ``texts`` holds only texts that are in some bucket.
    """
    a = texts.select(F.col("copy").alias("left"), F.col("text").alias("left_text"))
    b = texts.select(F.col("copy").alias("right"), F.col("text").alias("right_text"))
    names = pairs.columns
    fetched = pairs.join(a, "left").join(b, "right").select(*names, "left_text", "right_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "right_text", 2 << 20):
                n = part.num_rows
                both = pa.concat_arrays([text_of(part, "left_text"), text_of(part, "right_text")])
                codes, distinct = coded(both)
                values = np.zeros(n)
                owner, digests, weight = shingles(distinct, weights)
                edges = np.searchsorted(owner, np.arange(len(distinct) + 1))
                for i in range(n):
                    x, y = codes[i], codes[n + i]
                    p, q = slice(edges[x], edges[x + 1]), slice(edges[y], edges[y + 1])
                    _, k, m = np.intersect1d(digests[p], digests[q], assume_unique=True,
                                             return_indices=True)
                    total = weight[p].sum() + weight[q].sum()
                    common = np.minimum(weight[p][k], weight[q][m]).sum()
                    values[i] = common / (total - common) if total > common else float(total > 0)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in names], pa.array(values)],
                    names=[*names, "similarity"])

    schema = ", ".join([*[f"{c} {t}" for c, t in pairs.dtypes], "similarity double"])
    return fetched.mapInArrow(run, schema)


def links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The different texts (``copy``, ``first_id``, ``n``), and links that join all that belong
    together: every pair of a bucket is compared, or its ends are linked already."""
    weights = learn_weights(docs)
    signed = kept(signatures(docs, weights).groupBy("copy").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("n"),
        F.first("bands").alias("bands")), "dup-signed")
    buckets = signed.where("bands is not null").select(
        "copy", F.posexplode("bands").alias("band", "key"))
    sizes = buckets.groupBy("band", "key").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    members = kept(buckets.join(sizes, ["band", "key"]), "dup-buckets")
    met = members.select("copy").distinct().join(signed.select("copy", "bands"), "copy")
    texts = docs.select(F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("copy"), "text")
    texts = kept(texts.join(met, "copy").groupBy("copy").agg(
        F.first(F.coalesce("text", F.lit(""))).alias("text"),
        F.first("bands").alias("bands")), "dup-texts")
    return signed.select("copy", "first_id", "n"), settle(members, texts, weights)


def settle(members: DataFrame, texts: DataFrame, weights: Weights) -> DataFrame:
    """Links ``left``, ``right`` between the texts of buckets (``copy``, ``band``, ``key`` and the
    bucket's number of ``texts``).

    First every text meets its bucket's hub, the member with the most company over all bands:
    copies of one text meet that text. Buckets whose members are of one class then are settled.
    In the others members of different classes are compared: small buckets pair by pair, each
    pair once over all bands; large ones block by block (``deal``, ``_block``).
    """
    keys = ["band", "key"]
    company = members.groupBy("copy").agg(F.sum("texts").alias("company"))
    hubs = members.join(company, "copy").groupBy(*keys).agg(
        F.max(F.struct("company", "copy")).alias("hub")).select(*keys, F.col("hub.copy").alias("a"))
    star = kept(_pairs(members.join(hubs, keys).withColumn("b", F.col("copy"))), "dup-star")
    first = kept(similarities(star, texts, weights).where(F.col("similarity") >= FLOOR - ROUNDING)
                 .select("left", "right"), "dup-links")
    labels = labels_of(first.select(F.col("left").alias("a"), F.col("right").alias("b")))
    classed = kept(members.join(labels, "copy", "left").withColumn(
        "class", F.coalesce("root", "copy")).drop("root"), "dup-classed")
    mixed = classed.groupBy(*keys).agg(F.min("class").alias("x"), F.max("class").alias("y")).where(
        "x <> y").select(*keys)
    open_ = kept(classed.join(mixed, keys), "dup-open")

    small = open_.where(F.col("texts") <= PAIRED)
    a, b = small.alias("a"), small.alias("b")
    pairs = _pairs(a.join(b, keys).where("a.class < b.class").select(
        F.col("a.copy").alias("a"), F.col("b.copy").alias("b"))).join(
        star, ["left", "right"], "left_anti")
    second = similarities(pairs, texts, weights).where(F.col("similarity") >= FLOOR - ROUNDING)

    dealt = deal(open_.where(F.col("texts") > PAIRED), texts).join(texts, "copy")
    third = dealt.groupBy(*keys, "i", "j").applyInArrow(
        lambda table: _block(table, weights), "left string, right string")
    return kept(first.unionByName(second.select("left", "right")).unionByName(third), "dup-known")


def deal(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``members`` of large buckets, once for every pair of blocks ``i``, ``j`` that they are in.

    A bucket's largest class needs no comparison inside, so it gets blocks of its own, which meet
    the blocks of the other members only. With n members in that class and m others, in p and q
    blocks, n * q + m * (p + q) rows are sent: few others cost about one row a member. Blocks are
    counted by texts and by bytes, whichever asks for more; a longer text is a block's share alone.
    """
    keys = ["band", "key"]
    sized = kept(members.select(*keys, "copy", "class").join(
        texts.select("copy", F.octet_length("text").cast("long").alias("size")), "copy"), "dup-large")
    by_class = sized.groupBy(*keys, "class").agg(
        F.count(F.lit(1)).alias("c"), F.sum("size").alias("bytes"))
    buckets = by_class.groupBy(*keys).agg(
        F.sum("c").alias("all"), F.sum("bytes").alias("all_bytes"),
        F.max(F.struct("c", "class", "bytes")).alias("main"))

    def blocks(texts_: Column, bytes_: Column) -> Column:
        return F.greatest(F.ceil(texts_ / BLOCK), F.ceil(bytes_ / BLOCK_BYTES)).cast("int")

    plan = buckets.select(
        *keys, F.col("main.class").alias("main"), blocks(F.col("main.c"), F.col("main.bytes")).alias("p"),
        blocks(F.col("all") - F.col("main.c"), F.col("all_bytes") - F.col("main.bytes")).alias("q"))
    in_main, mark = F.col("class") == F.col("main"), F.xxhash64(F.lit("block"), "copy")
    placed = lookup_join(sized, plan, keys, ["copy"]).withColumn("own", F.when(
        in_main, F.pmod(mark, F.col("p"))).otherwise(F.col("p") + F.pmod(mark, F.col("q"))).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(
        F.when(in_main, F.col("p")).otherwise(F.lit(0)), F.col("p") + F.col("q") - 1)))
    return met.select(*keys, "copy", "class", "own", F.least("own", "other").alias("i"),
                      F.greatest("own", "other").alias("j"))


def _block(table: pa.Table, weights: Weights) -> pa.Table:
    """Links between members of different classes in one pair of blocks.

    Pairs that share an earlier band are left to that band's bucket. Of the links that join two
    classes one is given. Weights are added up over slices of the shared shingles, so memory does
    not grow with the texts.
    """
    batch = table.combine_chunks()
    texts = batch.column("text").combine_chunks()
    owner, digests, weight = shingles(texts.cast(pa.string()), weights)
    n = len(texts)
    total = np.bincount(owner, weights=weight, minlength=n)
    number, _ = pd.factorize(digests)
    often = np.bincount(number, minlength=1)[number] > 1 if len(number) else np.empty(0, bool)
    owner, number, weight = owner[often], pd.factorize(number[often])[0], weight[often]
    order = np.argsort(number, kind="stable")
    owner, number, weight = owner[order], number[order], weight[order]
    common = np.zeros((n, n))
    for low in range(0, int(number[-1]) + 1 if len(number) else 0, SLICE):
        a, b = np.searchsorted(number, [low, low + SLICE])
        dense = np.zeros((n, SLICE))
        dense[owner[a:b], number[a:b] - low] = weight[a:b]
        # a shingle's weights are multiples of one number, so their minimum adds up in layers
        left = dense
        while True:
            unit = np.where(left > 0, left, np.inf).min(axis=0)
            unit[~np.isfinite(unit)] = 0
            if not unit.any():
                break
            held = (left > 0) * np.sqrt(unit)
            common += held @ held.T
            left = np.where(left > 0, left - unit, 0.0)
            left[left < 1e-9] = 0.0
    whole = total[:, None] + total[None, :] - common
    near = np.divide(common, whole, out=np.zeros_like(common), where=whole > 0)
    near = near >= FLOOR - ROUNDING
    band = batch.column("band")[0].as_py()
    bands = np.array(batch.column("bands").to_pylist(), np.int64)[:, :band]
    blocks = batch.column("own").to_numpy()
    cross = blocks[:, None] != blocks[None, :] if (blocks != blocks[0]).any() else True
    classes_, _ = pd.factorize(batch.column("class").to_pandas())
    near &= (classes_[:, None] != classes_[None, :]) & cross
    x, y = np.nonzero(np.triu(near, 1))
    ahead = np.array([bool((bands[i] == bands[j]).any()) for i, j in zip(x, y)], bool)
    copies, root = batch.column("copy").to_pylist(), list(range(classes_.max() + 1))

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    out = []
    for i, j in zip(x[~ahead], y[~ahead]):
        p, q = find(classes_[i]), find(classes_[j])
        if p != q:
            root[p] = q
            out.append({"left": min(copies[i], copies[j]), "right": max(copies[i], copies[j])})
    return pa.Table.from_pylist(out, schema=pa.schema([("left", pa.string()), ("right", pa.string())]))


def _pairs(df: DataFrame) -> DataFrame:
    """Ordered pairs of different copies, each once."""
    return df.where("a <> b").select(F.least("a", "b").alias("left"),
                                     F.greatest("a", "b").alias("right")).distinct()


def classes(docs: DataFrame) -> DataFrame:
    """``copy`` (digest of a text), its ``class_id``, ``root``, ``first_id`` and its copies ``n``."""
    texts, found = links(docs)
    named = kept(labels_of(found.select(F.col("left").alias("a"), F.col("right").alias("b"))),
                 "dup-labels")
    rooted = texts.join(named, "copy", "left").withColumn("root", F.coalesce("root", "copy"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("class_id"))
    return kept(rooted.join(ids, "root").select("copy", "class_id", "root", "first_id", "n"),
                "dup-classes")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``class_id`` of every row of ``docs``, with the number of its text's copies."""
    copies = docs.select("doc_id", F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("copy"))
    return copies.join(classes(docs), "copy").select(
        "doc_id", "class_id", F.col("n").alias("copies"))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the one with the smallest id.

    Of rows that share that id and text, one stays. Only the ids that stay are shuffled to the
    documents; texts move once.
    """
    rows, back = aside(docs, ["doc_id", "text"])
    stays = classes(rows).groupBy("root").agg(
        F.min(F.struct(F.col("first_id").isNull(), "first_id", "copy")).alias("best"))
    stays = stays.select("best.first_id", F.col("best.copy").alias("_copy"))
    marked = rows.withColumn("_copy", F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    joined = marked.alias("d").join(
        stays.alias("s"), (F.col("d._copy") == F.col("s._copy"))
        & F.col("d.doc_id").eqNullSafe(F.col("s.first_id")), "left_semi")
    return back(joined.dropDuplicates(["_copy"]))
