"""Document fingerprints from spot signatures.

A signature is a common word (the anchor) and the chain of the next content words. A document's
fingerprint is its set of signatures, written as sorted 32-bit digests; likeness is the Jaccard
similarity of the sets. Since J(a, b) <= |a| / |b|, documents are partitioned by set length so
that a pair that can reach the floor lies in the same or in neighbouring partitions, and sets are
only intersected if their lengths leave the floor in reach.

Defined results: case and outer punctuation do not matter. A text with words but no chain behind
an anchor uses every word as an anchor (with fewer words following, the chain is shorter); a NULL
text, an empty text or one of punctuation alone has the empty fingerprint. Two empty sets are
alike (1.0), an empty and a filled one are not (0.0). Equal texts have equal fingerprints. An
empty table gives no rows. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from foldcast.llm.scratch import kept
from foldcast.llm.words import chunks, coded, owners, split, text_of

EDGES = string.punctuation + "«»“”„‘’…¿¡–—"
#: Common words of four languages; a parameter of the operator.
ANCHORS = tuple("""
a an and are as at be been but by for from had has have he her his i if in is it its not of on or
our she that the their they this to was we were which will with would you your
au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous ou
par pas plus pour qu que qui sa se ses son sur un une vous
als am auch auf aus bei das dass dem den der des die ein eine einem einen einer er es für hat ich
im ist mit nach nicht noch nur oder sich sie sind so um und von war wie wird zu zum zur
al como con del e el ella entre era ese esta este fue ha hay la las lo los más me mi muy no o
para pero por se ser si sin sobre su sus también todo una uno y ya
""".split())
CHAIN = 2


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A full-period 64-bit scramble (multiply and fold), one per salt."""
    x = (x ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_digests(words: pa.Array) -> np.ndarray:
    """A 64-bit digest of each word, from its bytes."""
    import xxhash

    return np.array([xxhash.xxh64_intdigest(w) for w in words.to_pylist()], np.uint64)


def signature_sets(texts: pa.Array, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN,
                   ) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different signatures of every text, and the offset of each text's first one."""
    words, offsets = split(texts, ascii_space=False)
    codes, distinct = coded(words)
    bare = pc.utf8_trim(pc.utf8_lower(distinct), characters=EDGES)
    is_anchor = pc.is_in(bare, value_set=pa.array(anchors)).to_numpy(zero_copy_only=False)
    is_word = pc.greater(pc.binary_length(bare), 0).to_numpy(zero_copy_only=False)
    digest = word_digests(bare)
    owner = owners(offsets)
    n = len(texts)
    said = np.flatnonzero(is_word[codes]) if len(codes) else np.empty(0, np.int64)
    content = said[~is_anchor[codes[said]]] if len(said) else said

    def chains(starts: np.ndarray, links: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Signature and text of each anchor with at least ``least`` links in its text."""
        out = _mix(digest[codes[starts]], 1)
        ok = np.ones(len(starts), bool)
        at = np.searchsorted(links, starts, side="right")
        for step in range(chain):
            place = np.minimum(at + step, max(0, len(links) - 1))
            there = (at + step < len(links))
            if len(links):
                there &= owner[links[place]] == owner[starts]
                more = _mix(out + digest[codes[links[place]]], 2 + step)
                out = np.where(there, more, out)
            if step < least:
                ok &= there
        return out[ok], owner[starts[ok]]

    anchors_at = said[is_anchor[codes[said]]] if len(said) else said
    found, of = chains(anchors_at, content, chain)
    lacking = np.bincount(of, minlength=n) == 0
    rest = said[lacking[owner[said]]] if len(said) else said
    more, of_more = chains(rest, said, 0)
    sets = np.concatenate([found, more]) >> np.uint64(32)
    of = np.concatenate([of, of_more]).astype(np.uint64)
    both = np.unique((of << np.uint64(32)) | sets)
    bounds = np.searchsorted(both >> np.uint64(32), np.arange(n + 1).astype(np.uint64))
    return (both & np.uint64(0xFFFFFFFF)).astype(">u4"), bounds


def jaccard(a: np.ndarray, b: np.ndarray, floor: float = 0.0) -> float:
    """Similarity of two sorted sets; 0 where their lengths or overlap cannot reach ``floor``."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    need = floor / (1 + floor) * (len(a) + len(b))
    if min(len(a), len(b)) < need:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common) if common >= need else 0.0


def fingerprint(docs: DataFrame, columns: dict[str, str]) -> DataFrame:
    """``docs`` with the fingerprints of text columns (text column to name of the fingerprint):
    eight hex digits for each signature."""
    rest = docs.drop(*columns.values())
    names = rest.columns

    def prints(texts: pa.Array) -> pa.Array:
        sets, bounds = signature_sets(texts)
        packed = sets.tobytes()
        return pa.array([packed[4 * a:4 * b].hex() for a, b in zip(bounds, bounds[1:])], pa.string())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, next(iter(columns))):
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names],
                     *[pa.concat_arrays([pa.array([], pa.string()), *[
                         prints(text_of(piece, c)) for piece in chunks(part, c)]])
                       for c in columns]], names=[*names, *columns.values()])

    return rest.mapInArrow(run, _with_fields(rest, columns.values(), StringType()))


def likeness(docs: DataFrame, pairs: dict[str, tuple[str, str]], floor: float = 0.0) -> DataFrame:
    """``docs`` with the similarity of pairs of fingerprint columns (name to the two columns)."""
    rest = docs.drop(*pairs)
    names = rest.columns

    def sets(batch: pa.RecordBatch, column: str) -> list[np.ndarray]:
        return [np.frombuffer(bytes.fromhex(x or ""), ">u4") for x in
                batch.column(column).to_pylist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, next(iter(pairs.values()))[0]):
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names],
                     *[pa.array([jaccard(a, b, floor) for a, b in
                                 zip(sets(part, left), sets(part, right))], pa.float64())
                       for left, right in pairs.values()]], names=[*names, *pairs])

    return rest.mapInArrow(run, _with_fields(rest, pairs, DoubleType()))


def _with_fields(df: DataFrame, names, kind) -> StructType:
    return StructType([*df.schema.fields, *[StructField(n, kind) for n in names]])


def length_partition(size: str, floor: float) -> Column:
    """Number of a set's length partition: a pair at ``floor`` is in equal or adjacent ones."""
    return F.floor(F.log(F.greatest(F.col(size), F.lit(1)).cast("double"))
                   / math.log(1 / floor) + 1e-9).cast("int")


def similar_prints(prints: DataFrame, floor: float = 0.8) -> DataFrame:
    """Pairs of different fingerprints with similarity of at least ``floor``.

    ``prints`` has one row per different ``fingerprint``. Candidates share one of the signatures
    that a set must have in common with any set it is that similar to (its rarest ones, by the
    number of sets that hold them), and lie in equal or adjacent length partitions.
    """
    sets = prints.where("fingerprint <> ''").select("fingerprint").distinct().select(
        "fingerprint", (F.length("fingerprint") / 8).cast("int").alias("n"))
    sets = kept(sets.withColumn("part", length_partition("n", floor)), "spots")
    spots = sets.select("fingerprint", "n", "part", F.explode(F.expr(
        "transform(sequence(0, n - 1), i -> substr(fingerprint, 8 * i + 1, 8))")).alias("spot"))
    counts = spots.groupBy("spot").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    placed = spots.join(counts, "spot", "left").withColumn("rank", F.row_number().over(
        Window.partitionBy("fingerprint").orderBy(F.coalesce("sets", F.lit(1)), "spot")))
    rare = placed.where(
        (F.col("rank") <= F.col("n") - F.ceil(F.col("n") * floor) + 1) & F.col("sets").isNotNull())
    rare = kept(rare.select("fingerprint", "n", "part", "spot"), "spot-index")
    a, b = rare.alias("a"), rare.alias("b")
    pairs = a.join(b, (F.col("a.spot") == F.col("b.spot"))
                   & (F.col("b.part") - F.col("a.part")).isin(0, 1)
                   & (F.col("a.n") >= floor * F.col("b.n")) & (F.col("b.n") >= floor * F.col("a.n"))
                   & ((F.col("a.part") < F.col("b.part"))
                      | (F.col("a.fingerprint") < F.col("b.fingerprint"))))
    pairs = pairs.select(F.col("a.fingerprint").alias("left"),
                         F.col("b.fingerprint").alias("right")).distinct()
    return likeness(pairs, {"similarity": ("left", "right")}, floor).where(
        F.col("similarity") >= floor)


def with_next(docs: DataFrame, into: str = "next_text") -> DataFrame:
    """``doc_id``, ``text`` and the text of the next document, by ascending id (after the last:
    the first; equal ids by text). NULL texts count as empty, NULL ids come first.

    Ids are cut into ranges at approximate quantiles, and every range is sorted by itself. The
    first document of a range is sent to the range before as well, and that of the first range
    to the last, so texts are shuffled once and no task sees more than a range.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    many = 4 * max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cuts = rows.agg(F.percentile_approx(
        "doc_id", [i / many for i in range(1, many)], 20 * many)).first()[0]
    numbered = rows.withColumn("part", _range_of("doc_id", sorted(set(cuts or []))))
    # one row per range: its first id, and the range that needs this document too
    order = Window.orderBy("part")
    heads = kept(numbered.groupBy("part").agg(
        F.when(F.max(F.col("doc_id").isNull()), None).otherwise(F.min("doc_id")).alias("head"))
        .select("part", "head", F.lag("part").over(order).alias("before"),
                F.max("part").over(Window.partitionBy()).alias("end"))
        .select("part", "head", F.coalesce("before", "end").alias("to"),
                F.when(F.col("before").isNull(), 2).otherwise(1).alias("turn")), "range-heads")
    marked = numbered.join(F.broadcast(heads), "part")
    sent = marked.withColumn("copy", F.explode(F.when(
        F.col("doc_id").eqNullSafe(F.col("head")),
        F.array(F.struct("part", F.lit(0).alias("turn")), F.struct(F.col("to").alias("part"), "turn")))
        .otherwise(F.array(F.struct("part", F.lit(0).alias("turn")))))).select(
        "doc_id", "text", "copy.*")
    here = Window.partitionBy("part").orderBy("turn", F.col("doc_id").asc_nulls_first(), "text")
    return sent.withColumn(into, F.lead("text").over(here)).where("turn = 0").select(
        "doc_id", "text", into)


def _range_of(column: str, cuts: list[int]) -> Column:
    """How many cuts are at or below the value, found in two short steps; 0 for NULL."""
    step = max(1, math.isqrt(len(cuts)))
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    if not groups:
        return F.lit(0)
    below = lambda c: c <= F.col(column)
    group = F.size(F.filter(F.lit([g[0] for g in groups]), below))
    inside = F.size(F.filter(F.get(F.lit(groups), F.greatest(group - 1, F.lit(0))), below))
    return F.when(F.col(column) >= cuts[0], (group - 1) * step + inside).otherwise(0)
