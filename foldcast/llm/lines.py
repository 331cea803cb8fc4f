"""Removal of lines that many documents share.

Hashes of line keys are range-partitioned together with document and position, and sorted. Each
task streams its range: it counts a key's documents and emits the lines to drop. A key that
crosses a border between ranges is settled from at most two short summaries per range. What
comes back is one compressed keep bitmap per document that loses lines, never text; the bitmaps
are then joined to the documents.

A line's key is the line without ``[\\x20\\x09-\\x0D]`` at both ends, with A-Z in lower case.
Defined results: a NULL or empty text is one empty line; empty keys are never dropped; rows with
the same id and the same text are one document and get the same result; an empty table gives no
rows. Input columns named ``n_lines`` or ``n_dropped`` are replaced.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foldcast.llm.scratch import aside, kept
from foldcast.llm.words import chunks

SPACE = " \t\n\x0b\x0c\r"
_RUN = "h1 long, h2 long, doc long, same long, pos int"


def line_key(line: str) -> Column:
    bare = F.btrim(F.col(line), F.lit(SPACE))
    return F.translate(bare, string.ascii_uppercase, string.ascii_lowercase)


def _identity() -> dict[str, Column]:
    """What tells documents apart: the id, and a digest of the text for ids that repeat."""
    return {"doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
            "same": F.xxhash64(F.col("doc_id").isNull(), F.coalesce("text", F.lit("")))}


def settle(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Stream sorted line keys; give the lines to drop and what is open at the borders.

    Rows out are the columns in plus ``docs``: NULL for a line that is dropped; 0 for a line of
    a key that touches a border and has too few documents so far; above 0 for the summary of
    such a key, with its number of documents here.
    """
    names = ["h1", "h2", "doc", "same", "pos"]
    held = np.empty((0, 5), np.int64)  # lines of the key being read while its fate is open
    docs, last, dropping, at_start = 0, None, False, True
    key = None

    def rows(data: np.ndarray, docs: int | None) -> pa.RecordBatch:
        columns = [pa.array(data[:, i]) for i in range(4)] + [pa.array(data[:, 4], pa.int32())]
        marks = pa.nulls(len(data), pa.int32()) if docs is None else pa.array(
            np.full(len(data), docs), pa.int32())
        return pa.RecordBatch.from_arrays([*columns, marks], names=[*names, "docs"])

    def summary() -> pa.RecordBatch:
        return rows(np.array([[*key, 0, 0, 0]], np.int64), docs)

    for batch in batches:
        data = np.column_stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names])
        if not len(data):
            continue
        starts = np.flatnonzero(np.r_[True, (data[1:, :2] != data[:-1, :2]).any(axis=1)])
        fresh = np.r_[True, (data[1:, :4] != data[:-1, :4]).any(axis=1)]
        counts = np.add.reduceat(fresh.astype(np.int64), starts)
        ends = np.r_[starts[1:], len(data)]
        first = 0
        if key is not None and tuple(data[0, :2]) == key:  # the open key goes on
            docs += int(counts[0]) - (tuple(data[0, 2:4]) == last)
            held = np.concatenate([held, data[:ends[0]]])
            first = 1
            if docs >= min_docs:
                yield rows(held, None)
                held, dropping = held[:0], True
        if first < len(starts):
            if key is not None:  # the open key has ended inside this range
                if at_start:
                    yield summary()
                    if len(held):
                        yield rows(held, 0)
                at_start = False
            inner = np.arange(first, len(starts) - 1)
            if key is None and len(inner):  # the range's first key is open to the left
                key, docs = tuple(data[0, :2]), int(counts[0])
                yield summary()
                yield rows(data[:ends[0]], None if docs >= min_docs else 0)
                inner, at_start = inner[1:], False
            elif key is not None:
                at_start = False
            many = inner[counts[inner] >= min_docs]
            if len(many):
                mask = np.zeros(len(starts), bool)
                mask[many] = True
                yield rows(data[np.repeat(mask, ends - starts)], None)
            key, docs = tuple(data[-1, :2]), int(counts[-1])
            held, dropping = data[starts[-1]:], False
            if docs >= min_docs:
                yield rows(held, None)
                held, dropping = held[:0], True
        last = tuple(data[-1, 2:4])
    if key is not None:
        yield summary()
        if len(held) and not dropping:
            yield rows(held, 0)


def keep_bitmaps(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """``doc``, ``same`` and ``bitmap`` for the documents that lose lines.

    A bitmap is deflated and has a set bit for each line kept, up to the last one dropped.
    """
    lines = docs.select(*[c.alias(n) for n, c in _identity().items()],
                        F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1))
                        .alias("pos", "line"))
    keyed = lines.withColumn("key", line_key("line")).where("key <> ''").select(
        F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), F.col("key")).alias("h2"),
        "doc", "same", "pos")
    # the range borders are found in a pass of their own, which reads these narrow rows
    keyed = kept(keyed, "line-keys")
    # a document's lines with one key stay together, so documents can be added up over ranges
    ranged = keyed.repartitionByRange("h1", "h2", "doc", "same").sortWithinPartitions(
        "h1", "h2", "doc", "same", "pos")
    found = kept(ranged.mapInArrow(lambda it: settle(it, min_docs), f"{_RUN}, docs int"),
                 "line-runs")
    shared = found.where("docs > 0").groupBy("h1", "h2").agg(F.sum("docs").alias("all_docs"))
    shared = shared.where(F.col("all_docs") >= min_docs).select("h1", "h2")
    rest = found.where("docs = 0").join(shared, ["h1", "h2"])
    dropped = found.where("docs is null").select("doc", "same", "pos").unionByName(
        rest.select("doc", "same", "pos"))
    lists = dropped.groupBy("doc", "same").agg(F.collect_set("pos").alias("positions"))
    return lists.mapInArrow(_pack, "doc long, same long, bitmap binary")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for positions in batch.column("positions"):
            dropped = positions.values.to_numpy()
            bits = np.ones((dropped.max() // 8 + 1) * 8, np.uint8)
            bits[dropped] = 0
            maps.append(zlib.compress(np.packbits(bits).tobytes(), 1))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc"), batch.column("same"), pa.array(maps, pa.binary())],
            names=["doc", "same", "bitmap"])


def _cut(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Apply the bitmaps: kept lines joined by a line break."""
    for batch in (part for whole in batches for part in chunks(whole, "text")):
        texts, drops = batch.column("text").to_pylist(), []
        totals = pc.add(pc.count_substring(pc.fill_null(batch.column("text"), ""), "\n"), 1)
        for i, packed in enumerate(batch.column("_bitmap").to_pylist()):
            if packed is None:
                drops.append(0)
                continue
            lines = (texts[i] or "").split("\n")
            bits = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8))[:len(lines)]
            keep = np.ones(len(lines), bool)
            keep[:len(bits)] = bits.astype(bool)
            texts[i] = "\n".join([lines[j] for j in np.flatnonzero(keep)])
            drops.append(int(len(lines) - keep.sum()))
        columns = [pa.array(texts, pa.string()) if n == "text" else batch.column(n) for n in names]
        yield pa.RecordBatch.from_arrays(
            [*columns, totals.cast(pa.int64()), pa.array(drops, pa.int64())],
            names=[*names, "n_lines", "n_dropped"])


def drop_shared_lines(docs: DataFrame, min_docs: int = 10) -> DataFrame:
    """``docs`` without the lines whose key is in at least ``min_docs`` documents.

    Adds ``n_lines`` (before) and ``n_dropped``. A NULL text stays NULL.
    """
    rest, back = aside(docs.drop("n_lines", "n_dropped"), ["doc_id", "text"])
    names = rest.columns
    bitmaps = keep_bitmaps(rest, min_docs).select(
        F.col("doc").alias("_doc"), F.col("same").alias("_same"),
        F.col("bitmap").alias("_bitmap"))
    marked = rest.withColumns({f"_{n}": c for n, c in _identity().items()}).join(
        bitmaps, ["_doc", "_same"], "left").select(*names, "_bitmap")
    schema = StructType(list(rest.schema.fields)).add("n_lines", "long").add("n_dropped", "long")
    return back(marked.mapInArrow(lambda it: _cut(it, names), schema), "n_lines", "n_dropped")
