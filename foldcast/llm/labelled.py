"""Labelled rows to learn from: a bounded, fixed sample that never holds held-out documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bound of the sample, within four standard deviations; small enough to be broadcast.
TRAIN_ROWS = 40_000
FOLDS = 5


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0,
                      F.lit(False))


def training_labels(labels: DataFrame, column: str, max_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id`` and ``label`` of about ``max_rows`` labelled documents, or of all if fewer.

    Repeated rows of a document count once, with its highest label; NULL labels are left out.
    """
    rows = (
        labels.where(F.col(column).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max(F.col(column).cast("int")).alias("label"))
    )
    share = max_rows / max(1, rows.count())
    if share >= 1:
        return rows
    return rows.where(F.pmod(F.xxhash64(F.lit("train"), F.col("doc_id")), F.lit(1 << 30))
                      < int(share * (1 << 30)))


def with_labels(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """Documents of the sample with ``label``; the sample is bounded, so it is broadcast."""
    return docs.join(F.broadcast(sample), "doc_id")
