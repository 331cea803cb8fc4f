"""Tables written once to the cluster's shared folder, and distributed running totals."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foldcast.llm.words import CHUNK_BYTES
from foldcast.operators.joins import scratch_path

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"

#: Rows of a narrow table that are worth a file of their own.
FILE_ROWS = 200_000


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs inside hand tasks Arrow batches of about the bytes that they work on at once.

    By default a batch holds 10,000 rows: with long texts a multiple of that, once in the JVM and
    once in the Python worker. A limit that the session has already stays.
    """
    mine = spark.conf.get(BATCH_BYTES, None) is None
    if mine:
        spark.conf.set(BATCH_BYTES, CHUNK_BYTES)
    try:
        yield
    finally:
        if mine:
            spark.conf.unset(BATCH_BYTES)


def kept(df: DataFrame, name: str, rows: int | None = None) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: cuts lineage, survives lost executors.

    ``rows``, a bound on the rows of a narrow table, keeps a small one from being strewn over as
    many files as the session has shuffle partitions.
    """
    path = scratch_path(df.sparkSession, name)
    if rows is not None:
        df = df.coalesce(1 + rows // FILE_ROWS)
    with small_batches(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def running_totals(df: DataFrame, order: Sequence[Column], totals: dict[str, Column],
                   name: str) -> DataFrame:
    """``df`` with exact running totals over a global order, without a task that sees all rows.

    The rows are range-sorted once and written with the number of their range. A range's start
    is the sum of the ranges before it (one row per range), its rows add up in a local window.
    Each total includes its own row; rows equal in ``order`` get some fixed order.
    """
    ranged = df.select("*", *[c.alias(f"_by{i}") for i, c in enumerate(order)],
                       *[c.alias(f"_add_{n}") for n, c in totals.items()])
    by = [f"_by{i}" for i in range(len(order))]
    placed = kept(ranged.repartitionByRange(*[F.col(c).asc_nulls_last() for c in by])
                  .withColumn("_range", F.spark_partition_id()), name)
    sums = placed.groupBy("_range").agg(*[F.sum(f"_add_{n}").alias(f"_sum_{n}") for n in totals])
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_range", *[
        F.coalesce(F.sum(f"_sum_{n}").over(before), F.lit(0)).alias(f"_start_{n}")
        for n in totals])
    here = (Window.partitionBy("_range").orderBy(*[F.col(c).asc_nulls_last() for c in by])
            .rowsBetween(Window.unboundedPreceding, 0))
    # one row per range of the sort: the broadcast is as long as the list of partitions
    return (
        placed.withColumns({f"_here_{n}": F.sum(f"_add_{n}").over(here) for n in totals})
        .join(F.broadcast(starts), "_range")
        .select(*df.columns, *[(F.col(f"_start_{n}") + F.col(f"_here_{n}")).alias(n)
                               for n in totals])
    )


def aside(docs: DataFrame, needed: Sequence[str]) -> tuple[DataFrame, Callable]:
    """``docs`` with every column but ``needed`` under a name that no operator uses, and the way
    back to the columns of ``docs`` and named new ones: extra columns then clash with nothing."""
    names = {c: c if c in needed else f"_aside{i}" for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return renamed, lambda df, *new: df.select(
        *[F.col(n).alias(c) for c, n in names.items()], *new)
