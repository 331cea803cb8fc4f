"""Tables laid out by key: bucketed and sorted, so that joins and groups on the key need no shuffle.

A table lives in a folder of its own and is known to the session's catalog under a name made of
that folder. The catalog may be lost with its session; the files carry their bucket numbers, so
``read_by_key`` makes the table known again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession


def _name(path: str) -> str:
    return "by_key_" + hashlib.sha256(path.encode()).hexdigest()[:24]


def write_by_key(df: DataFrame, path: str, key: str, buckets: int, mode: str = "overwrite") -> None:
    """Write ``df`` in ``buckets`` by ``key``; one file per bucket and call, sorted by the key.

    Tables that are to be joined need the same number of buckets. ``mode="append"`` adds rows (such
    as another fold's) to the same buckets.
    """
    spark = df.sparkSession
    if mode == "overwrite":
        spark.sql(f"drop table if exists {_name(path)}")
    df.repartition(buckets, key).write.mode(mode).format("parquet").bucketBy(buckets, key).sortBy(
        key).option("path", path).saveAsTable(_name(path))


def read_by_key(spark: SparkSession, path: str, key: str, buckets: int) -> DataFrame:
    """The table at ``path``; it has been written with these buckets."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{n}` {t}" for n, t in spark.read.parquet(path).dtypes)
        spark.sql(f"create table {name} ({columns}) using parquet clustered by (`{key}`)"
                  f" sorted by (`{key}`) into {buckets} buckets location '{path}'")
    return spark.table(name)
