"""Joins that hold up when one key carries a large share of the rows.

``lookup_join`` measures the lookup side and broadcasts it only under a byte bound. Past the
bound it becomes ``spread_join``: a shuffled join in which every heavy key is dealt out over
several slots, so that no task receives more than about ``HEAVY_ROWS`` rows of one key.
"""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.observation import Observation
from pyspark.sql.types import StringType
from pyspark.util import inheritable_thread_target

from foldcast.functions.expr import all_present

BROADCAST_BYTES = 64 << 20
HEAVY_ROWS = 5_000_000
#: A NULL key matches nothing, so its rows may lie anywhere: as many slots as an int can number.
NULL_SLOTS = (1 << 31) - 1


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared scratch folder, from ``spark.checkpoint.dir``.

    Only a local session may do without: its driver is its only executor, so a folder named after
    the application serves, which is removed when the process ends.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = os.path.join(tempfile.gettempdir(),
                              f"foldcast-{spark.sparkContext.applicationId}")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), f"{name}-{uuid.uuid4().hex}")


def _row_bytes(df: DataFrame):
    """Upper estimate of the in-memory size of flat rows, summed."""
    texts = [
        f" + coalesce(octet_length(`{f.name}`), 0)"
        for f in df.schema.fields if isinstance(f.dataType, StringType)
    ]
    return F.expr(f"sum(cast({16 * len(df.columns) + 16}{''.join(texts)} as bigint))")


def stored(df: DataFrame) -> tuple[DataFrame, int]:
    """Write a derived table to the shared folder once; return it with its measured bytes."""
    shared_folder(df.sparkSession)
    seen = Observation()
    kept = df.observe(seen, _row_bytes(df).alias("bytes")).checkpoint()
    return kept, seen.get.get("bytes") or 0


def stored_arrays(df: DataFrame, keys: Sequence[str], part: str, parts: Sequence, name: str,
                  wanted: DataFrame | None = None, wanted_bytes: int = 0) -> tuple[DataFrame, int]:
    """Store a table that is unique on ``keys`` and ``part`` with one row per ``keys``: column
    ``name`` is an array with a struct of the other columns for each of the few ``parts`` (NULL
    where there is none). Returns it with the bytes of the rows that went in. Rows whose keys are
    not in ``wanted`` (a stored table of ``wanted_bytes``), where it is given, are left out.

    The rows are dealt by ``keys`` before they are sorted and grouped: a task that makes many wide
    rows out of a few narrow ones passes them on one by one, and only the tasks behind the
    shuffle, which follow its bytes in number, hold theirs to sort them.
    """
    shared_folder(df.sparkSession)
    seen = Observation()
    held = F.struct(*[c for c in df.columns if c not in {*keys, part}])
    entries = [F.max(F.when(F.col(part) == p, held)) for p in parts]
    if wanted is not None:
        small = wanted_bytes <= BROADCAST_BYTES
        df = df.join(F.broadcast(wanted) if small else wanted, list(keys), "left_semi")
    dealt = df.observe(seen, _row_bytes(df).alias("bytes")).repartition(*keys)
    grouped = dealt.groupBy(*keys).agg(F.array(*entries).alias(name))
    kept = grouped.checkpoint()
    return kept, seen.get.get("bytes") or 0


def measured(df: DataFrame) -> tuple[DataFrame, int]:
    """The same for a table that is already stored: one narrow pass instead of a copy."""
    return df, df.agg(_row_bytes(df)).first()[0] or 0


def lookup_join(df: DataFrame, lookup: DataFrame, keys: Sequence[str], salt_on: Sequence[str],
                derived: bool = True, max_bytes: int | None = None) -> DataFrame:
    """Left join to a lookup table that is unique on ``keys``.

    ``derived`` lookups (the outcome of an aggregation) are stored first, so that measuring
    them does not compute them twice. ``salt_on`` names columns that identify a row of ``df``.
    """
    lookup, size = stored(lookup) if derived else measured(lookup)
    return sized_join(df, lookup, size, keys, salt_on, max_bytes)


def sized_join(df: DataFrame, lookup: DataFrame, size: int, keys: Sequence[str],
               salt_on: Sequence[str], max_bytes: int | None = None,
               counts: DataFrame | None = None) -> DataFrame:
    """``lookup_join`` for a lookup whose bytes are already known."""
    if size <= (BROADCAST_BYTES if max_bytes is None else max_bytes):
        return df.join(F.broadcast(lookup), list(keys), "left")
    return spread_join(df, lookup, keys, salt_on, counts)


def laid_near(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The rows of each partition in the order of ``cols``, also where a join follows: Spark leaves
    out a sort below a join, but not one whose rows are observed. Columns that are not needed should
    be gone from ``df``, as they are not pruned below an observation either."""
    return df.sortWithinPartitions(*cols).observe(Observation(), F.count(F.lit(1)).alias("rows"))


def side_by_side(spark: SparkSession, jobs: Sequence[Callable], parallelism: int = 1) -> list:
    """Run independent Spark jobs, one after the other unless ``parallelism`` asks for threads."""
    shared_folder(spark)
    if parallelism <= 1:
        return [job() for job in jobs]
    bound = [inheritable_thread_target(spark)(job) for job in jobs]
    with ThreadPool(min(parallelism, len(bound))) as pool:
        return pool.map(lambda job: job(), bound)


def spread_join(df: DataFrame, lookup: DataFrame, keys: Sequence[str], salt_on: Sequence[str],
                counts: DataFrame | None = None, heavy_rows: int | None = None) -> DataFrame:
    """Left join that deals the rows of each heavy key out over several slots.

    ``counts`` (``keys`` plus ``n``) is the number of ``df`` rows per key, where it is already
    known or can be had from something narrower than ``df``.
    The list of heavy keys has at most rows / ``heavy_rows`` entries; it is measured, and
    broadcast where it is small.
    """
    keys = list(keys)
    heavy_rows = heavy_rows or HEAVY_ROWS
    if counts is None:
        counts = df.where(all_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    heavy, size = stored(counts.where(F.col("n") > heavy_rows).select(
        *keys, F.ceil(F.col("n") / F.lit(heavy_rows)).cast("int").alias("_slots")))
    if size <= BROADCAST_BYTES:
        heavy = F.broadcast(heavy)
    slots = F.when(~all_present(keys), NULL_SLOTS).otherwise(F.coalesce("_slots", F.lit(1)))
    # the partition number parts exact copies of a row, and stays the same when a task is rerun
    salt = F.pmod(F.xxhash64(*salt_on, F.spark_partition_id()), slots).cast("int")
    left = df.join(heavy, keys, "left").withColumn("_slot", salt).drop("_slots")
    right = (
        lookup.join(heavy, keys, "left")
        .withColumn(
            "_slot",
            F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_slots"), F.lit(1)) - 1)),
        )
        .drop("_slots")
    )
    return left.join(right, [*keys, "_slot"], "left").drop("_slot")


def group_stats(df: DataFrame, keys: Sequence[str], stats: dict, salt_on: Sequence[str],
                ) -> DataFrame:
    """Attach whole-group aggregates to every row: pre-aggregated, then looked up.

    ``stats`` maps new column names to aggregate Columns. Rows with a NULL key get NULL.
    """
    table = df.where(all_present(keys)).groupBy(*keys).agg(
        *[c.alias(n) for n, c in stats.items()]
    )
    return lookup_join(df, table, keys, salt_on)


def fan_out(df: DataFrame, dim: Sequence[tuple], key: str | None, name: str) -> DataFrame:
    """One row per entry of a small literal dimension.

    With ``key``: a full outer join, so rows whose key is not in the dimension keep a NULL and
    dimension entries that no row has appear once with NULL elsewhere. Without ``key``: every
    row meets every entry. Both are narrow: the dimension is an array inside the row.
    """
    if key is None:
        return df.select("*", F.explode(F.array(*[F.lit(v) for v in dim])).alias(name))
    entries = {}
    for k, v in dim:
        entries.setdefault(k, []).append(v)
    choices = F.lit(None).cast("array<string>")
    for k, values in entries.items():
        choices = F.when(F.col(key) == k, F.array(*[F.lit(v) for v in values])).otherwise(choices)
    matched = df.select("*", F.explode_outer(choices).alias(name))
    found = df.where(F.col(key).isin(list(entries))).select(key).distinct()
    unused = (
        hand_dim(df.sparkSession, dim, key, name)
        .join(F.broadcast(found), key, "left_anti")  # found has at most one row per entry
    )
    return matched.unionByName(unused, allowMissingColumns=True)


def hand_dim(spark: SparkSession, rows: Sequence[tuple], key: str, name: str) -> DataFrame:
    """A literal dimension table with a declared schema."""
    return spark.createDataFrame(list(rows), f"{key} string, {name} string")


def append_unlabelled(train: DataFrame, test: DataFrame) -> DataFrame:
    """Stack labelled and unlabelled rows; columns missing on one side become NULL."""
    return train.unionByName(test, allowMissingColumns=True)


def attach_predictions(df: DataFrame, probs: DataFrame, keys: Sequence[str] = ("fold", "row_no"),
                       how: str = "left") -> DataFrame:
    """Glue predictions to rows by key; both sides hold each key once."""
    return df.join(probs, list(keys), how)
