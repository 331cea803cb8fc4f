"""CSV and Parquet sources and sinks with declared schemas."""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldcast.operators.joins import stored
from foldcast.vocabulary import ACTOR_COLUMNS, EVENT_COLUMNS, LABELS

#: Column for a line that cannot be read.
BROKEN = "_broken_line"
#: Files that a task of a partitioned write keeps open, and the setting that allows them.
OPEN_FILES = 8
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
_open_files = threading.Lock()


def schema_of(columns: dict[str, tuple[str, str]], without: Sequence[str] = ()) -> str:
    """DDL of a source file: source column names with declared types."""
    return ", ".join(
        f"`{source}` {kind}" for source, (name, kind) in columns.items() if name not in without
    )


def to_names(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """Rename source columns to the names used here."""
    return df.withColumnsRenamed({source: name for source, (name, _) in columns.items()})


def read_events(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """Event log CSV with header; the unlabelled file lacks the two label columns."""
    schema = schema_of(EVENT_COLUMNS, () if labelled else LABELS)
    raw = spark.read.schema(schema).csv(path, header=True, enforceSchema=False)
    return to_names(raw, EVENT_COLUMNS)


def read_actors(spark: SparkSession, path: str) -> DataFrame:
    """Yearly actor table CSV with header."""
    raw = spark.read.schema(schema_of(ACTOR_COLUMNS)).csv(path, header=True, enforceSchema=False)
    return to_names(raw, ACTOR_COLUMNS)


def read_events_checked(spark: SparkSession, path: str, labelled: bool = True,
                        ) -> tuple[DataFrame, DataFrame]:
    """Event log CSV with header, and apart from it the lines that do not fit its columns.

    A line with too few or too many fields, or with a field that is no value of its column's type,
    is quarantined whole, with the name of its file. No line is lost: the two tables hold all of
    them. The lines are stored once, as a text file has to be parsed to tell them apart.
    """
    schema = schema_of(EVENT_COLUMNS, () if labelled else LABELS)
    raw = spark.read.schema(f"{schema}, `{BROKEN}` string").csv(
        path, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN)
    held, _ = stored(raw.withColumn("_file", F.col("_metadata.file_name")))
    good = to_names(held.where(F.col(BROKEN).isNull()).drop(BROKEN, "_file"), EVENT_COLUMNS)
    bad = held.where(F.col(BROKEN).isNotNull()).select(
        F.col("_file").alias("file"), F.col(BROKEN).alias("line"))
    return good, bad


def number_unlabelled(test: DataFrame, after: int) -> DataFrame:
    """Shift the row numbers of the unlabelled file so that they follow the labelled rows."""
    return test.withColumn("row_no", F.col("row_no") + F.lit(after + 1).cast("bigint"))


def read_probs(spark: SparkSession, path: str, classes: Sequence[str]) -> DataFrame:
    """Header-less forecast CSV: row index, then one column per class."""
    schema = ", ".join(["index bigint", *[f"`{c}` double" for c in classes]])
    return spark.read.schema(schema).csv(path, header=False)


def write_submission(probs: DataFrame, path: str, classes: Sequence[str], offset: int = 0) -> None:
    """Header-less forecast CSV, indexed from the first unlabelled row.

    The files are range-sorted by index, so reading them in name order keeps the row order.
    The forecast is stored first: finding the ranges would otherwise compute it twice.
    """
    rows, _ = stored(probs.select((F.col("row_no") - F.lit(offset)).alias("index"), *classes))
    rows.orderBy("index").write.mode("overwrite").csv(path, header=False)


def write_table(df: DataFrame, path: str, parts: Sequence[str] = ()) -> None:
    """Parquet table, partitioned by columns such as model and fold.

    A task keeps a file open for every value of few parts, so that its rows, which may be hundreds of
    columns wide, are not sorted and spilled only to part them. With more than ``OPEN_FILES`` values
    Spark sorts the rows that are left.
    """
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option(
        "compression", "zstd")
    if not parts:
        writer.parquet(path)
        return
    conf = df.sparkSession.conf
    with _open_files:  # the setting is the session's
        before = conf.get(WRITERS, None)
        conf.set(WRITERS, OPEN_FILES)
        try:
            writer.partitionBy(*parts).parquet(path)
        finally:
            conf.unset(WRITERS) if before is None else conf.set(WRITERS, before)


def table_path(root: str, stage: str, model_no: str | None = None, fold: int | None = None) -> str:
    """Where the artefacts of a stage live; model and fold are partition folders."""
    path = f"{root.rstrip('/')}/{stage}"
    if model_no is not None:
        path += f"/model_no={model_no}"
    return path if fold is None else f"{path}/fold={fold}"
