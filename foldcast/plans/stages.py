"""A manifest of the stages of a run, by which a run that stopped goes on where it was.

Every stage writes its outcome first and its mark last: one row with the digest of all that the
outcome depends on. A stage whose mark holds the digest of this run is not done again; one
without a mark, or with another digest, is written anew. A digest covers the stages before it, so
a change of the input or of a parameter undoes all that follows from it and nothing else.
"""

from __future__ import annotations

import hashlib
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldcast.sources.files import table_path

MARK = "digest string, value string"


def table_digest(df: DataFrame) -> str:
    """Digest of a table's schema and rows, whatever their order: one aggregation."""
    hashes = [F.sum(F.xxhash64(F.lit(i), *df.columns).cast("decimal(38,0)")) for i in range(2)]
    found = df.agg(F.count(F.lit(1)), *hashes).first()
    return digest(df.dtypes, *found)


def digest(*parts) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()


class Stages:
    """The marks of a run under ``root``; small: one per stage, fold and part."""

    def __init__(self, spark: SparkSession, root: str, model_no: str):
        self.spark, self.root, self.model_no = spark, root, model_no
        self.ran: list[tuple[str, int, str]] = []
        self._lock = threading.Lock()
        self._marks = self._read()

    @property
    def folder(self) -> str:
        return table_path(self.root, "manifest", self.model_no)

    def _read(self) -> dict[tuple[str, int, str], tuple[str, str | None]]:
        # a folder without marks is made so that there is something to read
        empty = self.spark.createDataFrame([], f"stage string, fold int, part string, {MARK}")
        empty.coalesce(1).write.mode("append").partitionBy("stage", "fold", "part").parquet(self.folder)
        marks = self.spark.read.schema(f"{MARK}, stage string, fold int, part string").parquet(self.folder)
        return {(r["stage"], r["fold"], r["part"]): (r["digest"], r["value"]) for r in marks.collect()}

    def path(self, stage: str, fold: int = 0, part: str = "all") -> str:
        """Where the outcome of a stage lives."""
        return f"{table_path(self.root, stage, self.model_no, fold)}/part={part}"

    def once(self, stage: str, wanted: str, job: Callable[[str], object], fold: int = 0,
             part: str = "all") -> str:
        """Run ``job`` with the stage's path unless it is done; returns the path."""
        where = self.path(stage, fold, part)
        self.value(stage, wanted, lambda: job(where) and None, fold, part)
        return where

    def value(self, stage: str, wanted: str, job: Callable[[], object], fold: int = 0,
              part: str = "all") -> str | None:
        """The small outcome of a stage, which is kept in its mark."""
        key = (stage, fold, part)
        held = self._marks.get(key)
        if held is not None and held[0] == wanted:
            return held[1]
        found = job()
        told = None if found is None else str(found)
        mark = self.spark.createDataFrame([(wanted, told)], MARK)
        # a folder of its own, so that stages that end at the same time do not meet
        mark.coalesce(1).write.mode("overwrite").parquet(
            f"{self.folder}/stage={stage}/fold={fold}/part={part}")
        with self._lock:
            self._marks[key] = (wanted, told)
            self.ran.append(key)
        return told
