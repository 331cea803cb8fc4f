"""One stored vector table for all fits of a fold: medians and gaps are learnt once.

Models take their columns from it by slot. Every column has a slot, and a second one that flags its
gaps if it has any in the training rows of some fold.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler, VectorSlicer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLAG = "_missing"


@dataclass(frozen=True)
class Vectors:
    """Rows with their ``features`` vector, and the names of its slots."""

    rows: DataFrame
    slots: tuple[str, ...]

    def of(self, fold: int) -> DataFrame:
        return self.rows.where(F.col("fold") == fold)

    def chosen(self, features: Sequence[str]) -> list[str]:
        """Slots of the features, their flags included, in the order of the table."""
        wanted = set(features)
        return [s for s in self.slots if s.removesuffix(FLAG) in wanted]

    def pick(self, rows: DataFrame, features: Sequence[str]) -> DataFrame:
        """``rows`` with the vector of these features alone."""
        chosen = self.chosen(features)
        if chosen == list(self.slots):
            return rows
        indices = [self.slots.index(s) for s in chosen]
        sliced = VectorSlicer(inputCol="features", outputCol="_picked", indices=indices).transform(rows)
        return sliced.drop("features").withColumnRenamed("_picked", "features")

    def widened(self, rows: DataFrame, columns: Sequence[str], path: str) -> "Vectors":
        """Store ``rows`` (of all folds) with further columns, whose values join the vector."""
        wide = VectorAssembler(inputCols=["features", *columns], outputCol="_wide").transform(rows)
        wide = wide.drop("features").withColumnRenamed("_wide", "features")
        wide.write.mode("overwrite").partitionBy("fold").parquet(path)
        return Vectors(rows.sparkSession.read.parquet(path), (*self.slots, *columns))


def gaps_and_medians(wide: DataFrame, features: Sequence[str], labels: Sequence[str],
                     folds: Sequence[int]) -> DataFrame:
    """One row per fold: the medians of all features and their numbers of NULLs, over the rows that
    have a label."""
    typed = wide.where(F.coalesce(*labels).isNotNull()).selectExpr(
        "fold", *[f"cast(`{c}` as double) as `{c}`" for c in features])
    return typed.groupBy("fold").agg(
        F.array(*[F.coalesce(F.percentile_approx(c, 0.5, 1000), F.lit(0.0)) for c in features])
        .alias("_medians"),
        F.array(*[F.count_if(F.col(c).isNull()) for c in features]).alias("_gaps"))


def store_vectors(wide: DataFrame, features: Sequence[str], labels: Sequence[str],
                  folds: Sequence[int], path: str) -> Vectors:
    """Write ``wide`` as vectors by fold and return them; one aggregation and one pass."""
    features = list(features)
    learnt = gaps_and_medians(wide, features, labels, folds).collect()  # one row per fold
    flagged = [c for i, c in enumerate(features) if any(r["_gaps"][i] for r in learnt)]
    table = wide.sparkSession.createDataFrame(
        [(r["fold"], list(r["_medians"])) for r in learnt], "fold int, _medians array<double>")
    joined = wide.where(F.col("fold").isin(list(folds))).join(F.broadcast(table), "fold", "left")
    filled = joined.selectExpr(
        "row_no", "fold", *labels,
        *[f"coalesce(cast(`{c}` as double), _medians[{i}], 0D) as `_x{i}`"
          for i, c in enumerate(features)],
        *[f"cast(`{c}` is null as double) as `_m{i}`" for i, c in enumerate(flagged)])
    inputs = [f"_x{i}" for i in range(len(features))] + [f"_m{i}" for i in range(len(flagged))]
    VectorAssembler(inputCols=inputs, outputCol="features").transform(filled).select(
        "row_no", "fold", *labels, "features").write.mode("overwrite").partitionBy("fold").parquet(path)
    return read_vectors(wide.sparkSession, path, [*features, *[c + FLAG for c in flagged]])


def read_vectors(spark, path: str, slots: Sequence[str]) -> Vectors:
    return Vectors(spark.read.parquet(path), tuple(slots))
