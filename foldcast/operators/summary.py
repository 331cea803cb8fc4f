"""Frequency tables, priors and column profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first; NULL is left out."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), col)


def class_prior(df: DataFrame, label: str, classes: Sequence[str]) -> DataFrame:
    """Share of each class over all rows, as one row; rows without a label count in the total.
    Class i is the label value i."""
    return df.agg(
        *[F.expr(f"count_if(`{label}` = {i}) / count(1) as `{c}`")
          for i, c in enumerate(classes)]
    )


def top_n(df: DataFrame, col: str, n: int, tie: str) -> DataFrame:
    """The n rows with the largest ``col``; ``tie`` settles equal values."""
    return df.orderBy(F.desc(col), F.asc(tie)).limit(n)


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type and number of non-NULL values of every column, counted in one pass."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    rows = F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(t).alias("type"), F.col(c).alias("non_null"))
        for c, t in df.dtypes
    ])
    return counts.select(F.inline(rows))


def column_means(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.agg(*[F.avg(c).alias(c) for c in cols])


def importance_all(imp: DataFrame, folds: Sequence[int]) -> DataFrame:
    """Importance per fold side by side and summed, for features present in every fold."""
    wide = imp.groupBy("feat_name").pivot("fold", list(folds)).agg(F.sum("feat_imp"))
    named = wide.select(
        "feat_name", *[F.col(str(k)).cast("double").alias(f"feat_imp_{k}") for k in folds]
    ).dropna()
    total = reduce(lambda a, b: a + b, [F.col(f"feat_imp_{k}") for k in folds])
    return named.withColumn("sum", total).orderBy(F.desc("sum"), "feat_name")


def select_features(df: DataFrame, importance: DataFrame, keep_n: int,
                    always: Sequence[str] = ()) -> DataFrame:
    """Keep the ``keep_n`` most important feature columns; at most ``keep_n`` names are read."""
    top = top_n(importance, "sum", keep_n, "feat_name").select("feat_name")
    best = {r[0] for r in top.collect()}
    return df.select(*[c for c in df.columns if c in best or c in always])
