"""Forecasts as tables of class probabilities: priors, averages, ensembles, scores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.functions.expr import all_present, ratio, recode_label, row_sum
from foldcast.operators.joins import lookup_join
from foldcast.operators.mix import class_mix

PROB_FLOOR = 1e-15


def prior_forecast(rows: DataFrame, prior: DataFrame) -> DataFrame:
    """The same prior for every row: its one row of numbers becomes literals, so no join."""
    shares = prior.first().asDict()
    return rows.select("*", *[F.lit(p).cast("double").alias(c) for c, p in shares.items()])


def frequency_forecast(labelled: DataFrame, rows: DataFrame, keys: Sequence[str], label: str,
                       classes: Sequence[str], salt_on: Sequence[str]) -> DataFrame:
    """Class shares of the same fold and key as probabilities; needs no learner.

    ``rows`` are out-of-fold rows, so their ``fold`` is never their own. A key the fold has not
    seen falls back to the fold's overall shares (one row per fold, broadcast).
    """
    mix = class_mix(labelled, ["fold", *keys], label, classes, prefix="_k_")
    overall = class_mix(labelled, ["fold"], label, classes, prefix="_f_")
    joined = lookup_join(rows, mix, ["fold", *keys], salt_on).join(
        F.broadcast(overall), "fold", "left"
    )
    return joined.selectExpr(
        *rows.columns, *[f"coalesce(`_k_{c}`, `_f_{c}`) as `{c}`" for c in classes]
    )


def fold_average(probs: DataFrame, classes: Sequence[str], key: str = "row_no") -> DataFrame:
    """Mean of the fold predictions per row and class."""
    return probs.groupBy(key).agg(*[F.avg(c).alias(c) for c in classes])


def normalise(probs: DataFrame, classes: Sequence[str]) -> DataFrame:
    """Scale each row's probabilities to sum 1."""
    total = row_sum(classes)
    return _scaled(probs, classes, total)


def ensemble(p: DataFrame, q: DataFrame, classes: Sequence[str], how: str = "mean",
             key: str = "row_no") -> DataFrame:
    """Two forecasts into one: arithmetic mean, or geometric mean scaled to sum 1."""
    right = q.select(key, *classes).withColumnsRenamed({c: f"_q_{c}" for c in classes})
    both = p.select(key, *classes).join(right, key)
    if how == "mean":
        return both.selectExpr(key, *[f"(`{c}` + `_q_{c}`) / 2 as `{c}`" for c in classes])
    if how != "geometric":
        raise ValueError(f"how must be 'mean' or 'geometric', not {how!r}")
    roots = both.selectExpr(key, *[f"sqrt(`{c}` * `_q_{c}`) as `{c}`" for c in classes])
    # NULL counts as zero in the row total
    return _scaled(roots, classes, row_sum(classes, skip_null=True))


def _scaled(probs: DataFrame, classes: Sequence[str], total: Column) -> DataFrame:
    scaled = set(classes)
    return probs.withColumn("_total", total).selectExpr(*[
        f"{ratio(f'`{c}`', '_total')} as `{c}`" if c in scaled else f"`{c}`"
        for c in probs.columns
    ])


def _true_prob(label: str, classes: Sequence[str]) -> Column:
    probs = F.array(*[F.col(c) for c in classes])
    return F.try_element_at(probs, (F.col(label) + 1).cast("int"))


def row_logloss(label: str, classes: Sequence[str]) -> Column:
    return -F.log(F.greatest(_true_prob(label, classes), F.lit(PROB_FLOOR)))


def logloss(df: DataFrame, label: str, classes: Sequence[str], by: Sequence[str] = (),
            ) -> DataFrame:
    """Mean multi-class log loss over labelled rows."""
    rows = df.where(all_present([label]))
    return rows.groupBy(*by).agg(F.avg(row_logloss(label, classes)).alias("logloss"))


def error_rate(df: DataFrame, label: str, classes: Sequence[str], by: Sequence[str] = (),
               ) -> DataFrame:
    """Share of rows whose true class is not strictly the most likely (a tie is an error)."""
    true = _true_prob(label, classes)
    rivals = row_sum([F.when(F.col(c) >= true, 1).otherwise(0) for c in classes])
    rows = df.where(all_present([label]))
    wrong = F.avg(F.when(rivals > 1, 1.0).otherwise(0.0))
    return rows.groupBy(*by).agg(wrong.alias("error_rate"))


def binary_logloss(df: DataFrame, label: str, prob: str) -> DataFrame:
    p = F.least(F.greatest(F.col(prob), F.lit(PROB_FLOOR)), F.lit(1 - PROB_FLOOR))
    loss = F.when(F.col(label) == 1, -F.log(p)).otherwise(-F.log(1 - p))
    return df.where(all_present([label])).agg(F.avg(loss).alias("binary_logloss"))


def rmse(df: DataFrame, label: str, prediction: str) -> DataFrame:
    miss = F.col(label) - F.col(prediction)
    return df.agg(F.sqrt(F.avg(miss * miss)).alias("rmse"))


def coarse_label(df: DataFrame, label: str, lookup: Sequence[int], name: str) -> DataFrame:
    """Add the label coarsened by a lookup list."""
    return df.withColumn(name, recode_label(label, lookup))
