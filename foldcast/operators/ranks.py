"""Exact ranks and quantiles without sorting any group in one task.

Both rest on ``cumulative_counts``: equal values are collapsed and stored first. The distinct
values of all parts are range-sorted together, so a large part lies in many ranges and a small one
in one; each range adds the row count of the earlier ranges of its part. How many ranges there are
follows from the size of the data by the session's own rules for shuffles.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldcast.functions.expr import all_present
from foldcast.operators.joins import spread_join, stored


def cumulative_counts(df: DataFrame, part: Sequence[str], value: str,
                      slices: int | None = None) -> DataFrame:
    """Per distinct (part, value): its row count ``n``, the rows with a smaller value
    ``n_before`` and the rows of the part ``n_part``. NULL values and keys are left out.

    ``df`` is read once. ``slices`` sets the number of ranges.
    """
    part = list(part)
    rows = df.where(all_present([*part, value]))
    values, _ = stored(rows.groupBy(*part, value).agg(F.count(F.lit(1)).alias("n")))
    wanted = [] if slices is None else [slices]
    ranged, _ = stored(values.repartitionByRange(*wanted, *part, value).withColumn(
        "_range", F.spark_partition_id()))
    sizes = ranged.groupBy(*part, "_range").agg(F.sum("n").alias("_rows"))
    # a part has at most as many rows in this window as there are ranges
    whole = Window.partitionBy(*part)
    ahead = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *part, "_range", F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_offset"),
        F.sum("_rows").over(whole).alias("n_part"))
    inside = (
        Window.partitionBy(*part, "_range").orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    local = ranged.withColumn("_local", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    return local.join(offsets, [*part, "_range"]).select(
        *part, value, "n", (F.col("_offset") + F.col("_local")).alias("n_before"), "n_part"
    )


def avg_rank(df: DataFrame, value: str, part: Sequence[str], salt_on: Sequence[str], name: str,
             descending: bool = True, slices: int | None = None) -> DataFrame:
    """Rank within ``part`` where ties share their mean rank and NULL stays NULL."""
    sign = -1 if descending else 1
    keyed = df.withColumn("_key", F.col(value).cast("double") * sign)
    counts, _ = stored(cumulative_counts(keyed, part, "_key", slices))
    keys = [*part, "_key"]
    ranks = counts.select(*keys, (F.col("n_before") + (F.col("n") + 1) / 2).alias(name))
    return spread_join(keyed, ranks, keys, salt_on, counts.select(*keys, "n")).select(
        *df.columns, name
    )


def _numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Long form (column, value) of numeric columns, one pass."""
    doubles = df.select(*[F.col(c).cast("double") for c in cols])
    return doubles.unpivot([], list(cols), "column", "value")


def exact_quantiles(long: DataFrame, probs: Sequence[float], names: Sequence[str],
                    slices: int | None = None) -> DataFrame:
    """Linearly interpolated quantiles per ``column`` of a long (column, value) table."""
    counts = cumulative_counts(long, ["column"], "value", slices)
    aggs, outs = [], []
    for q, name in zip(probs, names):
        at = (F.col("n_part") - 1) * F.lit(float(q))
        for side, pos in (("lo", F.floor(at)), ("hi", F.ceil(at))):
            here = (F.col("n_before") <= pos) & (pos < F.col("n_before") + F.col("n"))
            aggs.append(F.max(F.when(here, F.col("value"))).alias(f"{side}_{name}"))
        aggs.append(F.max(at - F.floor(at)).alias(f"w_{name}"))
        lo, hi, w = F.col(f"lo_{name}"), F.col(f"hi_{name}"), F.col(f"w_{name}")
        outs.append((lo + (hi - lo) * w).alias(name))
    return counts.groupBy("column").agg(*aggs).select("column", *outs)


def describe_exact(df: DataFrame, cols: Sequence[str], slices: int | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max, one row per column.

    ``df`` is read twice: once for the plain statistics of all columns, and once in long form.
    """
    stats = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    plain = doubles.agg(*[F.struct(F.lit(c).alias("column"), *[
        f(c).alias(n) for n, f in stats.items()]).alias(f"_{i}") for i, c in enumerate(cols)])
    basic = plain.select(F.inline(F.array(*[F.col(f"_{i}") for i in range(len(cols))])))
    quartiles = exact_quantiles(_numeric(df, cols), [0.25, 0.5, 0.75], ["q25", "q50", "q75"], slices)
    return basic.join(quartiles, "column", "left")  # one row per column on both sides
