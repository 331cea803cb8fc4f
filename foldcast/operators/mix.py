"""Class counts and shares per group, zone roll-ups and class ratios."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foldcast.functions.expr import all_present, ratio, row_sum
from foldcast.vocabulary import ZONE_GROUPS


def class_counts(df: DataFrame, keys: Sequence[str], label: str, classes: Sequence[str],
                 total: str | None = None) -> DataFrame:
    """Rows per class and group, 0 where absent. Class i is the label value i."""
    counts = df.where(all_present(keys)).groupBy(*keys).agg(
        *[F.expr(f"count_if(`{label}` = {i}) as `{c}`") for i, c in enumerate(classes)]
    )
    return counts if total is None else counts.withColumn(total, row_sum(classes))


def class_share(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """Long form: rows per (group, class) and the class's share of its group."""
    counts = df.where(all_present([*keys, label])).groupBy(*keys, label).agg(
        F.count(F.lit(1)).alias("n")
    )
    group = Window.partitionBy(*keys)  # over aggregated rows: one per class
    return counts.withColumn("share", F.col("n") / F.sum("n").over(group))


def class_mix(df: DataFrame, keys: Sequence[str], label: str, classes: Sequence[str],
              prefix: str = "") -> DataFrame:
    """Wide form of ``class_share``, one column per declared class, in one aggregation."""
    rows = df.where(all_present([*keys, label]))
    return rows.groupBy(*keys).agg(
        *[F.expr(f"count_if(`{label}` = {i}) / count(1) as `{prefix}{c}`")
          for i, c in enumerate(classes)]
    )


def conditional_mix(df: DataFrame, keys: Sequence[str], balls: Sequence[str],
                    zones: Sequence[str], groups: dict | None = None, prefix: str = "bc_",
                    ball: str = "ball", zone: str = "course") -> DataFrame:
    """Ball and zone mix of each group with the zone groups added; one pass over the rows."""
    both = df.where(all_present(keys)).groupBy(*keys).agg(
        F.count(ball).alias("_balls"),
        *[
            F.expr(f"{ratio(f'count_if(`{label}` = {i})', f'count(`{label}`)')} as `{prefix}{c}`")
            for label, classes in ((ball, balls), (zone, zones)) for i, c in enumerate(classes)
        ],
    )
    mix = both.where(F.col("_balls") > 0).drop("_balls")
    return rollup_groups(mix, groups or ZONE_GROUPS, zones, prefix)


def rollup_groups(df: DataFrame, groups: dict[str, Sequence[int]], zones: Sequence[str],
                  prefix: str = "", out_prefix: str | None = None) -> DataFrame:
    """Add the sum of the member zones of each (overlapping) group."""
    out_prefix = prefix if out_prefix is None else out_prefix
    return df.selectExpr("*", *[
        " + ".join(f"`{prefix}{zones[i]}`" for i in members) + f" as `{out_prefix}{name}`"
        for name, members in groups.items()
    ])


def to_share(df: DataFrame, cols: Sequence[str], total: str) -> DataFrame:
    """Counts turned into shares of ``total``."""
    return _divide(df, cols, total)


def relative_to(df: DataFrame, cols: Sequence[str], base: str) -> DataFrame:
    """Class shares turned into ratios to the base class."""
    return _divide(df, cols, base)


def _divide(df: DataFrame, cols: Sequence[str], by: str) -> DataFrame:
    divided = set(cols)
    return df.selectExpr(*[
        f"{ratio(f'`{c}`', f'`{by}`')} as `{c}`" if c in divided else f"`{c}`"
        for c in df.columns
    ])
