"""Folds by row-number ranges, and random hold-outs that SQL can repeat."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(edges: Sequence[int], row_no: str = "row_no") -> Column:
    """Fold number from 1; NULL past the last edge (rows without a label)."""
    whens = " ".join(f"when `{row_no}` <= {edge} then {k}" for k, edge in enumerate(edges, 1))
    return F.expr(f"case {whens} end")


def in_folds(edges: Sequence[int], row_no: str = "row_no") -> Column:
    """Rows that belong to any fold; a plain comparison, so it reaches the file scan."""
    return F.col(row_no) <= edges[-1]


def _own_range(k: int, edges: Sequence[int], row_no: str) -> Column:
    if not 1 <= k <= len(edges):
        raise ValueError(f"fold {k} is not in 1..{len(edges)}")
    inside = F.col(row_no) <= edges[k - 1]
    return inside if k == 1 else inside & (F.col(row_no) > edges[k - 2])


def fold_rows(df: DataFrame, k: int, edges: Sequence[int], row_no: str = "row_no") -> DataFrame:
    """Rows of fold k."""
    return df.where(_own_range(k, edges, row_no))


def fold_complement(df: DataFrame, k: int, edges: Sequence[int],
                    row_no: str = "row_no") -> DataFrame:
    """All rows outside fold k; rows without a label always stay."""
    return df.where(~_own_range(k, edges, row_no))


def out_of_fold(df: DataFrame, edges: Sequence[int], row_no: str = "row_no",
                name: str = "fold") -> DataFrame:
    """Each row once for every fold it does not belong to. Narrow: no join, no shuffle."""
    folds = F.lit(list(range(1, len(edges) + 1)))
    others = F.filter(folds, lambda k: ~k.eqNullSafe(fold_of(edges, row_no)))
    return df.select("*", F.explode(others).alias(name))


def labelled(df: DataFrame, label: str) -> DataFrame:
    return df.dropna(subset=[label])


def unlabelled(df: DataFrame, label: str) -> DataFrame:
    return df.where(F.col(label).isNull())


def holdout(df: DataFrame, parts: int = 4, seed: int = 0, row_no: str = "row_no",
            name: str = "is_test") -> DataFrame:
    """Mark one row in ``parts`` as hold-out by a multiplicative hash of its number.

    The same rows are chosen on every run and engine (default: 75 / 25).
    """
    mixed = (F.pmod(F.col(row_no), F.lit(1_000_003)) * 7919 + seed * 104_729) % 65_537
    return df.withColumn(name, (mixed % parts == 0).cast("int"))
