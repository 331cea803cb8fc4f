"""Registry of named queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def nearest(col: str, places: int) -> str:
    """``round(col, places)`` of a double as SQL text, to the bit.

    Spark's own goes through the digits of a decimal for each value. A whole number over a power of
    ten is the same double; only where the scaled value lies within its own error of a half, or is too
    large to tell, do the digits decide.
    """
    scaled = f"`{col}` * 1e{places}D"
    return (f"if(abs({scaled} - rint({scaled})) + abs({scaled}) * 1e-15D < 0.5D,"
            f" rint({scaled}) / 1e{places}D + 0D, round(`{col}`, {places}))")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded so that two engines agree on the last digits."""
    return df.selectExpr(*[
        f"{nearest(c, places)} as `{c}`" if t == "double" else f"`{c}`" for c, t in df.dtypes
    ])
