"""Small Column helpers shared by the operators.

Missing values are SQL NULL throughout, never NaN: every division goes through ``safe_div``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.vocabulary import HAND_CODES

DAY_SECONDS = 86400


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(n: Column | str, d: Column | str, on_zero: str | None = None) -> Column:
    """Float division; a zero divisor gives NULL, or signed infinity with ``on_zero='inf'``."""
    n, d = as_col(n).cast("double"), as_col(d).cast("double")
    quotient = F.try_divide(n, d)
    if on_zero is None:
        return quotient
    if on_zero != "inf":
        raise ValueError(f"on_zero must be None or 'inf', not {on_zero!r}")
    return F.when((d == 0) & (n > 0), F.lit(float("inf"))).when(
        (d == 0) & (n < 0), F.lit(float("-inf"))
    ).otherwise(quotient)


def ratio(n: str, d: str) -> str:
    """``safe_div`` as SQL text, for the wide generated selects."""
    return f"try_divide(cast({n} as double), cast({d} as double))"


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is NULL."""
    return F.when(condition, 1).otherwise(0)


def all_present(cols: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in cols], F.lit(True))


def count_key(strike: str = "strike_cnt", ball: str = "ball_cnt") -> Column:
    """Ball count as "S-B"; NULL when either part is."""
    return F.concat(F.col(strike).cast("string"), F.lit("-"), F.col(ball).cast("string"))


def hand_key(hand: str = "pitcher_hand", side: str = "batter_side") -> Column:
    """Pitcher hand and batter side as "P_B" after recoding; NULL when either part is."""
    return F.concat(recode_hand(hand), F.lit("_"), recode_hand(side))


def recode_hand(col: str) -> Column:
    out = F.col(col)
    for code, letter in HAND_CODES.items():
        out = F.when(F.col(col) == code, letter).otherwise(out)
    return out


def recode(df: DataFrame, mapping: dict, cols: Sequence[str]) -> DataFrame:
    """Replace values by ``mapping`` in the named columns."""
    return df.replace(mapping, subset=list(cols))


def decode(col: Column | str, labels: Sequence) -> Column:
    """The label at position ``col`` (from 0); NULL outside the list."""
    return F.try_element_at(F.lit(list(labels)), (as_col(col) + 1).cast("int"))


def recode_label(col: Column | str, lookup: Sequence[int]) -> Column:
    """Coarsen a class number with a lookup list, without a UDF."""
    return decode(col, list(lookup))


def row_sum(cols: Sequence[Column | str], skip_null: bool = False) -> Column:
    """Sum across columns: NULL-propagating, or NULL counted as zero with ``skip_null``."""
    cols = [as_col(c) for c in cols]
    if skip_null:
        cols = [F.coalesce(c, F.lit(0)) for c in cols]
    return reduce(add, cols)


def clock_seconds(col: Column | str, fmt: str = "HH:mm:ss") -> Column:
    """Second of the day of a textual clock time; NULL when it does not parse."""
    t = F.try_to_timestamp(as_col(col), F.lit(fmt))
    return F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)


def elapsed_minutes(clock: Column | str, start: Column | str, fmt: str = "HH:mm:ss") -> Column:
    """Minutes from ``start`` to ``clock``, wrapped to one day."""
    seconds = clock_seconds(clock, fmt) - clock_seconds(start, fmt)
    return F.pmod(seconds, F.lit(DAY_SECONDS)) / F.lit(60.0)


def days_between(date: Column | str, first: Column | str, fmt: str = "yyyy-MM-dd") -> Column:
    return F.datediff(F.try_to_date(as_col(date), fmt), F.try_to_date(as_col(first), fmt))


def mean_interval(elapsed: Column | str, n: Column | str) -> Column:
    """Mean gap of n events that took ``elapsed``: elapsed / (n - 1), NULL for the first."""
    return safe_div(as_col(elapsed), as_col(n) - 1)


def remaining_fraction(n: Column | str, last: Column | str) -> Column:
    """Share of the group still to come. Reads the future: keep it out of training features."""
    return safe_div(as_col(last) - as_col(n), last)


def one_hot(df: DataFrame, col: str, values: Sequence, prefix: str | None = None) -> DataFrame:
    """One 0/1 column per declared value."""
    prefix = col if prefix is None else prefix
    return df.select("*", *[flag(F.col(col) == v).alias(f"{prefix}_{v}") for v in values])


def drop_matching(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Drop the columns whose name contains any of ``parts``."""
    return df.select(*[c for c in df.columns if not any(p in c for p in parts)])
