"""Role joins and the features that combine roles."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast.functions.expr import all_present, ratio
from foldcast.operators.folds import out_of_fold
from foldcast.operators.joins import (
    BROADCAST_BYTES, laid_near, side_by_side, sized_join, stored, stored_arrays,
)


def join_roles(events: DataFrame, roles: dict[str, tuple[str, DataFrame]],
               keys: Sequence[str], salt_on: Sequence[str],
               narrow: DataFrame | None = None) -> DataFrame:
    """Join one actor table per role; its columns take the role's suffix.

    ``roles`` maps a suffix to (id column of the events, actor table keyed on ``player_id``
    and ``keys``). ``narrow`` holds the same rows as ``events`` with only the keys: where a role
    table is too large to broadcast, heavy actors are found there and not in the wide rows.
    """
    sides = side_by_side(events.sparkSession, [
        lambda r=r, s=s: stored(_suffixed(r[1], r[0], s, keys)) for s, r in roles.items()])
    on = {s: [id_col, *keys] for s, (id_col, _) in roles.items()}
    counts = {} if narrow is None else {s: _key_counts(narrow, on[s]) for s in roles}
    return _join_sides(events, [(on[s], *side, counts.get(s)) for s, side in zip(roles, sides)], salt_on)


def _suffixed(table: DataFrame, id_col: str, suffix: str, keys: Sequence[str]) -> DataFrame:
    return table.withColumnsRenamed({
        c: id_col if c == "player_id" else c + suffix for c in table.columns if c not in keys})


def _key_counts(narrow: DataFrame, on: Sequence[str]) -> DataFrame:
    return narrow.where(all_present(on)).groupBy(*on).agg(F.count(F.lit(1)).alias("n"))


def _join_sides(events: DataFrame,
                sides: Sequence[tuple[list[str], DataFrame, int, DataFrame | None]],
                salt_on: Sequence[str]) -> DataFrame:
    """Join the sides (keys, table, its bytes, numbers of rows per key): shuffled joins first, the
    smallest of them leading, as what is joined before a shuffle goes through it."""
    out = events
    for on, table, size, counts in sorted(sides, key=lambda s: (s[2] <= BROADCAST_BYTES, s[2])):
        out = sized_join(out, table, size, on, salt_on, counts=counts)
    return out


def join_roles_by_fold(events: DataFrame, roles: dict[str, tuple[str, DataFrame]],
                       keys: Sequence[str], edges: Sequence[int], salt_on: Sequence[str],
                       narrow: DataFrame | None = None,
                       more: Sequence[tuple[Sequence[str], DataFrame]] = (), near: bool = False,
                       ) -> DataFrame:
    """``join_roles`` for actor tables that are keyed on ``fold`` as well: every event once for each
    fold that it does not belong to, with that fold's columns.

    An actor's folds lie in one array, so each event is joined once per role and repeated after
    the joins; shuffles and lookups see the events themselves. With ``narrow``, actors that no event
    has are left out of the lookups, so that these follow the log and not the actor table.
    ``more`` are lookups (keys, table) of the events themselves. ``near`` is for a table that is to be
    written small and by fold: where all lookups are broadcast, the narrow events are repeated first
    and lie by fold and then by what they look up, within their partitions. After a shuffled join
    rows lie by its key.

    What a side brings beside its keys goes through the joins as one struct, as each join copies its
    columns one by one.
    """
    folds = range(1, len(edges) + 1)
    tables = {s: _suffixed(t, id_col, s, [*keys, "fold"]) for s, (id_col, t) in roles.items()}
    on = {s: [roles[s][0], *keys] for s in tables}
    counts = {} if narrow is None else {s: stored(_key_counts(narrow, on[s])) for s in tables}

    def side(s: str) -> tuple[list[str], DataFrame, int, DataFrame | None]:
        known, size = counts.get(s, (None, 0))
        wanted = None if known is None else known.select(*on[s])
        return (on[s], *stored_arrays(tables[s], on[s], "fold", folds, f"_folds{s}", wanted, size), known)

    sides = side_by_side(events.sparkSession, [lambda s=s: side(s) for s in tables])
    for i, (own, table) in enumerate(more):
        held, size = stored(table)
        sides.append((list(own), _packed(held, own, f"_more{i}"), size, None))
    apart = {*salt_on, *(k for own, *_ in sides for k in own)}
    rows = _packed(events, apart, "_event")
    if near and all(size <= BROADCAST_BYTES for _, _, size, _ in sides):
        order = dict.fromkeys(k for s in sorted(sides, key=lambda s: s[2]) for k in s[0])
        joined = _join_sides(laid_near(out_of_fold(rows, edges), ["fold", *order]), sides, salt_on)
    else:
        joined = out_of_fold(_join_sides(rows, sides, salt_on), edges)
    added = [F.col(f"_more{i}").getField(c).alias(c)
             for i, (own, table) in enumerate(more) for c in table.columns if c not in own]
    carried = [c if c in apart else F.col("_event").getField(c).alias(c) for c in events.columns]
    dealt = joined.withColumns(
        {f"_own{s}": F.get(f"_folds{s}", F.col("fold") - 1) for s in tables})
    return dealt.select(*carried, *added, "fold", *[
        F.col(f"_own{s}").getField(c).alias(c) for s, t in tables.items() for c in t.columns
        if c not in {roles[s][0], *keys, "fold"}])


def _packed(df: DataFrame, apart: Collection[str], name: str) -> DataFrame:
    """``df`` with the columns that are not ``apart`` in one struct."""
    held = [c for c in df.columns if c not in apart]
    return df.select(*[c for c in df.columns if c in apart], *([F.struct(*held).alias(name)] if held else []))


def pair_diff_exprs(cols: Sequence[str], pairs: dict[str, tuple[str, str]]) -> list[str]:
    return [
        f"{c}_{a} - {c}_{b} as {c}_dif_{pair}"
        for pair, (a, b) in pairs.items() for c in cols
    ]


def pair_diff(df: DataFrame, cols: Sequence[str], pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Difference of each column between the two roles of every pair."""
    return df.selectExpr("*", *pair_diff_exprs(cols, pairs))


def _source(name: str, source: str) -> str:
    return f"bc_{name}" if source == "bc" else f"{name}_{source}"


def pair_combine_exprs(names: Sequence[str], pairs: dict[str, tuple[str, str]],
                       ops: Sequence[str], base: str | None = None,
                       short: bool = False) -> list[str]:
    """Generated SQL expressions op_pair_name; ``rate`` divides the mean of a pair by one minus
    the mean of the ``base`` class. ``short`` leaves the pair out of the names."""

    def mean(pair: str, name: str) -> str:
        a, b = pairs[pair]
        return f"(({_source(name, a)} + {_source(name, b)}) / 2)"

    def value(op: str, pair: str, name: str) -> str:
        a, b = (_source(name, s) for s in pairs[pair])
        if op == "sub":
            return f"{a} - {b}"
        if op == "div":
            return ratio(a, b)
        if op == "mul":
            return f"{a} * {b}"
        if op == "ave":
            return mean(pair, name)
        if op == "rate":
            return ratio(mean(pair, name), f"1 - {mean(pair, base)}")
        raise ValueError(f"unknown operation {op!r}")

    return [
        f"{value(op, pair, name)} as " + (f"{op}_{name}" if short else f"{op}_{pair}_{name}")
        for name in names for op in ops for pair in pairs
    ]


def pair_combine(df: DataFrame, names: Sequence[str], pairs: dict[str, tuple[str, str]],
                 ops: Sequence[str] = ("sub", "div", "mul", "ave"), base: str | None = None,
                 ) -> DataFrame:
    """Combine the mixes of two sources for every pair, operation and class in one select."""
    return df.selectExpr("*", *pair_combine_exprs(names, pairs, ops, base))


def pair_combine_two(df: DataFrame, balls: Sequence[str], zones: Sequence[str], base: str,
                     ) -> DataFrame:
    """The two-source form: count mix against pitcher, plus two differences to the catcher."""
    pair = {"bc_p": ("bc", "pit")}
    catcher = {"p_c": ("pit", "cat"), "bc_c": ("bc", "cat")}
    return df.selectExpr(
        "*",
        *pair_combine_exprs(balls, pair, ["sub", "div", "mul", "ave", "rate"], base, short=True),
        *pair_combine_exprs(balls, catcher, ["sub"]),
        *pair_combine_exprs(zones, pair, ["sub", "div", "mul", "ave"], short=True),
    )
