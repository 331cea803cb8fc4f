"""Per-actor history, computed for all folds in one pass, and the filling of gaps in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.functions.expr import all_present, flag, ratio, row_sum
from foldcast.operators.joins import lookup_join
from foldcast.vocabulary import BALLS, HANDS, ROLE_COUNTERS, ZONES

GAME = ("game_id",)
INNING = ("game_id", "inning")
PLATE = ("game_id", "inning", "bat_cnt_in_inning")


def _label_counts(balls: Sequence[str], zones: Sequence[str]) -> list[Column]:
    return [
        *[F.expr(f"count_if(ball = {i}) as `{c}`") for i, c in enumerate(balls)],
        *[F.expr(f"count_if(course = {i}) as `{c}`") for i, c in enumerate(zones)],
    ]


def distinct_count(df: DataFrame, keys: Sequence[str], of: Sequence[str], name: str) -> DataFrame:
    """Distinct complete combinations of ``of`` per group.

    Duplicates are removed on (keys, of) before the count, so that the combinations of one
    heavy group are spread over the cluster; ``count_distinct`` would send them to one task.
    """
    rows = df.where(all_present([*keys, *of])).select(*keys, *of).distinct()
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def _activity(rows: DataFrame, keys: Sequence[str], finest: Sequence[str], games: str,
              parts: str | None) -> DataFrame:
    """Distinct games per actor, and distinct innings or plate appearances in the same pass."""
    units = rows.where(all_present([*keys, "game_id"])).select(*keys, *finest).distinct()
    if parts is None:
        return units.groupBy(*keys).agg(F.count(F.lit(1)).alias(games))
    per_game = units.groupBy(*keys, "game_id").agg(F.count_if(all_present(finest)).alias("_n"))
    return per_game.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(games), F.sum("_n").alias(parts))


def activity_lattice(df: DataFrame, balls: Sequence[str] = BALLS, zones: Sequence[str] = ZONES,
                     fold: str = "fold",
                     actors: Sequence[str] = ("pitcher_id", "batter_id", "catcher_id")) -> DataFrame:
    """Class counts per fold, plate appearance, hand pair and the actors that meet in it.

    All histories roll up from this table, so one that is stored serves them all with a single pass
    over the events; it has a row where the log has a plate appearance.
    """
    return df.where(F.col(fold).isNotNull()).groupBy(fold, *PLATE, *actors, "pit_bat").agg(
        *_label_counts(balls, zones))


def actor_history(df: DataFrame, role: str, actor: str, balls: Sequence[str] = BALLS,
                  zones: Sequence[str] = ZONES, fold: str = "fold") -> DataFrame:
    """Class counts per (fold, actor, hand) with the role's activity counters, from events."""
    if role not in ROLE_COUNTERS:
        raise ValueError(f"unknown role {role!r}")
    lattice = activity_lattice(df, balls, zones, fold, [actor])
    return lattice_history(lattice, role, actor, balls, zones, fold)


def lattice_history(lattice: DataFrame, role: str, actor: str, balls: Sequence[str] = BALLS,
                    zones: Sequence[str] = ZONES, fold: str = "fold") -> DataFrame:
    """Class counts per (fold, actor, hand) with the role's activity counters.

    Only the pitcher's batters faced are counted per hand; the other counters are per actor.
    """
    keys, whole = [fold, "player_id", "pit_bat"], [fold, "player_id"]
    sums = [F.expr(f"sum(`{c}`) as `{c}`") for c in [*balls, *zones]]
    rows = lattice.withColumn("player_id", F.col(actor))
    if role != "pitcher":
        counts = rows.where(all_present(keys)).groupBy(*keys).agg(*sums)
    if role == "pitcher":
        # a plate appearance that another batter or catcher ends counts once
        plates = rows.where(all_present(keys)).groupBy(*keys, *PLATE).agg(*sums)
        counts = plates.groupBy(*keys).agg(
            *sums, F.nullif(F.count_if(all_present(PLATE)), F.lit(0)).alias("pit_batter_cnt"))
        activity = _activity(rows, whole, INNING, "pit_game_cnt", "pit_inning_cnt")
    elif role == "batter":
        activity = _activity(rows, whole, PLATE, "bat_game_cnt", "batter_cnt")
    else:
        activity = _activity(rows, whole, GAME, "cat_game_cnt", None)
    # both sides are aggregated: at most one row per actor, hand and fold
    joined = counts.join(activity, whole, "left")
    return joined.select(
        *keys, *balls, row_sum(balls).alias("total"), *zones, *ROLE_COUNTERS[role]
    )


def per_unit_rates(df: DataFrame) -> DataFrame:
    """Pitches, batters and innings of a pitcher per game, inning and batter."""
    rates = {
        "pit_inning_per_game": ("pit_inning_cnt", "pit_game_cnt"),
        "pit_batter_per_game": ("pit_batter_cnt", "pit_game_cnt"),
        "pit_ball_per_game": ("total", "pit_game_cnt"),
        "pit_batter_per_inning": ("pit_batter_cnt", "pit_inning_cnt"),
        "pit_ball_per_inning": ("total", "pit_inning_cnt"),
        "pit_ball_per_batter": ("total", "pit_batter_cnt"),
    }
    return df.selectExpr("*", *[f"{ratio(n, d)} as {k}" for k, (n, d) in rates.items()])


def with_history(actors: DataFrame, history: DataFrame, folds: Sequence[int],
                 salt_on: Sequence[str] = ("player_id", "year")) -> DataFrame:
    """Every actor row for every fold, with that fold's history and ``has_history`` 0/1."""
    expanded = actors.select("*", F.explode(F.array(*[F.lit(k) for k in folds])).alias("fold"))
    marked = history.withColumn("_seen", F.lit(1))
    joined = lookup_join(expanded, marked, ["player_id", "pit_bat", "fold"], salt_on)
    return joined.withColumn("has_history", flag(F.col("_seen") == 1)).drop("_seen")


def fill_segment_mean(df: DataFrame, segment: Column, cols: Sequence[str],
                      hands: Sequence[str] = HANDS) -> DataFrame:
    """Give actors without history the mean of their segment (0/1), hand and fold.

    The table of means has at most 2 x hands x folds rows, so it is broadcast.
    """
    keys = ["_segment", "pit_bat", "fold"]
    rows = df.withColumn("_segment", segment)
    known = rows.where((F.col("has_history") == 1) & F.col("pit_bat").isin(list(hands)))
    means = known.groupBy(*keys).agg(*[F.expr(f"avg(`{c}`) as `_mean_{c}`") for c in cols])
    joined = rows.join(F.broadcast(means), keys, "left")
    filled = set(cols)
    return joined.selectExpr(*[
        f"if(has_history = 1, cast(`{c}` as double), `_mean_{c}`) as `{c}`"
        if c in filled else f"`{c}`"
        for c in df.columns
    ])
