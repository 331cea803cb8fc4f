"""The wide feature table: one row per event and fold it does not belong to, 640 features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast import vocabulary as v
from foldcast.functions.expr import (
    count_key, days_between, elapsed_minutes, flag, hand_key, mean_interval, remaining_fraction,
)
from foldcast.functions.situation import profile, situation_flags
from foldcast.operators.folds import fold_of, in_folds
from foldcast.operators.history import (
    activity_lattice, fill_segment_mean, lattice_history, with_history,
)
from foldcast.operators.joins import fan_out, lookup_join, side_by_side, stored
from foldcast.operators.mix import conditional_mix, rollup_groups, to_share
from foldcast.operators.ranks import avg_rank
from foldcast.operators.roles import join_roles_by_fold, pair_combine_exprs, pair_diff_exprs
from foldcast.operators.sequence import Group, along_groups

PLATE = ["game_id", "inning", "bat_cnt_in_inning"]
PLATE_STRICT = ["game_id", "total_inning", "bat_cnt_in_inning"]
COUNT_KEYS = ["count_key", "pit_bat"]
SITUATION = ["first", "second", "third", "base_cnt"]
SEQUENCE = [
    "date_from_opening", "elapsed_min", "min_diff", "total_inning", "elapsed_from_inning",
    "ballnum_from_inning", "elapsed_batter", "ave_elapsed_game", "ave_elapsed_inning",
    "ave_elapsed_batter", "diff_elapsed_batter", "diff_elapsed_inning", "diff_elapsed_game",
    "nighter", "point_diff", "runner_23", "bant", "ball_count_sum", "pre_ball_foul",
    "pre_ball_ball", "pre_ball_strike", "pre_foul_sum", "last_ball",
]
ROLE_IDS = {"pitcher": "pitcher_id", "batter": "batter_id", "catcher": "catcher_id"}


def with_keys(events: DataFrame) -> DataFrame:
    """Add the hand pair and the ball count as keys."""
    return events.withColumns({"pit_bat": hand_key(), "count_key": count_key()})


def with_clock(events: DataFrame) -> DataFrame:
    """Days since the first event of the year and minutes since the first of the game.

    One pass reduces the events to games; both minima come from that table.
    """
    games, _ = stored(events.groupBy("year", "game_id").agg(
        F.min("game_date").alias("_date"), F.min("game_time").alias("_time")
    ))
    opening = games.where("year is not null").groupBy("year").agg(
        F.min("_date").alias("_opening"))
    start = games.where("game_id is not null").groupBy("game_id").agg(
        F.min("_time").alias("_start"))
    timed = lookup_join(events, opening, ["year"], ["row_no"], derived=False)
    timed = lookup_join(timed, start, ["game_id"], ["row_no"], derived=False)
    return timed.withColumns({
        "date_from_opening": days_between("game_date", "_opening"),
        "elapsed_min": elapsed_minutes("game_time", "_start"),
    }).drop("_opening", "_start")


def sequence_features(events: DataFrame, plate: Sequence[str] = PLATE,
                      chunk_rows: int | None = None) -> DataFrame:
    """Order-aware features of events that carry the situation flags and the clock columns.

    ``plate`` is the plate-appearance key. The default leaves the half inning out, as the
    published models do; ``PLATE_STRICT`` separates the halves.
    """
    events = events.withColumn("ball_count_sum", F.col("ball_cnt") + F.col("strike_cnt"))
    seq = along_groups(events, "row_no", [
        Group(["game_id"], previous={"_elapsed": "elapsed_min"}),
        Group(plate, stats={"_last": ("max", "pitch_cnt_in_bat")},
              previous={"_sum": "ball_count_sum", "_ball": "ball_cnt", "_strike": "strike_cnt"}),
        Group(PLATE_STRICT, stats={"_batter_start": ("min", "elapsed_min")}),
        Group(["game_id", "total_inning"],
              stats={"_inning_start": ("min", "elapsed_min"),
                     "_inning_ball": ("min", "pitch_cnt_in_game")}),
    ], chunk_rows=chunk_rows)
    first_pitch = F.coalesce(F.col("pitcher_cnt_in_inning") == 1, F.lit(False))
    min_diff = F.when(~first_pitch, F.col("elapsed_min") - F.col("_elapsed"))
    in_inning = F.col("elapsed_min") - F.col("_inning_start")
    ball_no = F.col("pitch_cnt_in_game") - F.col("_inning_ball") + 1
    in_batter = F.col("elapsed_min") - F.col("_batter_start")
    ave_game = mean_interval("elapsed_min", "pitch_cnt_in_game")
    ave_inning = mean_interval(in_inning, ball_no)
    ave_batter = mean_interval(in_batter, "pitch_cnt_in_bat")
    foul = 1 - F.coalesce(F.col("ball_count_sum") - F.col("_sum"), F.lit(1))
    exprs = {
        "min_diff": min_diff,
        "elapsed_from_inning": in_inning,
        "ballnum_from_inning": ball_no,
        "elapsed_batter": in_batter,
        "ave_elapsed_game": ave_game,
        "ave_elapsed_inning": ave_inning,
        "ave_elapsed_batter": ave_batter,
        "diff_elapsed_batter": min_diff - ave_batter,
        "diff_elapsed_inning": min_diff - ave_inning,
        "diff_elapsed_game": min_diff - ave_game,
        "pre_ball_foul": foul,
        "pre_ball_ball": F.coalesce(F.col("ball_cnt") - F.col("_ball"), F.lit(0)),
        "pre_ball_strike": F.coalesce(F.col("strike_cnt") - F.col("_strike"), F.lit(0)) + foul,
        "pre_foul_sum": F.col("pitch_cnt_in_bat") - F.col("ball_count_sum"),
        "last_ball": remaining_fraction("pitch_cnt_in_bat", "_last"),
    }
    return seq.select(*events.columns, *[e.alias(n) for n, e in exprs.items()])


def event_features(events: DataFrame, plate: Sequence[str] = PLATE) -> DataFrame:
    """Situation, clock and order features of every event; ``build_features`` adds the count mix."""
    return sequence_features(with_clock(situation_flags(with_keys(events))), plate)


def actor_profiles(actors: DataFrame) -> DataFrame:
    """Actor rows with salary rank and profile columns, stored: every role starts from them."""
    ranked = avg_rank(actors, "salary", ["year", "team_id"], ["player_id", "year"],
                      "salary_rank")
    return stored(profile(ranked).select(
        "player_id", "year", "position", "throws", "bats", "foreigner", *v.PROFILE))[0]


def hands_of(profiles: DataFrame, role: str) -> DataFrame:
    """The actors that can take a role, once per hand pair they can meet."""
    if role == "pitcher":
        rows = profiles.where(F.col("position") == v.PITCHER)
        return fan_out(rows, v.THROW_HANDS, "throws", "pit_bat")
    if role == "catcher":
        return fan_out(profiles.where(F.col("position") == v.CATCHER), v.HANDS, None, "pit_bat")
    return fan_out(profiles, v.BAT_HANDS, "bats", "pit_bat")


def segment_of(role: str):
    """The 0/1 segment whose mean stands in for a missing history."""
    if role == "pitcher":
        return flag(F.col("foreigner") == 1)
    if role == "catcher":
        return F.lit(0)
    return flag(F.col("position") == v.PITCHER)


def labelled_lattice(events: DataFrame, edges: Sequence[int]) -> DataFrame:
    """The plate appearances of the folds, from which every role's history rolls up."""
    return activity_lattice(with_keys(events).where(in_folds(edges)).withColumn("fold", fold_of(edges)))


def role_table(profiles: DataFrame, lattice: DataFrame, role: str,
               edges: Sequence[int] = v.EDGES_4, fill: bool = True,
               min_years: int | None = None) -> DataFrame:
    """Profile, shares, zone groups and counters per actor, year, hand and fold.

    ``lattice`` is that of ``labelled_lattice``. ``min_years`` hides the history of actors with
    fewer years of play.
    """
    history = lattice_history(lattice, role, ROLE_IDS[role])
    folds = range(1, len(edges) + 1)
    counters = v.ROLE_COUNTERS[role]
    table = with_history(hands_of(profiles, role), history, folds)
    if min_years is not None:
        known = F.col("play_year") >= min_years
        hidden = {
            c: F.expr(f"if(play_year >= {min_years}, {c}, null)")
            for c in [*v.BALLS, "total", *v.ZONES, *counters]
        }
        table = table.withColumns(
            {**hidden, "has_history": flag(known & (F.col("has_history") == 1))})
    if fill:
        table = fill_segment_mean(
            table, segment_of(role), [*v.BALLS, "total", *v.ZONES, *counters])
    shares = to_share(table, [*v.BALLS, *v.ZONES], "total")
    grouped = rollup_groups(shares, v.ZONE_GROUPS, v.ZONES)
    return grouped.select(
        "player_id", "year", "pit_bat", "fold", *v.PROFILE, *v.BALLS, "total", *v.ZONE_GROUPS,
        *counters,
    ).where(F.col("player_id").isNotNull())


def role_tables(actors: DataFrame, events: DataFrame, edges: Sequence[int] = v.EDGES_4,
                fill: bool = True, min_years: int | None = None,
                ) -> dict[str, tuple[str, DataFrame]]:
    """The tables of all roles in the form ``join_roles`` takes; the events are read once."""
    profiles = actor_profiles(actors)
    lattice, _ = stored(labelled_lattice(events, edges))
    roles = list(ROLE_IDS)
    tables = side_by_side(events.sparkSession, [
        lambda role=role: role_table(profiles, lattice, role, edges, fill, min_years)
        for role in roles
    ])
    return {v.ROLE_SUFFIX[r]: (ROLE_IDS[r], t) for r, t in zip(roles, tables)}


def feature_names() -> list[str]:
    """The 640 feature columns in order."""
    mixes = [*v.BALLS, "total", *v.ZONE_GROUPS]
    names = [*v.COUNTERS, *[f"bc_{z}" for z in v.ZONES], *SITUATION, *SEQUENCE]
    for role in ("pitcher", "batter"):
        suffix = v.ROLE_SUFFIX[role]
        names += [c + suffix for c in [*v.PROFILE, *mixes, *v.ROLE_COUNTERS[role]]]
    names += [f"{c}_cat" for c in [*v.PROFILE, "total", *v.ROLE_COUNTERS["catcher"]]]
    names += [f"{c}_dif_{pair}" for pair in v.ROLE_PAIRS for c in v.PROFILE_DIFFS]
    names += [f"{op}_{pair}_{b}" for b in v.BALLS
              for op in ("sub", "div", "mul", "ave", "rate") for pair in v.MIX_PAIRS]
    names += [f"{op}_{pair}_{g}" for g in v.ZONE_GROUPS
              for op in ("sub", "div", "mul", "ave") for pair in v.MIX_PAIRS]
    return names


def build_features(events: DataFrame, actors: DataFrame, edges: Sequence[int] = v.EDGES_4,
                   plate: Sequence[str] = PLATE, fill: bool = True, mix_fold: bool = False,
                   min_years: int | None = None) -> DataFrame:
    """Feature table from raw events (labelled rows first) and yearly actors.

    ``mix_fold=True`` takes the count mix from the history fold alone, so that no row sees its
    own label through it.
    """
    wide, tables = side_by_side(events.sparkSession, [
        lambda: event_features(events, plate),
        lambda: role_tables(actors, events, edges, fill, min_years),
    ])
    narrow = with_keys(events).select("row_no", "year", "pit_bat", *ROLE_IDS.values())
    names = feature_names()
    needed = {*narrow.columns, *COUNT_KEYS, *v.LABELS, *names}
    own = wide.select(*[c for c in wide.columns if c in needed])
    labelled = with_keys(events).where(in_folds(edges)).withColumn("fold", fold_of(edges))
    mix_keys = [*(["fold"] if mix_fold else []), *COUNT_KEYS]
    mix = conditional_mix(labelled, mix_keys, v.BALLS, v.ZONES)
    # the mix joins last, so that the shuffles of the role joins do without its columns
    joined = join_roles_by_fold(own, tables, ["year", "pit_bat"], edges, ["row_no"], narrow,
                                [] if mix_fold else [(COUNT_KEYS, mix)], near=True)
    if mix_fold:
        joined = lookup_join(joined, mix, mix_keys, ["row_no", "fold"])
    combined = joined.selectExpr(
        "*",
        *pair_diff_exprs(v.PROFILE_DIFFS, v.ROLE_PAIRS),
        *pair_combine_exprs(v.BALLS, v.MIX_PAIRS, ["sub", "div", "mul", "ave", "rate"],
                            base="straight"),
        *pair_combine_exprs(list(v.ZONE_GROUPS), v.MIX_PAIRS, ["sub", "div", "mul", "ave"]),
    )
    return combined.select("row_no", "fold", *v.LABELS, *names)
