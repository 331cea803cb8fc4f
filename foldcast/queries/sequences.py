"""Order-aware features."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldcast.functions.expr import (
    days_between, elapsed_minutes, mean_interval, remaining_fraction,
)
from foldcast.functions.situation import situation_flags
from foldcast.operators.joins import group_stats
from foldcast.operators.sequence import Group, along_groups, lag_diff
from foldcast.plans.features import PLATE, PLATE_STRICT, SEQUENCE, sequence_features, with_clock
from foldcast.queries.registry import query, rounded
from foldcast.queries.tables import FLAGS, flags_select
from foldcast.queries.views import PL, pitch_like


def _seconds(c: str) -> str:
    return (f"(cast(substring({c}, 1, 2) as int) * 3600 + cast(substring({c}, 4, 2) as int) * 60"
            f" + cast(substring({c}, 7, 2) as int))")


def _ratio(n: str, d: str) -> str:
    return f"cast({n} as double) / nullif({d}, 0)"


SEQ = f"""{PL},
fl as (select *, {flags_select(FLAGS)}, ball_cnt + strike_cnt as ball_count_sum from pl),
ck as (
  select *, min(game_time) over (partition by game_id) as start_time,
    min(game_date) over (partition by year) as opening from fl),
el as (
  select *,
    cast(date_diff('day', cast(opening as date), cast(game_date as date)) as int)
      as date_from_opening,
    (({_seconds('game_time')} - {_seconds('start_time')}) + 86400) % 86400 / 60.0 as elapsed_min
  from ck),
s1 as (
  select *,
    case when pitcher_cnt_in_inning <> 1 then
      elapsed_min - lag(elapsed_min) over (partition by game_id order by row_no) end as min_diff,
    elapsed_min - min(elapsed_min) over (partition by game_id, total_inning)
      as elapsed_from_inning,
    pitch_cnt_in_game - min(pitch_cnt_in_game) over (partition by game_id, total_inning) + 1
      as ballnum_from_inning,
    elapsed_min - min(elapsed_min)
      over (partition by game_id, total_inning, bat_cnt_in_inning) as elapsed_batter,
    max(pitch_cnt_in_bat) over (partition by game_id, inning, bat_cnt_in_inning) as last_pitch,
    1 - coalesce(ball_count_sum - lag(ball_count_sum) over plate, 1) as pre_ball_foul,
    coalesce(ball_cnt - lag(ball_cnt) over plate, 0) as pre_ball_ball,
    coalesce(strike_cnt - lag(strike_cnt) over plate, 0) as strike_step
  from el
  window plate as (partition by game_id, inning, bat_cnt_in_inning order by row_no)),
s2 as (
  select *, strike_step + pre_ball_foul as pre_ball_strike,
    pitch_cnt_in_bat - ball_count_sum as pre_foul_sum,
    {_ratio('elapsed_min', 'pitch_cnt_in_game - 1')} as ave_elapsed_game,
    {_ratio('elapsed_from_inning', 'ballnum_from_inning - 1')} as ave_elapsed_inning,
    {_ratio('elapsed_batter', 'pitch_cnt_in_bat - 1')} as ave_elapsed_batter,
    {_ratio('last_pitch - pitch_cnt_in_bat', 'last_pitch')} as last_ball
  from s1),
sq as (
  select *, min_diff - ave_elapsed_batter as diff_elapsed_batter,
    min_diff - ave_elapsed_inning as diff_elapsed_inning,
    min_diff - ave_elapsed_game as diff_elapsed_game
  from s2)"""
WHOLE = {
    "date_from_opening", "total_inning", "ballnum_from_inning", "nighter", "point_diff",
    "runner_23", "bant", "ball_count_sum", "pre_ball_foul", "pre_ball_ball", "pre_ball_strike",
    "pre_foul_sum",
}


def seq_select(names, source: str = "sq") -> str:
    cols = ", ".join(n if n in WHOLE else f"round({n}, 6) as {n}" for n in names)
    return f"with {SEQ} select row_no, {cols} from {source}"


def _flagged(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return situation_flags(pl)


@query("sequence_features", seq_select(SEQUENCE))
def sequence_features_(spark, sf_dir):
    return rounded(
        sequence_features(with_clock(_flagged(spark, sf_dir))).select("row_no", *SEQUENCE))


_STRICT = ["pre_ball_foul", "pre_ball_ball", "pre_ball_strike", "last_ball"]


@query("sequence_strict", seq_select(_STRICT).replace(
    "partition by game_id, inning, bat_cnt_in_inning",
    "partition by game_id, total_inning, bat_cnt_in_inning"))
def sequence_strict(spark, sf_dir):
    """The same with plate appearances kept apart by half inning."""
    rows = sequence_features(with_clock(_flagged(spark, sf_dir)), PLATE_STRICT)
    return rounded(rows.select("row_no", *_STRICT))


@query("lag_diff", f"""with {PL} select row_no,
    ball_cnt - lag(ball_cnt) over (partition by game_id order by row_no) as diff,
    case when pitcher_cnt_in_inning <> 1 then
      ball_cnt - lag(ball_cnt) over (partition by game_id order by row_no) end as diff_in_inning
    from pl""")
def lag_diff_(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    rows = pl.select("row_no", "game_id", "ball_cnt", "pitcher_cnt_in_inning")
    out = lag_diff(rows, "ball_cnt", ["game_id"], "row_no", "diff")
    return out.select(
        "row_no", "diff",
        F.when(F.col("pitcher_cnt_in_inning") != 1, F.col("diff")).alias("diff_in_inning"))


@query("lag_diff_fill", f"""with {PL} select row_no,
    coalesce(strike_cnt - lag(strike_cnt) over
      (partition by game_id, inning, bat_cnt_in_inning order by row_no), 0) as diff from pl""")
def lag_diff_fill(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    rows = pl.select("row_no", *PLATE, "strike_cnt")
    return lag_diff(rows, "strike_cnt", PLATE, "row_no", "diff", fill=0).select("row_no", "diff")


@query("since_first", seq_select(["date_from_opening", "elapsed_min"]))
def since_first(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    rows = pl.select("row_no", "year", "game_id", "game_date", "game_time")
    dated = group_stats(rows, ["year"], {"opening": F.min("game_date")}, ["row_no"])
    timed = group_stats(dated, ["game_id"], {"start": F.min("game_time")}, ["row_no"])
    return rounded(timed.select(
        "row_no",
        days_between("game_date", "opening").alias("date_from_opening"),
        elapsed_minutes("game_time", "start").alias("elapsed_min"),
    ))


_START = ["elapsed_from_inning", "ballnum_from_inning", "elapsed_batter"]


def _started(spark, sf_dir):
    rows = with_clock(_flagged(spark, sf_dir)).select(
        "row_no", *PLATE_STRICT, "elapsed_min", "pitch_cnt_in_game", "pitch_cnt_in_bat",
        "pitcher_cnt_in_inning")
    out = along_groups(rows, "row_no", [
        Group(PLATE_STRICT, stats={"b0": ("min", "elapsed_min")}),
        Group(["game_id", "total_inning"], stats={
            "t0": ("min", "elapsed_min"), "n0": ("min", "pitch_cnt_in_game")}),
    ], lead=["game_id"])
    return out.withColumns({
        "elapsed_from_inning": F.col("elapsed_min") - F.col("t0"),
        "ballnum_from_inning": F.col("pitch_cnt_in_game") - F.col("n0") + 1,
        "elapsed_batter": F.col("elapsed_min") - F.col("b0"),
    })


@query("since_start", seq_select(_START))
def since_start(spark, sf_dir):
    return rounded(_started(spark, sf_dir).select("row_no", *_START))


_MEANS = ["ave_elapsed_game", "ave_elapsed_inning", "ave_elapsed_batter", "diff_elapsed_batter",
          "diff_elapsed_inning", "diff_elapsed_game"]


@query("mean_interval", seq_select(_MEANS))
def mean_interval_(spark, sf_dir):
    rows = lag_diff(_started(spark, sf_dir), "elapsed_min", ["game_id"], "row_no", "step",
                    boundary=F.col("pitcher_cnt_in_inning") == 1)
    means = {
        "game": mean_interval("elapsed_min", "pitch_cnt_in_game"),
        "inning": mean_interval("elapsed_from_inning", "ballnum_from_inning"),
        "batter": mean_interval("elapsed_batter", "pitch_cnt_in_bat"),
    }
    return rounded(rows.select(
        "row_no",
        *[c.alias(f"ave_elapsed_{n}") for n, c in means.items()],
        *[(F.col("step") - c).alias(f"diff_elapsed_{n}") for n, c in means.items()],
    ))


@query("remaining_fraction", seq_select(["last_ball"]))
def remaining_fraction_(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    rows = pl.select("row_no", *PLATE, "pitch_cnt_in_bat")
    out = along_groups(rows, "row_no", [Group(PLATE, stats={"n": ("max", "pitch_cnt_in_bat")})])
    return rounded(out.select(
        "row_no", remaining_fraction("pitch_cnt_in_bat", "n").alias("last_ball")))


_PREV = ["ball_count_sum", "pre_ball_foul", "pre_ball_ball", "pre_ball_strike", "pre_foul_sum"]


@query("prev_pitch", seq_select(_PREV))
def prev_pitch(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    rows = pl.select("row_no", *PLATE, "ball_cnt", "strike_cnt", "pitch_cnt_in_bat").withColumn(
        "ball_count_sum", F.col("ball_cnt") + F.col("strike_cnt"))
    out = along_groups(rows, "row_no", [Group(PLATE, previous={
        "s0": "ball_count_sum", "b0": "ball_cnt", "k0": "strike_cnt"})])
    foul = 1 - F.coalesce(F.col("ball_count_sum") - F.col("s0"), F.lit(1))
    return out.select(
        "row_no", "ball_count_sum",
        foul.alias("pre_ball_foul"),
        F.coalesce(F.col("ball_cnt") - F.col("b0"), F.lit(0)).alias("pre_ball_ball"),
        (F.coalesce(F.col("strike_cnt") - F.col("k0"), F.lit(0)) + foul).alias("pre_ball_strike"),
        (F.col("pitch_cnt_in_bat") - F.col("ball_count_sum")).alias("pre_foul_sum"),
    )
