"""Stand-in event log and actor table over the driver's ``events`` and ``customer``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldcast.operators.folds import fold_of

FOLDS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# name -> (Spark expression, DuckDB expression); one entry where the text is the same.
# `k` is the number inside the JSON column, `m` the minute, `h` the hour of the event.
_EVENT = {
    "row_no": ("event_id",),
    "year": ("cast(substring(t, 1, 4) as int)",),
    "game_id": ("cast(replace(substring(t, 1, 10), '-', '') as bigint)",),
    "game_date": ("substring(t, 1, 10)",),
    "game_time": ("substring(t, 12, 8)",),
    "home_team_id": ("event_id % 6",),
    "pitcher_team_id": ("user_id % 6",),
    "game_type": (
        "case event_id % 3 when 0 then 'セ・パ交流戦' when 1 then 'セ・リーグ公式戦'"
        " else 'パ・リーグ公式戦' end",),
    "pitch_cnt_in_game": ("cast(event_id % 300 + 1 as int)",),
    "inning": ("h",),
    "half": ("case when m >= 30 then '裏' else '表' end",),
    "bat_cnt_in_inning": ("cast((m div 10) % 3 as int)", "cast((m // 10) % 3 as int)"),
    "pitch_cnt_in_bat": ("cast(event_id % 9 + 1 as int)",),
    "pitcher_id": ("user_id",),
    "pitcher_hand": ("case when user_id % 2 = 0 then '右' else '左' end",),
    "pitcher_role": ("case when event_id % 5 < 2 then '先発' else '中継ぎ' end",),
    "pitch_order": ("cast(event_id % 4 + 1 as int)",),
    "player_cnt_in_game": ("cast(event_id % 27 + 1 as int)",),
    "pitcher_cnt_in_game": ("cast(event_id % 110 + 1 as int)",),
    "pitcher_cnt_in_inning": ("cast(event_id % 15 + 1 as int)",),
    "batter_id": ("(event_id * 7) % 120",),
    "batter_side": ("case when event_id % 2 = 0 then '右' else '左' end",),
    "bat_order": ("cast(event_id % 9 + 1 as int)",),
    "batter_position": ("case when event_id % 9 = 8 then '投手' else '外野手' end",),
    "bat_cnt_in_game": ("cast(event_id % 5 + 1 as int)",),
    "home_point": ("k % 7",),
    "away_point": ("cast(event_id % 5 as int)",),
    "out_cnt": ("cast((event_id div 2) % 3 as int)", "cast((event_id // 2) % 3 as int)"),
    "ball_cnt": ("k % 4",),
    "strike_cnt": ("cast(event_id % 3 as int)",),
    "runner1_id": ("case when k % 3 = 0 then cast(user_id as double) end",),
    "runner2_id": ("case when (k div 2) % 3 = 0 then cast(user_id as double) end",
                   "case when (k // 2) % 3 = 0 then cast(user_id as double) end"),
    "runner3_id": ("case when (k div 3) % 3 = 0 then cast(user_id as double) end",
                   "case when (k // 3) % 3 = 0 then cast(user_id as double) end"),
    "catcher_id": ("case when event_id % 17 <> 0 then (event_id * 3) % 40 end",),
}
# labels, blanked for the rows past the cut
_LABEL = {
    "ball": "case event_type when 'click' then 0 when 'error' then 1 when 'purchase' then 2"
            " when 'signup' then 3 when 'view' then 4 end",
    "course": "k % 13",
}
_ACTOR = {
    "player_id": ("c_custkey",),
    "year": ("2024",),
    "position": (
        "case when c_mktsegment in ('MACHINERY', 'FURNITURE') then '投手'"
        " when c_mktsegment in ('BUILDING', 'HOUSEHOLD') then '捕手' else '外野手' end",),
    "team_id": ("cast(c_nationkey as bigint)",),
    "birth_date": (
        "concat(cast(1980 + c_custkey % 20 as string), '-0', cast(1 + c_custkey % 9 as string),"
        " '-15')",
        "concat(cast(1980 + c_custkey % 20 as varchar), '-0',"
        " cast(1 + c_custkey % 9 as varchar), '-15')"),
    "height": ("cast(165 + c_custkey % 30 as double)",),
    "weight": ("cast(60 + c_custkey % 40 as double)",),
    "univ_id": ("case c_custkey % 4 when 0 then 0 when 1 then null else c_custkey end",),
    "company": ("case when c_custkey % 5 = 0 then 'works' end",),
    "draft_year": (
        "case when c_custkey % 7 <> 0 then cast(2005 + c_custkey % 20 as double) end",),
    "draft_order": ("cast(1 + c_custkey % 8 as double)",),
    "salary": ("case when c_custkey % 13 = 5 then null"
               " else round(greatest(c_acctbal, 0) / 1000, 0) * 1000 end",),
    "throws": ("case when c_custkey % 11 = 10 then '両' when c_custkey % 2 = 0 then '右'"
               " else '左' end",),
    "bats": ("case when c_custkey % 11 = 9 then '両' when (c_custkey div 2) % 2 = 0 then '右'"
             " else '左' end",
             "case when c_custkey % 11 = 9 then '両' when (c_custkey // 2) % 2 = 0 then '右'"
             " else '左' end"),
    "country": ("case c_nationkey % 4 when 0 then null when 3 then '米国' else '日本' end",),
}


def label_cut(spark: SparkSession, sf_dir: str) -> int:
    """First row number without a label: three quarters of the log."""
    return (table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0] + 1) * 3 // 4


def edges_of(cut: int, folds: int = FOLDS) -> list[int]:
    return [cut * k // folds - 1 for k in range(1, folds + 1)]


def raw_pitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log with every row labelled."""
    base = table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "cast(ts as string) as t",
        "cast(hour(ts) as int) as h", "cast(minute(ts) as int) as m",
        "cast(get_json_object(props, '$.k') as int) as k",
    )
    return base.selectExpr(
        *[f"{e[0]} as {n}" for n, e in _EVENT.items()],
        *[f"cast({e} as int) as {n}" for n, e in _LABEL.items()],
    )


def pitch_like(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[int]]:
    """The event log with the last quarter unlabelled, and its fold edges.

    Adds ``pit_bat`` / ``count_key`` (keys) and ``own_fold``.
    """
    from foldcast.plans.features import with_keys

    cut = label_cut(spark, sf_dir)
    edges = edges_of(cut)
    rows = raw_pitch(spark, sf_dir)
    known = F.col("row_no") < cut
    masked = rows.withColumns({n: F.when(known, F.col(n)) for n in _LABEL})
    return with_keys(masked).withColumn("own_fold", fold_of(edges)), edges


def player_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The actor table. Lookups miss too: the log has ids that no actor has, and NULL ids."""
    return table(spark, sf_dir, "customer").selectExpr(*[f"{e[0]} as {n}" for n, e in _ACTOR.items()])


def _duck(exprs: dict) -> str:
    return ",\n    ".join(f"{e[-1]} as {n}" for n, e in exprs.items())


_FOLD_CASE = " ".join(
    f"when event_id <= cut * {k} // {FOLDS} - 1 then {k}" for k in range(1, FOLDS + 1))

PL = f"""
ev as (
  select event_id, user_id, event_type, cast(ts as varchar) as t,
    cast(hour(ts) as int) as h, cast(minute(ts) as int) as m,
    cast(json_extract_string(props, '$.k') as int) as k
  from events),
lim as (select (max(event_id) + 1) * 3 // 4 as cut from events),
pl0 as (
  select {_duck(_EVENT)},
    {", ".join(f"cast(case when event_id < cut then {e} end as int) as {n}"
               for n, e in _LABEL.items())},
    cast(case {_FOLD_CASE} end as int) as own_fold
  from ev, lim),
pl as (
  select *,
    (case pitcher_hand when '左' then 'L' when '右' then 'R' end) || '_' ||
    (case batter_side when '左' then 'L' when '右' then 'R' end) as pit_bat,
    cast(strike_cnt as varchar) || '-' || cast(ball_cnt as varchar) as count_key
  from pl0)"""
#: The log with every row labelled.
RAW = f"""
ev as (
  select event_id, user_id, event_type, cast(ts as varchar) as t,
    cast(hour(ts) as int) as h, cast(minute(ts) as int) as m,
    cast(json_extract_string(props, '$.k') as int) as k
  from events),
rawpl as (
  select {_duck(_EVENT)}, {", ".join(f"cast({e} as int) as {n}" for n, e in _LABEL.items())} from ev)"""
CL = f"""
cl as (select {_duck(_ACTOR)} from customer)"""


def with_pl(body: str) -> str:
    return f"with {PL}{body}"


def with_cl(body: str) -> str:
    return f"with {CL}{body}"


def with_both(body: str) -> str:
    return f"with {PL},{CL}{body}"
