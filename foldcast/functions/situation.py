"""Row-level features of the game situation and of an actor's profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast import vocabulary as v
from foldcast.functions.expr import clock_seconds, flag, row_sum, safe_div


def _situation() -> dict[str, Column]:
    first = flag(F.col("runner1_id").isNotNull())
    second = flag(F.col("runner2_id").isNotNull())
    third = flag(F.col("runner3_id").isNotNull())
    bottom = flag(F.col("half") == v.BOTTOM_HALF)
    home = flag(F.col("pitcher_team_id") == F.col("home_team_id"))
    lead = F.col("home_point") - F.col("away_point")
    return {
        "first": first,
        "second": second,
        "third": third,
        "base_cnt": row_sum([first, second, third]),
        "top_bot": bottom,
        "total_inning": (F.col("inning") - 1) * 2 + bottom,
        "nighter": flag(clock_seconds("game_time") >= 18 * 3600),
        "home": home,
        "point_diff": F.when(home == 1, lead).otherwise(-lead),
        "runner_23": flag((second == 1) | (third == 1)),
        "bant": flag(
            (first == 1) & (third == 0) & (F.col("out_cnt") == 0) & (F.col("strike_cnt") < 2)
        ),
    }


def _situation_more() -> dict[str, Column]:
    base = _situation()
    cleanup = flag(F.col("bat_order").between(1, 5))

    def left_hand(col: str) -> Column:
        hand = F.col(col)
        return F.when(hand.isin("左", "L"), 1).when(hand.isin("右", "R"), 0)

    return {
        "pitch_LR": left_hand("pitcher_hand"),
        "bat_LR": left_hand("batter_side"),
        "role": flag(F.col("pitcher_role") == v.STARTER),
        "pos_pit": flag(F.col("batter_position") == v.PITCHER),
        "sayonara": flag((F.col("inning") >= 9) & (F.col("half") == v.BOTTOM_HALF)),
        "extention": flag(F.col("inning") > 9),
        "ce_pa": flag(F.col("game_type") == v.INTERLEAGUE),
        "league": flag(F.col("game_type") == v.CENTRAL_LEAGUE),
        "squize": flag(
            (base["third"] == 1) & (F.col("out_cnt") < 2) & (F.col("strike_cnt") < 2)
        ),
        "cleanup": cleanup,
        "pinch": flag((base["runner_23"] == 1) & (cleanup == 1)),
        "fourball": flag((base["base_cnt"] == 3) & (F.col("ball_cnt") > 1)),
        "savepoint": flag((F.col("inning") >= 9) & (base["point_diff"] < 4)),
    }


def situation_flags(df: DataFrame, extended: bool = False) -> DataFrame:
    """Add the situation columns; ``extended`` adds the flags only the first models used."""
    exprs = _situation()
    if extended:
        exprs |= _situation_more()
    return df.select("*", *[e.alias(n) for n, e in exprs.items()])


def profile(df: DataFrame, rank: str = "salary_rank", log: bool = True,
            schooling: bool = False) -> DataFrame:
    """Profile columns of an actor row that already carries its tie-averaged salary rank.

    ``log=False`` leaves the salary ratios on their own scale; ``schooling`` adds the
    company, university and high-school flags.
    """
    foreigner = flag(~F.col("country").eqNullSafe(v.DOMESTIC))
    year = F.col("year")
    play_year = F.coalesce(year - F.col("draft_year"), F.lit(float(v.UNDRAFTED_YEARS)))
    scale = F.log1p if log else (lambda c: c)
    exprs = {
        "foreigner": foreigner,
        "age": year - F.year(F.try_to_date("birth_date", "yyyy-MM-dd")),
        "play_year": play_year,
        "rank_year": safe_div(rank, play_year),
        "rank_x_year": F.col(rank) * play_year,
        "salary_year": scale(safe_div("salary", play_year)),
        "salary_x_year": scale(F.col("salary") * play_year),
        "bmi": safe_div(F.col("weight") * 10000, F.col("height") * F.col("height")),
    }
    if schooling:
        company = flag(F.col("company").isNotNull())
        univ = flag(~F.col("univ_id").eqNullSafe(0))
        exprs |= {
            "worked": company,
            "univ": univ,
            "highsch": flag((company == 0) & (univ == 0) & (foreigner == 0)),
        }
    return df.select("*", *[e.alias(n) for n, e in exprs.items()])
