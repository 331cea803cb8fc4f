"""Actor histories, profiles, role joins and role combinations."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldcast import vocabulary as v
from foldcast.functions.situation import profile
from foldcast.operators.folds import in_folds
from foldcast.operators.history import actor_history, per_unit_rates
from foldcast.operators.joins import fan_out, lookup_join, side_by_side
from foldcast.operators.mix import conditional_mix
from foldcast.operators.ranks import avg_rank
from foldcast.operators.roles import join_roles_by_fold, pair_combine, pair_combine_two, pair_diff
from foldcast.plans.features import (
    COUNT_KEYS, ROLE_IDS, SITUATION, actor_profiles, build_features, feature_names,
    labelled_lattice, role_table, role_tables,
)
from foldcast.queries.registry import query, rounded
from foldcast.queries.sequences import SEQ, WHOLE
from foldcast.queries.tables import group_sum_sql, raw_share_sql
from foldcast.queries.views import CL, PL, pitch_like, player_like, table, with_cl

_COUNTER_SQL = {
    "pit_game_cnt": ("player_id", "game_id"),
    "pit_inning_cnt": ("player_id", "(game_id, inning)"),
    "pit_batter_cnt": ("player_id, pit_bat", "(game_id, inning, bat_cnt_in_inning)"),
    "cat_game_cnt": ("player_id", "game_id"),
    "batter_cnt": ("player_id", "(game_id, inning, bat_cnt_in_inning)"),
    "bat_game_cnt": ("player_id", "game_id"),
}


def history_sql(role: str) -> str:
    """CTEs h_<role>: class counts and counters per fold, actor and hand."""
    actor, name = ROLE_IDS[role], f"h_{role}"
    counts = ", ".join(
        f"count(*) filter (where ball = {i}) as {b}" for i, b in enumerate(v.BALLS))
    zones = ", ".join(
        f"count(*) filter (where course = {i}) as {z}" for i, z in enumerate(v.ZONES))
    ctes = [
        f"{name}_r as (select *, own_fold as fold, {actor} as player_id from pl"
        f" where own_fold is not null and {actor} is not null and pit_bat is not null)",
        f"{name}_c as (select fold, player_id, pit_bat, {counts},"
        f" count(*) filter (where ball is not null) as total, {zones}"
        f" from {name}_r group by 1, 2, 3)",
    ]
    joins, cols = "", ""
    for c in v.ROLE_COUNTERS[role]:
        keys, of = _COUNTER_SQL[c]
        ctes.append(f"{name}_{c} as (select fold, {keys}, count(distinct {of}) as {c}"
                    f" from {name}_r group by all)")
        joins += f" left join {name}_{c} using (fold, {keys})"
        cols += f", {name}_{c}.{c}"
    ctes.append(f"{name} as (select {name}_c.*{cols} from {name}_c{joins})")
    return ",\n".join(ctes)


def history_query(role: str) -> str:
    cols = ", ".join(["fold", "player_id", "pit_bat", *v.BALLS, "total", *v.ZONES,
                      *v.ROLE_COUNTERS[role]])
    return f"with {PL},\n{history_sql(role)} select {cols} from h_{role}"


def _history(spark, sf_dir, role):
    pl, _ = pitch_like(spark, sf_dir)
    return actor_history(pl.withColumn("fold", F.col("own_fold")), role, ROLE_IDS[role])


@query("history_pitcher", history_query("pitcher"))
def history_pitcher(spark, sf_dir):
    return _history(spark, sf_dir, "pitcher")


@query("history_catcher", history_query("catcher"))
def history_catcher(spark, sf_dir):
    return _history(spark, sf_dir, "catcher")


@query("history_batter", history_query("batter"))
def history_batter(spark, sf_dir):
    return _history(spark, sf_dir, "batter")


_RATES = {
    "pit_inning_per_game": "pit_inning_cnt / pit_game_cnt",
    "pit_batter_per_game": "pit_batter_cnt / pit_game_cnt",
    "pit_ball_per_game": "total / pit_game_cnt",
    "pit_batter_per_inning": "pit_batter_cnt / pit_inning_cnt",
    "pit_ball_per_inning": "total / pit_inning_cnt",
    "pit_ball_per_batter": "total / pit_batter_cnt",
}


@query("per_unit_rates", f"with {PL},\n{history_sql('pitcher')} select fold, player_id, pit_bat, "
       + ", ".join(f"round({e}, 6) as {n}" for n, e in _RATES.items()) + " from h_pitcher")
def per_unit_rates_(spark, sf_dir):
    out = per_unit_rates(_history(spark, sf_dir, "pitcher"))
    return rounded(out.select("fold", "player_id", "pit_bat", *_RATES))


_RANKED = """,
rk as (
  select *, case when salary is not null then
    rank() over (partition by year, team_id order by salary desc nulls last)
    + (count(*) over (partition by year, team_id, salary) - 1) / 2.0 end as salary_rank
  from cl)"""


def profile_sql(log: bool = True) -> str:
    def scale(e):
        return f"ln(1 + {e})" if log else e

    return _RANKED + f""",
pf0 as (
  select *, cast(case when country is distinct from '日本' then 1 else 0 end as int) as foreigner,
    year - cast(substring(birth_date, 1, 4) as int) as age,
    coalesce(year - draft_year, 6) as play_year
  from rk),
pf as (
  select *, salary_rank / nullif(play_year, 0) as rank_year,
    salary_rank * play_year as rank_x_year,
    {scale('salary / nullif(play_year, 0)')} as salary_year,
    {scale('salary * play_year')} as salary_x_year,
    weight * 10000 / (height * height) as bmi
  from pf0)"""


@query("avg_rank", with_cl(f"{_RANKED} select player_id, round(salary_rank, 6) as salary_rank"
                           " from rk"))
def avg_rank_(spark, sf_dir):
    cl = player_like(spark, sf_dir)
    ranked = avg_rank(cl, "salary", ["year", "team_id"], ["player_id", "year"], "salary_rank")
    return rounded(ranked.select("player_id", "salary_rank"))


@query("avg_rank_orders", """
    select o_orderkey, round(rank() over (partition by o_orderpriority order by price)
      + (count(*) over (partition by o_orderpriority, price) - 1) / 2.0, 6) as price_rank
    from (select o_orderkey, o_orderpriority, round(o_totalprice / 100, 0) as price from orders)
    """)
def avg_rank_orders(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority",
        F.round(F.col("o_totalprice") / 100, 0).alias("price"))
    ranked = avg_rank(orders, "price", ["o_orderpriority"], ["o_orderkey"], "price_rank",
                      descending=False)
    return rounded(ranked.select("o_orderkey", "price_rank"))


_PROFILE = ["foreigner", *v.PROFILE]


def _rounded_sql(names, whole=("foreigner", "age")) -> str:
    return ", ".join(n if n in whole else f"round({n}, 6) as {n}" for n in names)


@query("profile", with_cl(f"{profile_sql()} select player_id, {_rounded_sql(_PROFILE)} from pf"))
def profile_(spark, sf_dir):
    return rounded(actor_profiles(player_like(spark, sf_dir)).select("player_id", *_PROFILE))


_SCHOOL = ["worked", "univ", "highsch"]
_PLAIN = ["rank_year", "rank_x_year", "salary_year", "salary_x_year"]


@query("profile_nb", with_cl(f"""{profile_sql(log=False)}, sc as (
    select *, cast(case when company is not null then 1 else 0 end as int) as worked,
      cast(case when univ_id is distinct from 0 then 1 else 0 end as int) as univ from pf)
    select player_id, {_rounded_sql(_PLAIN)}, worked, univ,
      cast(case when worked = 0 and univ = 0 and foreigner = 0 then 1 else 0 end as int)
      as highsch from sc"""))
def profile_nb(spark, sf_dir):
    cl = player_like(spark, sf_dir)
    ranked = avg_rank(cl, "salary", ["year", "team_id"], ["player_id", "year"], "salary_rank")
    out = profile(ranked, log=False, schooling=True)
    return rounded(out.select("player_id", *_PLAIN, *_SCHOOL))


def _values(rows, names) -> str:
    return "(values " + ", ".join(
        "(" + ", ".join(f"'{x}'" for x in r) + ")" for r in rows) + f") d({names})"


@query("hand_expand", with_cl(
    " select player_id, throws, pit_bat from (select * from cl where position = '投手')"
    f" full join {_values(v.THROW_HANDS, 'throws, pit_bat')} using (throws)"))
def hand_expand(spark, sf_dir):
    cl = player_like(spark, sf_dir).where(F.col("position") == v.PITCHER)
    return fan_out(cl, v.THROW_HANDS, "throws", "pit_bat").select(
        "player_id", "throws", "pit_bat")


@query("hand_expand_unused", with_cl(
    " select player_id, throws, pit_bat from (select * from cl where throws <> '左')"
    f" full join {_values(v.THROW_HANDS, 'throws, pit_bat')} using (throws)"))
def hand_expand_unused(spark, sf_dir):
    """The full outer case: nobody throws left, so both left-hand entries appear alone."""
    cl = player_like(spark, sf_dir).where(F.col("throws") != "左")
    return fan_out(cl, v.THROW_HANDS, "throws", "pit_bat").select(
        "player_id", "throws", "pit_bat")


@query("hand_expand_all", with_cl(
    f" select player_id, pit_bat from cl, {_values([(h,) for h in v.HANDS], 'pit_bat')}"
    " where position = '捕手'"))
def hand_expand_all(spark, sf_dir):
    cl = player_like(spark, sf_dir).where(F.col("position") == v.CATCHER)
    return fan_out(cl, v.HANDS, None, "pit_bat").select("player_id", "pit_bat")


_HANDED = {
    "pitcher": "select * from pf join "
               + _values(v.THROW_HANDS, "throws, pit_bat") + " using (throws)"
               " where position = '投手'"
               " union all by name select *, null as pit_bat from pf"
               " where position = '投手' and throws not in ('左', '右')",
    "catcher": "select * from pf, " + _values([(h,) for h in v.HANDS], "pit_bat")
               + " where position = '捕手'",
    "batter": "select * from pf join " + _values(v.BAT_HANDS, "bats, pit_bat") + " using (bats)"
              " union all by name select *, null as pit_bat from pf"
              " where bats not in ('左', '右')",
}
_SEGMENT = {
    "pitcher": "foreigner", "catcher": "0",
    "batter": "case when position = '投手' then 1 else 0 end",
}


def role_sql(role: str, fill: bool = True) -> str:
    """CTEs up to t_<role>; needs pl, pf and the role's history."""
    filled = [*v.BALLS, "total", *v.ZONES, *v.ROLE_COUNTERS[role]]
    n = f"t_{role}"
    hist = ", ".join(f"h.{c}" for c in filled)
    if fill:
        value = ", ".join(
            f"case when seen = 1 then {c} when pit_bat is not null then"
            f" avg(case when seen = 1 then {c} end) over (partition by seg, pit_bat, fold)"
            f" end as {c}" for c in filled)
    else:
        value = ", ".join(filled)
    shares = ", ".join(f"{c} / nullif(total, 0) as {c}" for c in [*v.BALLS, *v.ZONES])
    rest = ", ".join(["player_id", "year", "pit_bat", "fold", *v.PROFILE])
    counters = ", ".join(["total", *v.ROLE_COUNTERS[role]])
    groups = ", ".join(
        " + ".join(f"course_{i}" for i in m) + f" as {g}" for g, m in v.ZONE_GROUPS.items())
    return f""",
{n}_x as (select * from ({_HANDED[role]}), (select unnest([1, 2, 3, 4]) as fold)),
{n}_j as (
  select x.*, {_SEGMENT[role]} as seg, case when h.total is not null then 1 else 0 end as seen,
    {hist}
  from {n}_x x left join h_{role} h
    on x.player_id = h.player_id and x.pit_bat = h.pit_bat and x.fold = h.fold),
{n}_f as (select {rest}, {value} from {n}_j),
{n}_s as (select {rest}, {counters}, {shares} from {n}_f),
{n} as (select {rest}, {", ".join(v.BALLS)}, {counters}, {groups} from {n}_s)"""


def role_query(role: str, fill: bool) -> str:
    mixes = [*v.BALLS, "total", *v.ZONE_GROUPS, *v.ROLE_COUNTERS[role]]
    cols = ", ".join(f"round({c}, 6) as {c}" for c in mixes)
    return (f"with {PL},{CL}{profile_sql()},\n{history_sql(role)}{role_sql(role, fill)}"
            f" select player_id, pit_bat, fold, {cols} from t_{role}")


def _role(spark, sf_dir, role, fill=True, min_years=None):
    pl, edges = pitch_like(spark, sf_dir)
    profiles = actor_profiles(player_like(spark, sf_dir))
    mixes = [*v.BALLS, "total", *v.ZONE_GROUPS, *v.ROLE_COUNTERS[role]]
    lattice = labelled_lattice(pl, edges)
    out = role_table(profiles, lattice, role, edges, fill, min_years).select(
        "player_id", "pit_bat", "fold", *[F.col(c).cast("double") for c in mixes])
    return rounded(out)


@query("fill_segment_mean", role_query("pitcher", True))
def fill_segment_mean_(spark, sf_dir):
    return _role(spark, sf_dir, "pitcher")


@query("fill_segment_mean_batter", role_query("batter", True))
def fill_segment_mean_batter(spark, sf_dir):
    return _role(spark, sf_dir, "batter")


@query("fill_segment_mean_catcher", role_query("catcher", True))
def fill_segment_mean_catcher(spark, sf_dir):
    return _role(spark, sf_dir, "catcher")


@query("fill_none", role_query("pitcher", False).replace(
    "round(total, 6)", "round(cast(total as double), 6)").replace(
    "round(pit_game_cnt, 6)", "round(cast(pit_game_cnt as double), 6)").replace(
    "round(pit_inning_cnt, 6)", "round(cast(pit_inning_cnt as double), 6)").replace(
    "round(pit_batter_cnt, 6)", "round(cast(pit_batter_cnt as double), 6)"))
def fill_none(spark, sf_dir):
    return _role(spark, sf_dir, "pitcher", fill=False)


_YEARS = 5


@query("fill_few_years", role_query("pitcher", True).replace(
    "case when h.total is not null then 1",
    f"case when h.total is not null and play_year >= {_YEARS} then 1"))
def fill_few_years(spark, sf_dir):
    """History of actors with few years of play is left out before the filling."""
    return _role(spark, sf_dir, "pitcher", min_years=_YEARS)


_ROLES = ("pitcher", "batter", "catcher")
_SHORT = {"pitcher": "pit", "batter": "bat", "catcher": "cat"}
_CARRIED = [*v.PROFILE, *v.BALLS, "total", *v.ZONE_GROUPS]


def _joined_sql(ctes_before: str = PL, events: str = "pl") -> str:
    cols, joins = "", ""
    for role in _ROLES:
        s = _SHORT[role]
        carried = [*_CARRIED, *v.ROLE_COUNTERS[role]]
        cols += ", " + ", ".join(f"{s}.{c} as {c}_{s}" for c in carried)
        joins += (f" left join t_{role} {s} on e.{ROLE_IDS[role]} = {s}.player_id"
                  f" and e.year = {s}.year and e.pit_bat = {s}.pit_bat and e.fold = {s}.fold")
    ctes = "".join(f",\n{history_sql(r)}" for r in _ROLES) + "".join(role_sql(r) for r in _ROLES)
    return f"""with {ctes_before},{CL}{profile_sql()}{ctes},
mx0 as (
  select count_key, pit_bat, {raw_share_sql(v.BALLS, 'ball', 'bc_')},
    {raw_share_sql(v.ZONES, 'course', 'bc_')} from pl where own_fold is not null group by 1, 2),
mx as (select count_key, pit_bat, {", ".join("bc_" + b for b in v.BALLS)},
  {", ".join("bc_" + z for z in v.ZONES)}, {group_sum_sql().replace("round(", "(").replace(", 6)", ")")}
  from mx0),
ex as (
  select {events}.*, mx.* exclude (count_key, pit_bat), f.k as fold
  from {events} left join mx using (count_key, pit_bat), (select unnest([1, 2, 3, 4]) as k) f
  where own_fold is null or own_fold <> f.k),
rj as (select e.*{cols} from ex e{joins})"""


_SHOWN = [f"{c}_{_SHORT[r]}" for r in _ROLES for c in [*_CARRIED, *v.ROLE_COUNTERS[r]]]
_WHOLE_NUMBERS = {"age", *(c for r in _ROLES for c in v.ROLE_COUNTERS[r])}


@query("role_join", _joined_sql() + " select row_no, fold, "
       + ", ".join(c if c.rsplit("_", 1)[0] in _WHOLE_NUMBERS else f"round({c}, 6) as {c}"
                   for c in _SHOWN) + " from rj")
def role_join(spark, sf_dir):
    return rounded(_joined(spark, sf_dir).select("row_no", "fold", *_SHOWN))


def _joined(spark, sf_dir, with_mix=False):
    pl, edges = pitch_like(spark, sf_dir)
    narrow = pl.select("row_no", "year", *ROLE_IDS.values(), *COUNT_KEYS)
    # the wide columns come after the joins: without a shuffle the files' parts would be the tasks
    dealt = narrow.repartition("row_no")

    def events():
        if not with_mix:
            return dealt
        mix = conditional_mix(pl.where(in_folds(edges)), COUNT_KEYS, v.BALLS, v.ZONES)
        return lookup_join(dealt, mix, COUNT_KEYS, ["row_no"])

    rows, roles = side_by_side(
        spark, [events, lambda: role_tables(player_like(spark, sf_dir), pl, edges)])
    return join_roles_by_fold(rows, roles, ["year", "pit_bat"], edges, ["row_no"], narrow)


_DIFFS = {f"{c}_dif_{p}": f"{c}_{a} - {c}_{b}"
          for p, (a, b) in v.ROLE_PAIRS.items() for c in v.PROFILE_DIFFS}


@query("pair_diff", _joined_sql() + " select row_no, fold, "
       + ", ".join(e + " as " + n if n.startswith("age") else f"round({e}, 6) as {n}"
                   for n, e in _DIFFS.items()) + " from rj")
def pair_diff_(spark, sf_dir):
    out = pair_diff(_joined(spark, sf_dir), v.PROFILE_DIFFS, v.ROLE_PAIRS)
    return rounded(out.select("row_no", "fold", *_DIFFS))


def _combine_sql(names, pairs, ops, short=False) -> dict[str, str]:
    def src(n, s):
        return f"bc_{n}" if s == "bc" else f"{n}_{s}"

    out = {}
    for n in names:
        for op in ops:
            for p, (a, b) in pairs.items():
                x, y = src(n, a), src(n, b)
                base = f"({src('straight', a)} + {src('straight', b)}) / 2"
                out[f"{op}_{n}" if short else f"{op}_{p}_{n}"] = {
                    "sub": f"{x} - {y}", "div": f"{x} / nullif({y}, 0)", "mul": f"{x} * {y}",
                    "ave": f"({x} + {y}) / 2",
                    "rate": f"(({x} + {y}) / 2) / nullif(1 - {base}, 0)",
                }[op]
    return out


_COMBINED = (_combine_sql(v.BALLS, v.MIX_PAIRS, ["sub", "div", "mul", "ave", "rate"])
             | _combine_sql(list(v.ZONE_GROUPS), v.MIX_PAIRS, ["sub", "div", "mul", "ave"]))
_TWO = (_combine_sql(v.BALLS, {"bc_p": ("bc", "pit")}, ["sub", "div", "mul", "ave", "rate"], True)
        | _combine_sql(v.BALLS, {"p_c": ("pit", "cat"), "bc_c": ("bc", "cat")}, ["sub"])
        | _combine_sql(list(v.ZONE_GROUPS), {"bc_p": ("bc", "pit")},
                       ["sub", "div", "mul", "ave"], True))


def _select_sql(exprs) -> str:
    cols = ", ".join(f"round({e}, 6) as {n}" for n, e in exprs.items())
    return f" select row_no, fold, {cols} from rj"


@query("pair_combine", _joined_sql() + _select_sql(_COMBINED))
def pair_combine_(spark, sf_dir):
    joined = _joined(spark, sf_dir, with_mix=True)
    out = pair_combine(joined, v.BALLS, v.MIX_PAIRS, ("sub", "div", "mul", "ave", "rate"),
                       base="straight")
    out = pair_combine(out, list(v.ZONE_GROUPS), v.MIX_PAIRS)
    return rounded(out.select("row_no", "fold", *_COMBINED))


@query("pair_combine_two", _joined_sql() + _select_sql(_TWO))
def pair_combine_two_(spark, sf_dir):
    joined = _joined(spark, sf_dir, with_mix=True)
    out = pair_combine_two(joined, v.BALLS, list(v.ZONE_GROUPS), "straight")
    return rounded(out.select("row_no", "fold", *_TWO))


def _feature_sql() -> str:
    exprs = _DIFFS | _combine_sql(
        v.BALLS, v.MIX_PAIRS, ["sub", "div", "mul", "ave", "rate"]
    ) | _combine_sql(list(v.ZONE_GROUPS), v.MIX_PAIRS, ["sub", "div", "mul", "ave"])
    whole = {*v.COUNTERS, *SITUATION, *WHOLE}
    cols = ", ".join(
        f"{exprs.get(n, n)} as {n}" if n in whole or n.startswith("age_")
        else f"round({exprs.get(n, n)}, 6) as {n}"
        for n in feature_names())
    return _joined_sql(SEQ, "sq") + f" select row_no, fold, ball, course, {cols} from rj"


@query("feature_table", _feature_sql())
def feature_table(spark, sf_dir):
    """All 640 features of every event and fold."""
    pl, edges = pitch_like(spark, sf_dir)
    return rounded(build_features(pl.drop("own_fold", "pit_bat", "count_key"),
                                  player_like(spark, sf_dir), edges))
