"""Counts, shares, mixes and summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldcast import vocabulary as v
from foldcast.functions.expr import drop_matching, one_hot
from foldcast.functions.situation import situation_flags
from foldcast.operators import mix, summary
from foldcast.operators.folds import (
    fold_complement, fold_rows, holdout, labelled, out_of_fold, unlabelled,
)
from foldcast.operators.forecast import coarse_label, prior_forecast
from foldcast.operators.joins import append_unlabelled, scratch_path
from foldcast.queries.registry import query, rounded
from foldcast.queries.views import (
    RAW, edges_of, label_cut, pitch_like, player_like, raw_pitch, table, with_both, with_pl,
)
from foldcast.sources.files import (
    read_events, read_events_checked, read_probs, table_path, write_submission, write_table,
)

KEYS = ["count_key", "pit_bat"]
QUANTITIES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
FLAGS = ["first", "second", "third", "base_cnt", "top_bot", "total_inning", "nighter", "home",
         "point_diff", "runner_23", "bant"]
MORE_FLAGS = ["pitch_LR", "bat_LR", "role", "pos_pit", "sayonara", "extention", "ce_pa",
              "league", "squize", "cleanup", "pinch", "fourball", "savepoint"]


def share_sql(names, label, prefix="", total="count(*)") -> str:
    return ", ".join(
        f"round(count(*) filter (where {label} = {i}) / {total}, 6) as {prefix}{n}"
        for i, n in enumerate(names))


def mix_sql(keys, label, names, prefix="bc_") -> str:
    cols = ", ".join(keys)
    return (f" select {cols}, {share_sql(names, label, prefix)} from pl"
            f" where {label} is not null group by {cols}")


@query("value_counts", "select event_type, count(*) as n from events group by 1")
def value_counts(spark, sf_dir):
    return summary.value_counts(table(spark, sf_dir, "events"), "event_type")


@query("class_prior", with_pl(f" select {share_sql(v.BALLS, 'ball')} from pl"
                              " where ball is not null"))
def class_prior(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return rounded(summary.class_prior(labelled(pl, "ball"), "ball", v.BALLS))


@query("prior_forecast", with_pl(
    f", prior as (select {share_sql(v.BALLS, 'ball').replace('round(', '(').replace(', 6)', ')')}"
    " from pl where ball is not null)"
    f" select row_no, {', '.join(f'round({b}, 6) as {b}' for b in v.BALLS)} from pl, prior"
    " where ball is null"))
def prior_forecast_(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    prior = summary.class_prior(labelled(pl, "ball"), "ball", v.BALLS)
    return rounded(prior_forecast(unlabelled(pl, "ball").select("row_no"), prior))


def _describe_sql() -> str:
    parts = [
        f"""select '{c}' as "column", count({c}) as "count", round(avg({c}), 6) as mean,
          round(stddev_samp({c}), 6) as std, round(min({c}), 6) as "min",
          round(max({c}), 6) as "max", round(quantile_cont({c}, 0.25), 6) as q25,
          round(quantile_cont({c}, 0.5), 6) as q50, round(quantile_cont({c}, 0.75), 6) as q75
          from lineitem""" for c in QUANTITIES]
    return " union all ".join(parts)


@query("describe_exact", _describe_sql())
def describe_exact(spark, sf_dir):
    from foldcast.operators.ranks import describe_exact as describe

    return rounded(describe(table(spark, sf_dir, "lineitem"), QUANTITIES))


@query("column_profile", " union all ".join(
    f"""select '{c}' as "column", '{t}' as type, count({c}) as non_null from orders"""
    for c, t in [("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
                 ("o_totalprice", "double"), ("o_orderdate", "timestamp_ntz"),
                 ("o_orderpriority", "string")]))
def column_profile(spark, sf_dir):
    return summary.column_profile(table(spark, sf_dir, "orders"))


@query("column_means", "select " + ", ".join(
    f"round(avg({c}), 6) as {c}" for c in QUANTITIES) + " from lineitem")
def column_means(spark, sf_dir):
    return rounded(summary.column_means(table(spark, sf_dir, "lineitem"), QUANTITIES))


@query("one_hot", "select o_orderkey, " + ", ".join(
    f"""cast(case when o_orderpriority = '{p}' then 1 else 0 end as int) as "p_{p}" """
    for p in PRIORITIES) + " from orders")
def one_hot_(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return one_hot(orders, "o_orderpriority", PRIORITIES, "p").drop("o_orderpriority")


@query("count_mix_ball", with_pl(mix_sql(KEYS, "ball", v.BALLS)))
def count_mix_ball(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return rounded(mix.class_mix(pl, KEYS, "ball", v.BALLS, "bc_"))


@query("count_mix_zone", with_pl(mix_sql(KEYS, "course", v.ZONES)))
def count_mix_zone(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return rounded(mix.class_mix(pl, KEYS, "course", v.ZONES, "bc_"))


@query("class_share", with_pl(
    ", c as (select count_key, pit_bat, ball, count(*) as n from pl where ball is not null"
    " group by all) select count_key, pit_bat, ball, n,"
    " round(n / sum(n) over (partition by count_key, pit_bat), 6) as share from c"))
def class_share(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return rounded(mix.class_share(pl, KEYS, "ball"))


def raw_share_sql(names, label, prefix="") -> str:
    return ", ".join(
        f"count(*) filter (where {label} = {i}) / nullif(count({label}), 0) as {prefix}{n}"
        for i, n in enumerate(names))


def group_sum_sql(prefix="bc_", out="bc_") -> str:
    return ", ".join(
        f"round({' + '.join(f'{prefix}course_{i}' for i in members)}, 6) as {out}{g}"
        for g, members in v.ZONE_GROUPS.items())


@query("conditional_mix", with_pl(
    f", c as (select count_key, pit_bat, {raw_share_sql(v.BALLS, 'ball', 'bc_')},"
    f" {raw_share_sql(v.ZONES, 'course', 'bc_')} from pl where ball is not null group by 1, 2)"
    f" select count_key, pit_bat,"
    f" {', '.join(f'round(bc_{n}, 6) as bc_{n}' for n in v.BALLS + v.ZONES)},"
    f" {group_sum_sql()} from c"))
def conditional_mix(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return rounded(mix.conditional_mix(labelled(pl, "ball"), KEYS, v.BALLS, v.ZONES))


@query("zone_rollup", with_pl(
    f", c as (select pitcher_id, pit_bat, {raw_share_sql(v.ZONES, 'course', 'bc_')} from pl"
    f" where course is not null group by 1, 2) select pitcher_id, pit_bat, {group_sum_sql()} from c"
))
def zone_rollup(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    zones = mix.class_mix(pl, ["pitcher_id", "pit_bat"], "course", v.ZONES, "bc_")
    out = mix.rollup_groups(zones, v.ZONE_GROUPS, v.ZONES, "bc_")
    return rounded(out.drop(*[f"bc_{z}" for z in v.ZONES]))


@query("relative_mix", with_pl(
    f", c as (select count_key, pit_bat, {raw_share_sql(v.BALLS, 'ball', 'bc_')} from pl"
    " where ball is not null group by 1, 2) select count_key, pit_bat, " + ", ".join(
        f"round(bc_{b} / nullif(bc_straight, 0), 6) as bc_{b}" for b in v.BALLS[1:]) + " from c"))
def relative_mix(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    shares = mix.class_mix(pl, KEYS, "ball", v.BALLS, "bc_")
    ratios = mix.relative_to(shares, [f"bc_{b}" for b in v.BALLS[1:]], "bc_straight")
    return rounded(ratios.drop("bc_straight"))


def flag_sql(cond: str) -> str:
    return f"cast(case when {cond} then 1 else 0 end as int)"


_F1, _F2, _F3 = (f"runner{i}_id is not null" for i in (1, 2, 3))
_LEAD = "(case when pitcher_team_id = home_team_id then 1 else -1 end) * (home_point - away_point)"
_FLAG_SQL = {
    "first": flag_sql(_F1), "second": flag_sql(_F2), "third": flag_sql(_F3),
    "base_cnt": " + ".join(flag_sql(c) for c in (_F1, _F2, _F3)),
    "top_bot": flag_sql("half = '裏'"),
    "total_inning": f"(inning - 1) * 2 + {flag_sql("half = '裏'")}",
    "nighter": flag_sql("cast(substring(game_time, 1, 2) as int) >= 18"),
    "home": flag_sql("pitcher_team_id = home_team_id"),
    "point_diff": _LEAD,
    "runner_23": flag_sql(f"{_F2} or {_F3}"),
    "bant": flag_sql(f"{_F1} and not ({_F3}) and out_cnt = 0 and strike_cnt < 2"),
    "pitch_LR": flag_sql("pitcher_hand = '左'"), "bat_LR": flag_sql("batter_side = '左'"),
    "role": flag_sql("pitcher_role = '先発'"), "pos_pit": flag_sql("batter_position = '投手'"),
    "sayonara": flag_sql("inning >= 9 and half = '裏'"), "extention": flag_sql("inning > 9"),
    "ce_pa": flag_sql("game_type = 'セ・パ交流戦'"),
    "league": flag_sql("game_type = 'セ・リーグ公式戦'"),
    "squize": flag_sql(f"{_F3} and out_cnt < 2 and strike_cnt < 2"),
    "cleanup": flag_sql("bat_order between 1 and 5"),
    "pinch": flag_sql(f"({_F2} or {_F3}) and bat_order between 1 and 5"),
    "fourball": flag_sql(f"{_F1} and {_F2} and {_F3} and ball_cnt > 1"),
    "savepoint": flag_sql(f"inning >= 9 and {_LEAD} < 4"),
}


def flags_select(names) -> str:
    return ", ".join(f"{_FLAG_SQL[n]} as {n}" for n in names)


@query("situation_flags", with_pl(f" select row_no, {flags_select(FLAGS)} from pl"))
def situation_flags_(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return situation_flags(pl).select("row_no", *FLAGS)


@query("situation_flags_nb", with_pl(f" select row_no, {flags_select(MORE_FLAGS)} from pl"))
def situation_flags_nb(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return situation_flags(pl, extended=True).select("row_no", *MORE_FLAGS)


@query("append_unlabelled", with_pl(
    " select row_no, ball, course, case when ball is null then 'test' else 'train' end as part"
    " from pl"))
def append_unlabelled_(spark, sf_dir):
    rows = raw_pitch(spark, sf_dir)
    cut = label_cut(spark, sf_dir)
    train = rows.where(F.col("row_no") < cut)
    test = rows.where(F.col("row_no") >= cut).drop(*v.LABELS)
    both = append_unlabelled(train, test).select("row_no", *v.LABELS)
    return labelled(both, "ball").withColumn("part", F.lit("train")).unionByName(
        unlabelled(both, "ball").withColumn("part", F.lit("test")))


@query("fold_rows", with_pl(" select row_no, own_fold as fold, ball from pl where own_fold = 2"))
def fold_rows_(spark, sf_dir):
    pl, edges = pitch_like(spark, sf_dir)
    return fold_rows(pl, 2, edges).select("row_no", F.col("own_fold").alias("fold"), "ball")


@query("fold_complement", with_pl(
    " select f.k as fold, row_no, ball from pl, (select unnest([1, 2, 3, 4]) as k) f"
    " where own_fold is null or own_fold <> f.k"))
def fold_complement_(spark, sf_dir):
    pl, edges = pitch_like(spark, sf_dir)
    parts = [
        fold_complement(pl, k, edges).select(F.lit(k).alias("fold"), "row_no", "ball")
        for k in range(1, len(edges) + 1)
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("holdout_split", with_pl(
    " select row_no, cast((((row_no % 1000003) * 7919 + 0) % 65537) % 4 = 0 as int) as is_test"
    " from pl"))
def holdout_split(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return holdout(pl.select("row_no"))


def _lookup_sql(lookup) -> str:
    whens = " ".join(f"when {i} then {c}" for i, c in enumerate(lookup))
    return f"cast(case course {whens} end as int)"


@query("label_recode_lr", with_pl(
    f" select row_no, course, {_lookup_sql(v.LR_LOOKUP)} as coarse from pl"))
def label_recode_lr(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return coarse_label(pl.select("row_no", "course"), "course", v.LR_LOOKUP, "coarse")


@query("label_recode_hl", with_pl(
    f" select row_no, course, {_lookup_sql(v.HL_LOOKUP)} as coarse from pl"))
def label_recode_hl(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return coarse_label(pl.select("row_no", "course"), "course", v.HL_LOOKUP, "coarse")


@query("label_recode_strike", with_pl(
    f" select row_no, course, {_lookup_sql(v.STRIKE_LOOKUP)} as coarse from pl"))
def label_recode_strike(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return coarse_label(pl.select("row_no", "course"), "course", v.STRIKE_LOOKUP, "coarse")


@query("decode_label", with_pl(
    " select row_no, case ball " + " ".join(
        f"when {i} then '{b}'" for i, b in enumerate(v.BALLS)) + " end as ball_name from pl"))
def decode_label(spark, sf_dir):
    from foldcast.functions.expr import decode

    pl, _ = pitch_like(spark, sf_dir)
    return pl.select("row_no", decode("ball", v.BALLS).alias("ball_name"))


_PARTS = ["_str_pit", "_ball_pit", "_str_bat", "_ball_bat"]


@query("drop_matching", with_pl(
    ", s as (select pitcher_id, " + ", ".join(
        f"count(*) filter (where course in ({', '.join(map(str, v.ZONE_GROUPS[g]))})) as {g}"
        for g in ("high_str", "low_ball", "mid_str"))
    + " from pl where pitcher_id is not null group by 1)"
    " select pitcher_id, mid_str as mid_strike_pit from s"))
def drop_matching_(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    counts = mix.class_counts(pl, ["pitcher_id"], "course", v.ZONES)
    grouped = mix.rollup_groups(counts, v.ZONE_GROUPS, v.ZONES)
    named = grouped.select(
        "pitcher_id", F.col("high_str").alias("high_str_pit"),
        F.col("low_ball").alias("low_ball_pit"), F.col("mid_str").alias("mid_strike_pit"))
    return drop_matching(named, _PARTS)


@query("foreigner_inner", with_both(
    ", f as (select player_id from cl where country is distinct from '日本')"
    f", p as (select ball from pl join f on pitcher_id = player_id where ball is not null)"
    f" select {share_sql(v.BALLS, 'ball')} from p"))
def foreigner_inner(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    foreign = player_like(spark, sf_dir).where(~F.col("country").eqNullSafe(v.DOMESTIC))
    # the class counts per pitcher are joined, not the events: a hot pitcher is one row
    counts = mix.class_counts(labelled(pl, "ball"), ["pitcher_id"], "ball", v.BALLS, "total")
    matched = counts.join(foreign.select(F.col("player_id").alias("pitcher_id")), "pitcher_id")
    return rounded(matched.agg(*[(F.sum(b) / F.sum("total")).alias(b) for b in v.BALLS]))


@query("csv_roundtrip", with_pl(
    ", prior as (select " + raw_share_sql(v.BALLS, "ball")
    + " from pl where ball is not null)"
    f" select row_no - cut as index, {', '.join(f'round({b}, 6) as {b}' for b in v.BALLS)}"
    " from pl, prior, lim where ball is null"))
def csv_roundtrip(spark, sf_dir):
    """Forecast written as Parquet by fold and as header-less CSV, and read back."""
    pl, _ = pitch_like(spark, sf_dir)
    prior = summary.class_prior(labelled(pl, "ball"), "ball", v.BALLS)
    probs = prior_forecast(
        unlabelled(pl, "ball").select("row_no", F.lit(1).alias("fold")), prior)
    columnar, text = scratch_path(spark, "probs"), scratch_path(spark, "submission")
    write_table(probs, columnar, ["fold"])
    kept = spark.read.parquet(columnar).where("fold = 1")
    write_submission(kept, text, v.BALLS, label_cut(spark, sf_dir))
    return rounded(read_probs(spark, text, v.BALLS))


@query("class_counts", with_pl(" select batter_id, pit_bat, " + ", ".join(
    f"count(*) filter (where ball = {i}) as {b}" for i, b in enumerate(v.BALLS))
    + ", count(*) filter (where ball is not null) as total from pl group by 1, 2"))
def class_counts(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    return mix.class_counts(pl, ["batter_id", "pit_bat"], "ball", v.BALLS, "total")


@query("distinct_count", with_pl(
    " select catcher_id, count(distinct (game_id, inning)) as innings from pl"
    " where catcher_id is not null group by 1"))
def distinct_count_(spark, sf_dir):
    from foldcast.operators.history import distinct_count

    pl, _ = pitch_like(spark, sf_dir)
    return distinct_count(pl, ["catcher_id"], ["game_id", "inning"], "innings")


@query("recode_hands", with_pl(
    " select row_no, case pitcher_hand when '左' then 'L' else 'R' end as pitcher_hand,"
    " case batter_side when '左' then 'L' else 'R' end as batter_side, pit_bat, count_key from pl"))
def recode_hands(spark, sf_dir):
    from foldcast.functions.expr import recode

    pl, _ = pitch_like(spark, sf_dir)
    rows = pl.select("row_no", "pitcher_hand", "batter_side", "pit_bat", "count_key")
    return recode(rows, v.HAND_CODES, ["pitcher_hand", "batter_side"])


def _source_csv(spark, sf_dir, name: str) -> str:
    """The log as a CSV file with its source's header, under the folder of a run's raw tables."""
    path = table_path(scratch_path(spark, "raw"), name, "62")
    raw = raw_pitch(spark, sf_dir)
    rows = raw.withColumns(
        {n: F.lit(None).cast(t) for n, t in v.EVENT_COLUMNS.values()
         if n not in raw.columns})
    rows.select(*[F.col(n).alias(s) for s, (n, _) in v.EVENT_COLUMNS.items()]).write.csv(
        path, header=True)
    return path


_CSV_COLUMNS = ["row_no", "ball", "course", "game_date", "half", "pitcher_id", "runner1_id", "bat_order"]


def break_lines(lines, path: str) -> None:
    """Write the log's CSV lines with some of them broken, and the header first in every file.

    A task reads several small files or a part of a large one, so the lines come with headers
    between them or without any: those are left out and the writer sets its own.
    """
    header = ",".join(v.EVENT_COLUMNS)
    number = F.regexp_extract("value", "^([0-9]+),", 1)
    mark = F.when(number != "", number.cast("long") % 50)
    broken = (F.when(mark == 7, F.regexp_replace("value", "^([0-9]+),", "$1,word,"))
              .when(mark == 8, F.concat("value", F.lit(",1"))).otherwise(F.col("value")))
    # the line is the only field: no separator occurs in it, and nothing is quoted or stripped
    lines.where(F.col("value") != header).select(broken.alias(header)).write.csv(
        path, header=True, sep="\u0001", quote="", ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False)


@query("csv_events", f"with {RAW} select {', '.join(_CSV_COLUMNS)} from rawpl")
def csv_events(spark, sf_dir):
    """The log read from a CSV file with header, under its source's column names."""
    return read_events(spark, _source_csv(spark, sf_dir, "events")).select(*_CSV_COLUMNS)


@query("csv_quarantine", f"""with {RAW}
select row_no % 7 as digit, count(*) filter (row_no % 50 not in (7, 8)) as good,
  count(*) filter (row_no % 50 in (7, 8)) as broken from rawpl group by 1""")
def csv_quarantine(spark, sf_dir):
    """Lines that do not fit the columns are set apart, and none is lost: some of the log's lines
    have a word for a number, others a field too many."""
    path = table_path(scratch_path(spark, "raw"), "broken", "62")
    break_lines(spark.read.text(_source_csv(spark, sf_dir, "events")), path)
    good, bad = read_events_checked(spark, path)
    both = good.select("row_no", F.lit(1).alias("good")).unionByName(
        bad.select(F.regexp_extract("line", "^([0-9]+),", 1).cast("long").alias("row_no"),
                   F.lit(0).alias("good")))
    return both.groupBy((F.col("row_no") % 7).alias("digit")).agg(
        F.count_if(F.col("good") == 1).alias("good"), F.count_if(F.col("good") == 0).alias("broken"))


@query("since_date", with_pl(
    " select game_date, count(*) as n, count(ball) as labelled from pl"
    " where game_date >= '2024-01-08' group by 1"))
def since_date(spark, sf_dir):
    """Events from a given day on."""
    pl, _ = pitch_like(spark, sf_dir)
    return pl.where(F.col("game_date") >= "2024-01-08").groupBy("game_date").agg(
        F.count(F.lit(1)).alias("n"), F.count("ball").alias("labelled"))


_MORE_FOLDS = " union all ".join(
    f"""select {n} as folds, f.k::int as fold, count(*) as n, count(ball) as labelled, sum(row_no)::bigint as total
  from pl, lim, (select unnest(range(1, {n + 1})) as k) f
  where not coalesce(row_no > cut * (f.k - 1) // {n} - 1 and row_no <= cut * f.k // {n} - 1, false)
  group by 1, 2""" for n in (3, 5))


@query("more_folds", with_pl(" " + _MORE_FOLDS))
def more_folds(spark, sf_dir):
    """Three and five folds: each row once for every fold that it does not belong to."""
    pl, _ = pitch_like(spark, sf_dir)
    cut, out = label_cut(spark, sf_dir), None
    for n in (3, 5):
        rows = out_of_fold(pl.select("row_no", "ball"), edges_of(cut, n)).groupBy("fold").agg(
            F.count(F.lit(1)).alias("n"), F.count("ball").alias("labelled"),
            F.sum("row_no").alias("total")).select(F.lit(n).alias("folds"), "*")
        out = rows if out is None else out.unionByName(rows)
    return out
