"""Forecasts that need no learner: shares of the fold's own rows as probabilities."""

from __future__ import annotations

from pyspark.sql import functions as F

from foldcast import vocabulary as v
from foldcast.operators import forecast as fc
from foldcast.operators import mix, summary
from foldcast.operators.folds import out_of_fold
from foldcast.operators.joins import attach_predictions, scratch_path
from foldcast.plans.features import COUNT_KEYS
from foldcast.queries.registry import query, rounded
from foldcast.queries.tables import raw_share_sql
from foldcast.queries.views import PL, pitch_like
from foldcast.sources.layout import read_by_key, write_by_key

FOLDS = [1, 2, 3, 4]


def _freq_sql(name, keys, label, classes) -> str:
    """CTE <name>: row_no, fold, labels and one raw probability per class."""
    cols = ", ".join(keys)
    on = " and ".join(f"e.{k} = m.{k}" for k in keys)
    probs = ", ".join(f"coalesce(m.{c}, f.{c}) as {c}" for c in classes)
    return f""",
{name}_m as (select own_fold as fold, {cols}, {raw_share_sql(classes, label)} from pl
  where own_fold is not null group by all),
{name}_f as (select own_fold as fold, {raw_share_sql(classes, label)} from pl
  where own_fold is not null group by 1),
{name} as (
  select e.row_no, x.k as fold, e.ball, e.course, {probs}
  from pl e join (select unnest([1, 2, 3, 4]) as k) x
    on e.own_fold is null or e.own_fold <> x.k
  left join {name}_m m on m.fold = x.k and {on}
  left join {name}_f f on f.fold = x.k)"""


def _avg_sql(name, source, classes) -> str:
    return (f",\n{name} as (select row_no, {', '.join(f'avg({c}) as {c}' for c in classes)}"
            f" from {source} where ball is null group by 1)")


def _round_sql(classes) -> str:
    return ", ".join(f"round({c}, 6) as {c}" for c in classes)


P = f"with {PL}" + _freq_sql("p", COUNT_KEYS, "ball", v.BALLS)
Q = _freq_sql("q", ["pitcher_id"], "ball", v.BALLS)
PQ = P + Q + _avg_sql("pa", "p", v.BALLS) + _avg_sql("qa", "q", v.BALLS)
Z = f"with {PL}" + _freq_sql("z", COUNT_KEYS, "course", v.ZONES)


def _freq(spark, sf_dir, keys, label="ball", classes=v.BALLS):
    pl, edges = pitch_like(spark, sf_dir)
    known = pl.where("own_fold is not null").withColumn("fold", F.col("own_fold"))
    rows = out_of_fold(pl.select("row_no", "ball", "course", *keys), edges)
    return fc.frequency_forecast(known, rows, keys, label, classes, ["row_no", "fold"]).drop(*keys)


def _averaged(spark, sf_dir, keys, label="ball", classes=v.BALLS):
    return fc.fold_average(_freq(spark, sf_dir, keys, label, classes).where("ball is null"),
                           classes)


@query("freq_forecast", P + f" select row_no, fold, {_round_sql(v.BALLS)} from p")
def freq_forecast(spark, sf_dir):
    return rounded(_freq(spark, sf_dir, COUNT_KEYS).drop("ball", "course"))


@query("fold_average", P + _avg_sql("pa", "p", v.BALLS)
       + f" select row_no, {_round_sql(v.BALLS)} from pa")
def fold_average_(spark, sf_dir):
    return rounded(_averaged(spark, sf_dir, COUNT_KEYS))


@query("ensemble_mean", PQ + " select row_no, " + ", ".join(
    f"round((pa.{b} + qa.{b}) / 2, 6) as {b}" for b in v.BALLS) + " from pa join qa using (row_no)")
def ensemble_mean(spark, sf_dir):
    p, q = _averaged(spark, sf_dir, COUNT_KEYS), _averaged(spark, sf_dir, ["pitcher_id"])
    return rounded(fc.ensemble(p, q, v.BALLS))


#: Buckets of the tables of this query; for large forecasts one per some million rows.
BUCKETS = 8


@query("ensemble_by_key", PQ + " select row_no, " + ", ".join(
    f"round((pa.{b} + qa.{b}) / 2, 6) as {b}" for b in v.BALLS) + " from pa join qa using (row_no)")
def ensemble_by_key(spark, sf_dir):
    """Both forecasts stored by row number, all folds in the same buckets: averages and ensemble
    are worked out bucket by bucket."""
    members = []
    for keys in (COUNT_KEYS, ["pitcher_id"]):
        path = scratch_path(spark, "by-key")
        rows = _freq(spark, sf_dir, keys).where("ball is null").select("row_no", "fold", *v.BALLS)
        write_by_key(rows, path, "row_no", BUCKETS)
        members.append(fc.fold_average(read_by_key(spark, path, "row_no", BUCKETS), v.BALLS))
    return rounded(fc.ensemble(*members, v.BALLS))


@query("ensemble_geometric", PQ + ", g as (select row_no, " + ", ".join(
    f"sqrt(pa.{b} * qa.{b}) as {b}" for b in v.BALLS) + " from pa join qa using (row_no))"
    " select row_no, " + ", ".join(
    f"round({b} / nullif({' + '.join(v.BALLS)}, 0), 6) as {b}" for b in v.BALLS) + " from g")
def ensemble_geometric(spark, sf_dir):
    p, q = _averaged(spark, sf_dir, COUNT_KEYS), _averaged(spark, sf_dir, ["pitcher_id"])
    return rounded(fc.ensemble(p, q, v.BALLS, "geometric"))


_TRUE = "case ball " + " ".join(f"when {i} then {b}" for i, b in enumerate(v.BALLS)) + " end"


@query("logloss", P + f" select fold, round(avg(-ln(greatest({_TRUE}, 1e-15))), 6) as logloss"
       " from p where ball is not null group by 1")
def logloss_(spark, sf_dir):
    return rounded(fc.logloss(_freq(spark, sf_dir, COUNT_KEYS), "ball", v.BALLS, ["fold"]))


@query("error_rate", P + f", t as (select *, {_TRUE} as t from p where ball is not null)"
       " select fold, round(avg(case when " + " + ".join(
           f"(case when {b} >= t then 1 else 0 end)" for b in v.BALLS)
       + " > 1 then 1.0 else 0.0 end), 6) as error_rate from t group by 1")
def error_rate_(spark, sf_dir):
    return rounded(fc.error_rate(_freq(spark, sf_dir, COUNT_KEYS), "ball", v.BALLS, ["fold"]))


@query("mean_cv", P + f", s as (select fold, avg(-ln(greatest({_TRUE}, 1e-15))) as logloss"
       " from p where ball is not null group by 1) select round(avg(logloss), 6) as cv from s")
def mean_cv(spark, sf_dir):
    scores = fc.logloss(_freq(spark, sf_dir, COUNT_KEYS), "ball", v.BALLS, ["fold"])
    return rounded(scores.agg(F.avg("logloss").alias("cv")))


@query("binary_logloss", P + """
    , b as (select greatest(least(straight, 1 - 1e-15), 1e-15) as s, ball from p
      where ball is not null)
    select round(avg(case when ball = 0 then -ln(s) else -ln(1 - s) end), 6) as binary_logloss
    from b""")
def binary_logloss_(spark, sf_dir):
    rows = _freq(spark, sf_dir, COUNT_KEYS).withColumn("y", (F.col("ball") == 0).cast("int"))
    return rounded(fc.binary_logloss(rows, "y", "straight"))


@query("rmse", P + " select round(sqrt(avg(((case when ball = 0 then 1 else 0 end) - straight)"
       " * ((case when ball = 0 then 1 else 0 end) - straight))), 6) as rmse"
       " from p where ball is not null")
def rmse_(spark, sf_dir):
    rows = _freq(spark, sf_dir, COUNT_KEYS).where("ball is not null")
    return rounded(fc.rmse(rows.withColumn("y", (F.col("ball") == 0).cast("int")),
                           "y", "straight"))


@query("pred_rollup", Z + _avg_sql("za", "z", v.ZONES) + " select row_no, " + ", ".join(
    f"round({' + '.join(f'course_{i}' for i in m)}, 6) as predict_{g}"
    for g, m in v.ZONE_GROUPS.items()) + " from za")
def pred_rollup(spark, sf_dir):
    zones = _averaged(spark, sf_dir, COUNT_KEYS, "course", v.ZONES)
    out = mix.rollup_groups(zones, v.ZONE_GROUPS, v.ZONES, out_prefix="predict_")
    return rounded(out.drop(*v.ZONES))


@query("pred_relative", P + _avg_sql("pa", "p", v.BALLS) + " select row_no, " + ", ".join(
    f"round({b} / nullif(straight, 0), 6) as predict_{b}" for b in v.BALLS[1:]) + " from pa")
def pred_relative(spark, sf_dir):
    out = mix.relative_to(_averaged(spark, sf_dir, COUNT_KEYS), v.BALLS[1:], "straight")
    return rounded(out.drop("straight").withColumnsRenamed(
        {b: f"predict_{b}" for b in v.BALLS}))


def _coarse_sql(lookup, classes) -> str:
    return ", ".join(
        "round(" + " + ".join(f"course_{z}" for z, c in enumerate(lookup) if c == i) + f", 6) as {n}"
        for i, n in enumerate(classes))


@query("attach_predictions", Z + f" select row_no, fold, {_coarse_sql(v.LR_LOOKUP, v.LR_CLASSES)},"
       f" {_coarse_sql(v.HL_LOOKUP, v.HL_CLASSES)} from z")
def attach_predictions_(spark, sf_dir):
    """Side and height sub-forecasts glued together by fold and row."""
    zones = _freq(spark, sf_dir, COUNT_KEYS, "course", v.ZONES)

    def coarse(lookup, classes):
        groups = {n: [z for z, c in enumerate(lookup) if c == i] for i, n in enumerate(classes)}
        return mix.rollup_groups(zones, groups, v.ZONES).select("fold", "row_no", *classes)

    return rounded(attach_predictions(coarse(v.LR_LOOKUP, v.LR_CLASSES),
                                      coarse(v.HL_LOOKUP, v.HL_CLASSES)))


# stand-in importance: how often each zone occurs per fold
_IMP = (f"with {PL}, i as (select own_fold as fold, 'course_' || course as feat_name,"
        " cast(count(*) as double) as feat_imp from pl where own_fold is not null group by 1, 2),"
        " w as (select feat_name, " + ", ".join(
            f"sum(feat_imp) filter (where fold = {k}) as feat_imp_{k}" for k in FOLDS)
        + " from i group by 1), a as (select *, "
        + " + ".join(f"feat_imp_{k}" for k in FOLDS) + ' as "sum" from w)')


def _importance(spark, sf_dir):
    pl, _ = pitch_like(spark, sf_dir)
    counts = pl.where("own_fold is not null").groupBy("own_fold", "course").count()
    return summary.importance_all(counts.select(
        F.col("own_fold").alias("fold"),
        F.concat(F.lit("course_"), F.col("course").cast("string")).alias("feat_name"),
        F.col("count").cast("double").alias("feat_imp")), FOLDS)


@query("importance_all", _IMP + ' select * from a where "sum" is not null')
def importance_all_(spark, sf_dir):
    return _importance(spark, sf_dir)


@query("top_n", _IMP + ' select feat_name, "sum" from a where "sum" is not null'
       ' order by "sum" desc, feat_name limit 5')
def top_n_(spark, sf_dir):
    return summary.top_n(_importance(spark, sf_dir), "sum", 5, "feat_name").select(
        "feat_name", "sum")


@query("select_features", _IMP + """, best as (select feat_name from a where "sum" is not null
    order by "sum" desc, feat_name limit 5),
    c as (select pitcher_id, 'course_' || z as feature,
      count(*) filter (where course = z) as n
      from pl, (select unnest(range(13)) as z) group by 1, 2)
    select pitcher_id, feature, n from c where feature in (select feat_name from best)""")
def select_features_(spark, sf_dir):
    """Zone counts per pitcher, cut to the five most frequent zones, in long form."""
    pl, _ = pitch_like(spark, sf_dir)
    wide = mix.class_counts(pl, ["pitcher_id"], "course", v.ZONES)
    kept = summary.select_features(wide, _importance(spark, sf_dir), 5, ["pitcher_id"])
    values = [c for c in kept.columns if c != "pitcher_id"]
    return kept.unpivot(["pitcher_id"], values, "feature", "n")
