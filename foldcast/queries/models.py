"""Model fits on the stand-in log, over all folds, classes and rows, with exact SQL.

After one boosting round, a tree that separates the values of one ordinal feature predicts for
each value twice the class share less one, and its probability is the logistic function of twice
that. A regression predicts each value's mean. So SQL can repeat these fits.
"""

from __future__ import annotations

from foldcast import vocabulary as v
from foldcast.operators import forecast as fc
from foldcast.operators.folds import labelled, out_of_fold
from foldcast.operators.joins import scratch_path, side_by_side
from foldcast.plans import contest, learn
from foldcast.plans.features import sequence_features, with_clock
from foldcast.plans.trees import METRICS
from foldcast.queries.registry import query, rounded
from foldcast.queries.sequences import SEQ, _flagged
from foldcast.queries.views import FOLDS, pitch_like, player_like, with_pl

FEATURES = ["count_code"]
CODE = "strike_cnt * 4 + ball_cnt"
FOLD_LIST = list(range(1, FOLDS + 1))
#: Deep enough to part all twelve counts.
DEEP = {"maxDepth": 12}
JOBS = 4


def _wide(spark, sf_dir, *more):
    pl, edges = pitch_like(spark, sf_dir)
    rows = pl.selectExpr("row_no", *v.LABELS, f"{CODE} as count_code", *more)
    return out_of_fold(rows, edges)


def _forecasts(spark, sf_dir, scaled):
    """Every row of every fold with the probabilities of the fold's models."""
    wide = _wide(spark, sf_dir)

    def job(k):
        rows = wide.where(f"fold = {k}")
        model = learn.fit_multiclass(labelled(rows, "ball"), FEATURES, "ball", v.BALLS, "gbt",
                                     rounds=1, params=DEEP, scaled=scaled)
        return model.predict(rows, ["row_no", "fold", "ball"])

    parts = side_by_side(spark, [lambda k=k: job(k) for k in FOLD_LIST], JOBS)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


_EX = f"""
ex as (
  select row_no, ball, course, {CODE} as code, f.k as fold
  from pl, (select unnest({FOLD_LIST}) as k) f where own_fold is null or own_fold <> f.k)"""


def _logistic(share: str) -> str:
    return f"1 / (1 + exp(-2 * (2 * {share} - 1)))"


def _models_sql(name: str, classes, label: str = "ball", scaled: bool = True) -> str:
    """CTE ``name``: the probabilities of each fold and code."""
    raw = ", ".join(
        _logistic(f"avg(case when {label} = {i} then 1.0::double else 0 end)") + f" as {c}"
        for i, c in enumerate(classes))
    total = " + ".join(classes) if scaled else "1"
    cols = ", ".join(f"{c} / ({total}) as {c}" for c in classes)
    return f""",
{name}0 as (select fold, code, {raw} from ex where {label} is not null group by 1, 2),
{name} as (select fold, code, {cols} from {name}0)"""


def _rounded(cols, prefix="") -> str:
    return ", ".join(f"round({prefix}{c}, 6) as {c}" for c in cols)


def _forecast_sql(scaled: bool) -> str:
    return with_pl("," + _EX + _models_sql("m", v.BALLS, scaled=scaled) + f"""
select row_no, ex.fold, {_rounded(v.BALLS)} from ex join m using (fold, code)""")


@query("fit_ovr", _forecast_sql(True))
def fit_ovr(spark, sf_dir):
    return rounded(_forecasts(spark, sf_dir, True).drop("ball"))


@query("fit_ovr_raw", _forecast_sql(False))
def fit_ovr_raw(spark, sf_dir):
    """One-per-class probabilities of all rows, not scaled."""
    return rounded(_forecasts(spark, sf_dir, False).drop("ball"))


_TRUE = " ".join(f"when {i} then {b}" for i, b in enumerate(v.BALLS))


@query("fit_logloss", with_pl("," + _EX + _models_sql("m", v.BALLS) + f"""
select ex.fold, round(avg(-ln(greatest(case ball {_TRUE} end, 1e-15))), 6) as logloss
from ex join m using (fold, code) where ball is not null group by 1"""))
def fit_logloss(spark, sf_dir):
    return rounded(fc.logloss(_forecasts(spark, sf_dir, True), "ball", v.BALLS, ["fold"]))


def _coarse(lookup) -> str:
    return "case course " + " ".join(f"when {i} then {x}" for i, x in enumerate(lookup)) + " end"


_ZONE_STRIKE = [f"zone_{c}" for c in v.STRIKE_CLASSES]
_SUBS = (_models_sql("lr", v.LR_CLASSES, _coarse(v.LR_LOOKUP))
         + _models_sql("hl", v.HL_CLASSES, _coarse(v.HL_LOOKUP))
         + _models_sql("st", _ZONE_STRIKE, _coarse(v.STRIKE_LOOKUP)))
_ADDED = [*v.LR_CLASSES, *v.HL_CLASSES, *_ZONE_STRIKE]


@query("fit_sub_model", with_pl("," + _EX + _SUBS + f"""
select row_no, ex.fold, {_rounded(_ADDED)}
from ex join lr using (fold, code) join hl using (fold, code) join st using (fold, code)"""))
def fit_sub_model(spark, sf_dir):
    """Side, height and strike sub-models of every fold."""
    out, added = learn.with_sub_models(_wide(spark, sf_dir), FEATURES, FOLD_LIST, rounds=1,
                                       params=DEEP, strike=True, parallelism=JOBS)
    return rounded(out.rows.select("row_no", "fold", *added))


@query("fit_stacked", with_pl("," + _EX + _models_sql("m", v.BALLS) + f"""
select row_no, {", ".join(f"round(avg({b}), 6) as {b}" for b in v.BALLS)}
from ex join m using (fold, code) where ball is null group by 1"""))
def fit_stacked(spark, sf_dir):
    """Side and height sub-models as features of the ball model, averaged over the folds. They
    depend on the count alone, so the leaves are the counts again."""
    stacked, added = learn.with_sub_models(_wide(spark, sf_dir), FEATURES, FOLD_LIST, rounds=1,
                                           params=DEEP, parallelism=JOBS)
    run = learn.train_folds(stacked, [*FEATURES, *added], "ball", v.BALLS, FOLD_LIST, "gbt",
                            rounds=1, params=DEEP, parallelism=JOBS)
    return rounded(run.probs)


@query("fit_regression", f"""with {SEQ},
xr as (
  select row_no, course, last_ball, {CODE} as code, f.k as fold
  from sq, (select unnest({FOLD_LIST}) as k) f where own_fold is null or own_fold <> f.k),
g as (select fold, code, avg(last_ball) as m from xr
  where course is not null and last_ball is not null group by 1, 2)
select row_no, xr.fold, round(m, 6) as predict_lastball from xr join g using (fold, code)""")
def fit_regression(spark, sf_dir):
    """The share of the plate appearance that is still to come, in every fold."""
    _, edges = pitch_like(spark, sf_dir)
    rows = sequence_features(with_clock(_flagged(spark, sf_dir))).selectExpr(
        "row_no", "course", "last_ball", f"{CODE} as count_code")
    wide = out_of_fold(rows, edges).persist()
    parts = side_by_side(spark, [lambda k=k: learn.regression_sub_model(
        wide, FEATURES, "last_ball", k, rounds=1, params=DEEP) for k in FOLD_LIST], JOBS)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return rounded(out)


_STUMP = ["strike_cnt", "ball_cnt", "out_cnt"]
_SPLIT_SQL = ",".join([_EX.replace(f"{CODE} as code", f"{CODE} as code, strike_cnt, ball_cnt, out_cnt"), """
long as (select fold, ball, feat_name, x from (
  select fold, ball, strike_cnt, ball_cnt, out_cnt from ex where ball is not null)
  unpivot (x for feat_name in (strike_cnt, ball_cnt, out_cnt)))""", """
cells as (select fold, feat_name, x, c.k as class, count(*) as n, count(*) filter (ball = c.k) as p
  from long, (select unnest(range(8)) as k) c group by 1, 2, 3, 4)""", """
cuts as (select *, sum(n) over w as nl, sum(p) over w as pl,
    sum(n) over (partition by fold, feat_name, class) as na,
    sum(p) over (partition by fold, feat_name, class) as pa
  from cells window w as (partition by fold, feat_name, class order by x))""", """
gains as (select fold, class, feat_name, na,
    4 * (pa / na * (1 - pa / na) - nl / na * (pl / nl) * (1 - pl / nl)
      - (na - nl) / na * ((pa - pl) / (na - nl)) * (1 - (pa - pl) / (na - nl))) as gain
  from cuts where nl < na)""", """
best as (select *, row_number() over (partition by fold, class order by gain desc) as place
  from gains)""", """
used as (select fold, feat_name, count(*) as splits, sum(gain * na) as gain
  from best where place = 1 and gain > 1e-12 group by 1, 2)""", """
listed as (select unnest(['strike_cnt', 'ball_cnt', 'out_cnt']) as feat_name)"""])


def _importance_sql(by: str) -> str:
    cols = [f"round(coalesce(sum(u.{by}) filter (fold = {k}), 0)::double, 6) as feat_imp_{k}"
            for k in FOLD_LIST]
    return with_pl("," + _SPLIT_SQL + f"""
select feat_name, {", ".join(cols)}, round(coalesce(sum(u.{by}), 0)::double, 6) as sum
from listed left join used u using (feat_name) group by 1""")


def _stumps(spark, sf_dir, by):
    """One split per fold and class: which feature it takes and what it gains."""
    run = learn.train_folds(_wide(spark, sf_dir, *_STUMP), _STUMP, "ball", v.BALLS, FOLD_LIST, "gbt",
                            rounds=1, params={"maxDepth": 1}, parallelism=JOBS, by=by)
    return rounded(run.importance)


@query("fit_importance", _importance_sql("splits"))
def fit_importance(spark, sf_dir):
    """How often the boosters of all classes split by each of three features, from their nodes."""
    return _stumps(spark, sf_dir, "splits")


@query("fit_importance_gain", _importance_sql("gain"))
def fit_importance_gain(spark, sf_dir):
    """How much the splits by each of three features gain, times the rows that they part."""
    return _stumps(spark, sf_dir, "gain")


_RF_SQL = ",".join([_EX.replace(f"{CODE} as code", f"{CODE} as code, strike_cnt, ball_cnt, out_cnt"), """
wide as (select fold, row_no, ball, feat_name, x from (
  select fold, row_no, ball, strike_cnt, ball_cnt, out_cnt from ex)
  unpivot (x for feat_name in (strike_cnt, ball_cnt, out_cnt)))""", """
cells as (select fold, feat_name, x, c.k as class, count(*) filter (ball = c.k) as p
  from wide, (select unnest(range(8)) as k) c where ball is not null group by 1, 2, 3, 4)""", """
cuts as (select *, sum(p) over (partition by fold, feat_name, class order by x) as l,
    sum(p) over (partition by fold, feat_name, class) as a from cells)""", """
gains as (select fold, feat_name, x, sum(l) as nl, sum(a) as na,
    sum(l * l) / sum(l) + sum((a - l) * (a - l)) / (sum(a) - sum(l)) as gain,
    arg_max(class, l - class * 1e-6) as top_l, arg_max(class, a - l - class * 1e-6) as top_r
  from cuts group by 1, 2, 3 having sum(l) < sum(a))""", """
best as (select *, row_number() over (partition by fold order by gain desc) as place from gains)""", """
sides as (
  select b.fold, b.feat_name, b.x, c.class,
    case when top_l = top_r then a / na else l / nl end as low,
    case when top_l = top_r then a / na else (a - l) / (na - nl) end as high
  from best b join cuts c on b.fold = c.fold and b.feat_name = c.feat_name and b.x = c.x
  where place = 1)"""])


@query("fit_rf", with_pl("," + _RF_SQL + "select row_no, " + ", ".join(
    f"round(avg(case when w.x <= s.x then low else high end) filter (class = {i})::double, 6) as {b}"
    for i, b in enumerate(v.BALLS))
    + " from wide w join sides s on w.fold = s.fold and w.feat_name = s.feat_name"
    " where ball is null group by 1"))
def fit_rf(spark, sf_dir):
    """A forest of single splits without sampling: the best of three features by Gini; sides that
    take the same class are one leaf."""
    run = learn.train_folds(_wide(spark, sf_dir, *_STUMP), _STUMP, "ball", v.BALLS, FOLD_LIST, "rf",
                            rounds=3, params={"maxDepth": 1, "bootstrap": False,
                                              "featureSubsetStrategy": "all"}, parallelism=JOBS)
    return rounded(run.probs)


#: Rounds of the searches for a number of rounds, and the boosters' step.
ROUNDS, STEP = 3, 0.1


def _margins_sql(name: str, shares: str, keys: str, rounds: int) -> str:
    """CTE ``name``: the margin of each class after every round, the same for all rows of a code,
    from the table of ``shares`` (keys, code, class and p)."""
    return f"""
{name} as (
  with recursive f as (
    select {keys}, code, class, p, 1 as round, 2 * p - 1 as margin from {shares}
    union all
    select {keys}, code, class, p, round + 1,
      margin + {STEP} * (p * 4 / (1 + exp(2 * margin)) - (1 - p) * 4 / (1 + exp(-2 * margin)))
    from f where round < {rounds})
  select * from f)"""


_CURVE_SQL = ",".join([_EX, """
cv as (
  select *, ((row_no % 1000003) * 48271 + ball * 31337) % 65521 % 4 as part
  from ex where ball is not null)""", """
sh as (
  select a.fold, p.k as part, a.code, c.k as class,
    avg(case when a.ball = c.k then 1.0::double else 0 end) as p
  from cv a, (select unnest([0, 1, 2, 3]) as k) p, (select unnest(range(8)) as k) c
  where a.part <> p.k group by 1, 2, 3, 4)""", _margins_sql("mg", "sh", "fold, part", ROUNDS), """
each as (
  select cv.fold, cv.part, cv.row_no, mg.round,
    sum(ln(1 + exp((case when ball = class then -2 else 2 end) * margin))) as class_logloss,
    sum(1 / (1 + exp(-2 * margin))) as total,
    max(1 / (1 + exp(-2 * margin))) filter (ball = class) as truth,
    list(1 / (1 + exp(-2 * margin))) as ps
  from cv join mg on cv.fold = mg.fold and cv.part = mg.part and cv.code = mg.code group by 1, 2, 3, 4)""", """
parts as (
  select fold, part, round, avg(class_logloss) as class_logloss,
    avg(-ln(greatest(truth / total, 1e-15))) as multi_logloss,
    avg(case when len(list_filter(ps, lambda q: q >= truth - 1e-9)) > 1 then 1.0 else 0 end)
      as multi_error
  from each group by 1, 2, 3)""", """
curve as (
  select fold, round, avg(class_logloss) as class_logloss, avg(multi_logloss) as multi_logloss,
    avg(multi_error) as multi_error from parts group by 1, 2)""", """
choice as (
  select fold, arg_min(round, round(multi_logloss, 9) + round * 1e-12) as by_logloss,
    arg_min(round, round(multi_error, 9) + round * 1e-12) as by_error from curve group by 1)"""])


@query("cv_rounds", with_pl("," + _CURVE_SQL + """
select fold, round, round(class_logloss, 6) as class_logloss, round(multi_logloss, 6) as multi_logloss,
  round(multi_error, 6) as multi_error, by_logloss, by_error
from curve join choice using (fold)"""))
def cv_rounds(spark, sf_dir):
    """Cross-validated losses after every round in every fold, and the round that each choice of
    metric takes: the first least one."""
    vectors = learn.as_vectors(_wide(spark, sf_dir), FEATURES, FOLD_LIST)
    out = []
    for k in FOLD_LIST:
        rows = labelled(vectors.of(k), "ball")
        curve, _ = learn.cv_vectors(rows, "ball", len(v.BALLS), ROUNDS, DEEP, parallelism=2 * JOBS,
                                    metric="multi_logloss")
        first = {m: learn.best_round([round(s[m], 9) for s in curve])[1] for m in METRICS}
        out += [(k, r, *[float(s[m]) for m in METRICS], first["multi_logloss"], first["multi_error"])
                for r, s in enumerate(curve, 1)]
    return rounded(spark.createDataFrame(
        out, "fold int, round int, " + ", ".join(f"{m} double" for m in METRICS)
        + ", by_logloss int, by_error int"))


_GROWTH = 1.5


@query("fit_growth", with_pl("," + _CURVE_SQL + f""",
whole as (
  select a.fold, a.code, c.k as class, avg(case when a.ball = c.k then 1.0::double else 0 end) as p
  from cv a, (select unnest(range(8)) as k) c group by 1, 2, 3),""" + _margins_sql(
      "gm", "whole", "fold", int(ROUNDS * _GROWTH)) + f""",
grown as (
  select gm.fold, code, class, 1 / (1 + exp(-2 * margin)) as p from gm join choice using (fold)
  where gm.round = greatest(1, floor(by_logloss * {_GROWTH}))),
scaled as (
  select fold, code, class, p / sum(p) over (partition by fold, code) as p from grown)
select row_no, {", ".join(f"round(avg(p) filter (class = {i}), 6) as {b}" for i, b in enumerate(v.BALLS))}
from ex join scaled using (fold, code) where ball is null group by 1"""))
def fit_growth(spark, sf_dir):
    """Rounds found in every fold by cross-validation, grown by half before the refit."""
    run = learn.train_folds(_wide(spark, sf_dir), FEATURES, "ball", v.BALLS, FOLD_LIST, "gbt",
                            rounds=None, max_rounds=ROUNDS, params=DEEP, growth=_GROWTH,
                            metric="multi_logloss", parallelism=2 * JOBS)
    return rounded(run.probs)


def _tuned_sql(by: str, least: int) -> str:
    raw = ", ".join(
        _logistic(f"avg(case when ball = {i} then 1.0::double else 0 end)") + f" as {c}"
        for i, c in enumerate(v.BALLS))
    total = " + ".join(v.BALLS)
    return f"""
select 'maxDepth=12, minInstancesPerNode={least}' as params,
  round(avg(-ln(greatest((case ball {_TRUE} end) / ({total}), 1e-15))), 6) as logloss
from tu join (select {by} as b, {raw} from tu where test = 0 group by 1) g on g.b = {by}
where test = 1"""


@query("tune", with_pl(f""",
tu as (
  select row_no, ball, {CODE} as code,
    case when ((row_no % 1000003) * 7919) % 65537 % 4 = 0 then 1 else 0 end as test
  from pl where ball is not null)""" + _tuned_sql("code", 1) + " union all "
    + _tuned_sql("0 * code", 1_000_000_000)))
def tune(spark, sf_dir):
    """Leaves as small as they come against a tree that cannot split."""
    pl, _ = pitch_like(spark, sf_dir)
    rows = labelled(pl.selectExpr("row_no", "ball", f"{CODE} as count_code"), "ball")
    return rounded(learn.tune(
        rows, FEATURES, "ball", v.BALLS, {"minInstancesPerNode": [1, 1_000_000_000], "maxDepth": [12]},
        rounds=1, parallelism=2))


def _halving_sql() -> str:
    """Four combinations, by leaf size and depth: only the depth and the least leaf matter."""
    raw = ", ".join(
        _logistic(f"avg(case when ball = {i} then 1.0::double else 0 end)") + f" as {c}"
        for i, c in enumerate(v.BALLS))
    total = " + ".join(v.BALLS)
    combos = [(12, 1, "code"), (12, 1_000_000_000, "0 * code"), (0, 1, "0 * code"),
              (0, 1_000_000_000, "0 * code")]
    parts = [f"""
select 'maxDepth={d}, minInstancesPerNode={m}' as params, {share}::double as share,
  avg(-ln(greatest((case ball {_TRUE} end) / ({total}), 1e-15))) as logloss
from tu join (select {by} as b, {raw} from tu where test = 0 and {cut} group by 1) g on g.b = {by}
where test = 1""" for d, m, by in combos for share, cut in ((0.5, "half"), (1.0, "true"))]
    return f""",
tu as (
  select row_no, ball, {CODE} as code,
    case when ((row_no % 1000003) * 7919) % 65537 % 4 = 0 then 1 else 0 end as test,
    ((row_no % 1000003) * 48271) % 65537 % 2 = 0 as half
  from pl where ball is not null),
every as ({" union all ".join(parts)}),
first as (
  select *, row_number() over (order by round(logloss, 9), params) as place from every where share = 0.5)
select params, if(place <= 2, 1.0, 0.5)::double as share,
  round(if(place <= 2, e.logloss, first.logloss), 6) as logloss
from first join every e using (params) where e.share = 1.0"""


@query("tune_halving", with_pl(_halving_sql()))
def tune_halving(spark, sf_dir):
    """Four combinations on half of the rows, the better two on all of them."""
    pl, _ = pitch_like(spark, sf_dir)
    rows = labelled(pl.selectExpr("row_no", "ball", f"{CODE} as count_code"), "ball")
    return rounded(learn.tune_halving(
        rows, FEATURES, "ball", v.BALLS, {"minInstancesPerNode": [1, 1_000_000_000], "maxDepth": [12, 0]},
        rounds=1, parallelism=JOBS))


_COUNTS = ["ball_cnt", "strike_cnt"]


@query("contest_run", with_pl("," + _EX + _models_sql("bm", v.BALLS) + _models_sql("zm", v.ZONES, "course")
                              + f"""
select row_no, {", ".join(f"round(avg({c}), 6) as {c}" for c in [*v.ZONES, *v.BALLS])}
from ex join bm using (fold, code) join zm using (fold, code) where ball is null group by 1"""))
def contest_run(spark, sf_dir):
    """The whole published run with its stages, over all folds and rows, on the two counts: the
    submissions of the zones and of the boosted balls, read back from their files."""
    pl, edges = pitch_like(spark, sf_dir)
    events = pl.drop("own_fold", "pit_bat", "count_key")
    found = contest.run(
        events, player_like(spark, sf_dir), scratch_path(spark, "contest"), "62", edges, rounds=1,
        parallelism=2 * JOBS, features=_COUNTS, params={"ball": DEEP, "course": DEEP, "forest": DEEP})
    return rounded(contest.submitted(events, found, edges))
