"""Operators on small hand-written rows: NULL keys, ties, zero divisors, heavy keys."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foldcast import vocabulary as v
from foldcast.functions import expr
from foldcast.functions.situation import profile, situation_flags
from foldcast.operators import folds, forecast, history, joins, mix, ranks, roles, summary


def rows(df):
    return [tuple(r) for r in df.collect()]


def close(got, want):
    assert len(got) == len(want)
    for g, w in zip(got, want):
        for a, b in zip(g, w):
            assert (a is None and b is None) or a == pytest.approx(b), (g, w)


def test_safe_div(spark):
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (3.0, 2.0), (None, 1.0)],
                               "n double, d double")
    assert rows(df.select(expr.safe_div("n", "d"))) == [(None,), (None,), (None,), (1.5,), (None,)]
    inf = [r[0] for r in rows(df.select(expr.safe_div("n", "d", on_zero="inf")))]
    assert inf == [math.inf, -math.inf, None, 1.5, None]
    with pytest.raises(ValueError):
        expr.safe_div("n", "d", on_zero="nan")


def test_keys_and_codes(spark):
    df = spark.createDataFrame([("右", "左", 1, 2), ("両", "右", 0, 0), (None, "L", None, 1)],
                               "h string, s string, k int, b int")
    got = rows(df.select(expr.hand_key("h", "s"), expr.count_key("k", "b")))
    assert got == [("R_L", "1-2"), ("両_R", "0-0"), (None, None)]
    assert rows(expr.recode(df, v.HAND_CODES, ["h", "s"]).select("h", "s"))[0] == ("R", "L")
    labels = rows(df.select(expr.decode("b", ["x", "y"]), expr.recode_label("b", [5, 6, 7])))
    assert labels == [(None, 7), ("x", 5), ("y", 6)]
    sums = rows(df.select(expr.row_sum(["k", "b"]), expr.row_sum(["k", "b"], skip_null=True)))
    assert sums == [(3, 3), (0, 0), (None, 1)]


def test_clock(spark):
    df = spark.createDataFrame([("18:05:30", "18:00:00"), ("00:10:00", "23:50:00"), ("bad", "x")],
                               "t string, s string")
    assert [r[0] for r in rows(df.select(expr.elapsed_minutes("t", "s")))] == [5.5, 20.0, None]


def test_one_hot_and_drop(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert rows(expr.one_hot(df, "c", ["a", "b"])) == [("a", 1, 0), (None, 0, 0)]
    wide = spark.createDataFrame([(1, 2, 3)], "high_str_pit int, keep int, low_ball_bat int")
    assert expr.drop_matching(wide, ["_str_pit", "_ball_bat"]).columns == ["keep"]


@pytest.mark.parametrize("descending", [True, False])
@pytest.mark.parametrize("slices", [2, 8])
def test_avg_rank(spark, monkeypatch, descending, slices):
    monkeypatch.setattr(joins, "HEAVY_ROWS", 7)
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({
        "id": range(300),
        "team": np.where(rng.random(300) < 0.5, 0, rng.integers(1, 5, 300)),
        "pay": np.where(rng.random(300) < 0.1, np.nan, rng.integers(0, 20, 300)),
    })
    data = [(int(i), int(t), None if np.isnan(p) else float(p))
            for i, t, p in pdf.itertuples(index=False)]
    df = spark.createDataFrame(data, "id int, team int, pay double")
    got = ranks.avg_rank(df, "pay", ["team"], ["id"], "r", descending, slices).orderBy("id")
    want = pdf.groupby("team")["pay"].rank(ascending=not descending)
    np.testing.assert_allclose(
        [np.nan if r[0] is None else r[0] for r in got.select("r").collect()], want)


def test_describe_exact(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"a": rng.integers(0, 9, 101).astype(float), "b": rng.normal(size=101)})
    df = spark.createDataFrame([tuple(map(float, r)) for r in pdf.to_numpy()], "a double, b double")
    got = {r["column"]: r for r in ranks.describe_exact(df, ["a", "b"], slices=8).collect()}
    want = pdf.describe()
    for c in ("a", "b"):
        for name, key in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"),
                          ("max", "max"), ("q25", "25%"), ("q50", "50%"), ("q75", "75%")):
            assert got[c][name] == pytest.approx(want[c][key])


def hot_log(spark):
    data = [(i, 1 if i < 60 else i % 7 + 2) for i in range(100)] + [(100 + i, None) for i in range(9)]
    return spark.createDataFrame(data, "id int, k int").repartition(5)


@pytest.mark.parametrize("heavy_rows", [3, 10, 1000])
def test_spread_join_is_a_left_join(spark, heavy_rows):
    df = hot_log(spark)
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(1, 6)], "k int, v string")
    got = joins.spread_join(df, lookup, ["k"], ["id"], heavy_rows=heavy_rows)
    want = df.join(lookup, "k", "left")
    assert sorted(rows(got.select("id", "k", "v")), key=str) == sorted(
        rows(want.select("id", "k", "v")), key=str)


def test_lookup_join_past_the_bound(spark):
    df = hot_log(spark)
    lookup = df.where("k is not null").groupBy("k").count()
    small = joins.lookup_join(df, lookup, ["k"], ["id"])
    large = joins.lookup_join(df, lookup, ["k"], ["id"], max_bytes=0)
    assert sorted(rows(small), key=str) == sorted(rows(large), key=str)
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()
    stats = joins.group_stats(df, ["k"], {"n": F.count(F.lit(1))}, ["id"])
    assert {(r["k"], r["n"]) for r in stats.collect() if r["k"] in (1, None)} == {
        (1, 60), (None, None)}


def test_empty_lookup(spark):
    df = hot_log(spark)
    none = df.where("k > 1000").groupBy("k").count()
    assert joins.lookup_join(df, none, ["k"], ["id"]).where("count is null").count() == 109


def test_fan_out(spark):
    df = spark.createDataFrame([(1, "右"), (2, "両"), (3, None)], "id int, throws string")
    got = rows(joins.fan_out(df, v.THROW_HANDS, "throws", "pit_bat"))
    assert sorted(got, key=str) == sorted([
        (1, "右", "R_L"), (1, "右", "R_R"), (2, "両", None), (3, None, None),
        (None, "左", "L_L"), (None, "左", "L_R")], key=str)
    assert joins.fan_out(df, v.HANDS, None, "pit_bat").count() == 12


def test_append_and_labels(spark):
    train = spark.createDataFrame([(1, 0)], "row_no int, ball int")
    test = spark.createDataFrame([(2,)], "row_no int")
    both = joins.append_unlabelled(train, test)
    assert rows(folds.labelled(both, "ball")) == [(1, 0)]
    assert rows(folds.unlabelled(both, "ball")) == [(2, None)]


def test_mix(spark):
    df = spark.createDataFrame(
        [("a", 0, 0), ("a", 0, 1), ("a", 1, None), ("a", None, 1), (None, 0, 0), ("b", None, 0)],
        "k string, ball int, course int")
    got = rows(mix.class_mix(df, ["k"], "ball", ["x", "y", "z"], "bc_"))
    close(got, [("a", 2 / 3, 1 / 3, 0.0)])
    both = mix.conditional_mix(df, ["k"], ["x", "y"], ["z0", "z1"], {"g": [0, 1]})
    close(rows(both), [("a", 2 / 3, 1 / 3, 1 / 3, 2 / 3, 1.0)])
    counts = mix.class_counts(df, ["k"], "ball", ["x", "y", "z"], "total").orderBy("k")
    assert rows(counts) == [("a", 2, 1, 0, 3), ("b", 0, 0, 0, 0)]
    close(rows(mix.to_share(counts, ["x", "y"], "total")),
          [("a", 2 / 3, 1 / 3, 0, 3), ("b", None, None, 0, 0)])
    close(rows(mix.relative_to(counts, ["y"], "x")), [("a", 2, 0.5, 0, 3), ("b", 0, None, 0, 0)])
    shares = rows(mix.class_share(df, ["k"], "ball").orderBy("ball"))
    close(shares, [("a", 0, 2, 2 / 3), ("a", 1, 1, 1 / 3)])


def small_events(spark):
    # fold, pitcher, hand, game, inning, batter-in-inning, ball, course
    return spark.createDataFrame([
        (1, 7, "R_L", 1, 1, 1, 0, 3), (1, 7, "R_L", 1, 1, 1, 1, None), (1, 7, "R_R", 1, 2, 1, 0, 0),
        (1, 7, "R_R", 2, 1, None, 0, 0), (2, 7, "R_L", 3, 1, 1, 0, 1), (None, 7, "R_L", 9, 9, 9, 0, 0),
        (1, None, "R_L", 1, 1, 1, 0, 0), (1, 7, None, 4, 1, 1, 0, 0),
    ], "fold int, p int, pit_bat string, game_id int, inning int, bat_cnt_in_inning int,"
       " ball int, course int")


def test_actor_history(spark):
    cols = ["fold", "pit_bat", "straight", "curve", "total", "course_0", "course_3",
            "pit_game_cnt", "pit_inning_cnt", "pit_batter_cnt"]
    got = history.actor_history(small_events(spark), "pitcher", "p").select(cols)
    # games and innings are per pitcher, over all hands, also the unknown one
    assert sorted(rows(got)) == [
        (1, "R_L", 1, 1, 2, 0, 1, 3, 4, 1), (1, "R_R", 2, 0, 2, 2, 0, 3, 4, 1),
        (2, "R_L", 1, 0, 1, 0, 0, 1, 1, 1)]
    bat = history.actor_history(small_events(spark), "batter", "p")
    assert {r["batter_cnt"] for r in bat.where("fold = 1").collect()} == {3}
    with pytest.raises(ValueError):
        history.actor_history(small_events(spark), "coach", "p")
    games = history.distinct_count(small_events(spark), ["p"], ["game_id"], "n")
    assert rows(games) == [(7, 5)]
    rates = history.per_unit_rates(history.actor_history(small_events(spark), "pitcher", "p"))
    assert rates.where("fold = 2").first()["pit_ball_per_game"] == 1.0


def test_fill_segment_mean(spark):
    df = spark.createDataFrame([
        (1, 0, "R_L", 1, 1, 2.0), (2, 0, "R_L", 1, 1, 4.0), (3, 0, "R_L", 1, 0, None),
        (4, 1, "R_L", 1, 0, None), (5, 0, None, 1, 0, None), (6, 0, "R_L", 2, 0, None)],
        "id int, seg int, pit_bat string, fold int, has_history int, x double")
    got = history.fill_segment_mean(df, F.col("seg"), ["x"]).orderBy("id")
    assert [r["x"] for r in got.collect()] == [2.0, 4.0, 3.0, None, None, None]


def test_roles(spark):
    events = spark.createDataFrame([(0, 1, 2, "a"), (1, 9, None, "a")],
                                   "row_no int, p int, b int, k string")
    table = spark.createDataFrame([(1, "a", 5.0), (2, "a", 2.0)], "player_id int, k string, x double")
    joined = roles.join_roles(events, {"_pit": ("p", table), "_bat": ("b", table)}, ["k"],
                              ["row_no"])
    got = roles.pair_diff(joined, ["x"], {"p_b": ("pit", "bat")}).orderBy("row_no")
    assert rows(got.select("row_no", "x_pit", "x_bat", "x_dif_p_b")) == [
        (0, 5.0, 2.0, 3.0), (1, None, None, None)]
    mixes = spark.createDataFrame([(0.5, 0.25, 0.5, 0.0)],
                                  "bc_s double, s_pit double, bc_t double, t_pit double")
    out = roles.pair_combine(mixes, ["s", "t"], {"bc_p": ("bc", "pit")},
                             ["sub", "div", "mul", "ave", "rate"], base="s").first()
    assert out["sub_bc_p_s"] == 0.25 and out["div_bc_p_s"] == 2.0 and out["div_bc_p_t"] is None
    assert out["ave_bc_p_t"] == 0.25 and out["rate_bc_p_t"] == pytest.approx(0.25 / 0.625)
    with pytest.raises(ValueError):
        roles.pair_combine_exprs(["s"], {"bc_p": ("bc", "pit")}, ["pow"])


@pytest.mark.parametrize("edges", [v.EDGES_4, v.EDGES_5, v.EDGES_3])
def test_folds(spark, edges):
    points = [0, *edges, *[e + 1 for e in edges]]
    df = spark.createDataFrame([(int(p),) for p in points], "row_no bigint")
    n = len(edges)
    for k in range(1, n + 1):
        inside = {r[0] for r in folds.fold_rows(df, k, edges).collect()}
        outside = {r[0] for r in folds.fold_complement(df, k, edges).collect()}
        assert inside | outside == set(points) and not inside & outside
        assert edges[-1] + 1 in outside
    spread = folds.out_of_fold(df, edges).groupBy("row_no").count()
    assert {r[0]: r[1] for r in spread.collect()} == {
        p: n if p > edges[-1] else n - 1 for p in points}
    with pytest.raises(ValueError):
        folds.fold_rows(df, n + 1, edges)


def test_holdout_share(spark):
    share = folds.holdout(spark.range(20000).withColumnRenamed("id", "row_no")).agg(
        F.avg("is_test")).first()[0]
    assert abs(share - 0.25) < 0.02


def probs(spark, data):
    return spark.createDataFrame(data, "row_no int, a double, b double")


def test_ensembles_and_averages(spark):
    p, q = probs(spark, [(1, 0.9, 0.1)]), probs(spark, [(1, 0.4, 0.6)])
    close(rows(forecast.ensemble(p, q, ["a", "b"])), [(1, 0.65, 0.35)])
    ga, gb = math.sqrt(0.36), math.sqrt(0.06)
    close(rows(forecast.ensemble(p, q, ["a", "b"], "geometric")),
          [(1, ga / (ga + gb), gb / (ga + gb))])
    with pytest.raises(ValueError):
        forecast.ensemble(p, q, ["a", "b"], "harmonic")
    close(rows(forecast.fold_average(p.unionByName(q), ["a", "b"])), [(1, 0.65, 0.35)])
    close(rows(forecast.normalise(probs(spark, [(1, 1.0, 3.0)]), ["a", "b"])), [(1, 0.25, 0.75)])


def test_scores(spark):
    df = spark.createDataFrame([(0, 0.8, 0.2), (1, 0.5, 0.5), (1, 1.0, 0.0), (None, 0.5, 0.5)],
                               "y int, a double, b double")
    want = (-math.log(0.8) - math.log(0.5) - math.log(1e-15)) / 3
    assert forecast.logloss(df, "y", ["a", "b"]).first()[0] == pytest.approx(want)
    assert forecast.error_rate(df, "y", ["a", "b"]).first()[0] == pytest.approx(2 / 3)
    two = df.where("y is not null and b > 0")
    assert forecast.binary_logloss(two, "y", "b").first()[0] == pytest.approx(
        (-math.log(0.8) - math.log(0.5)) / 2)
    assert forecast.rmse(two, "y", "b").first()[0] == pytest.approx(
        math.sqrt((0.2 ** 2 + 0.5 ** 2) / 2))


def test_summaries(spark):
    df = spark.createDataFrame([("x", 1.0), ("x", None), ("y", 3.0), (None, 2.0)],
                               "c string, n double")
    assert rows(summary.value_counts(df, "c")) == [("x", 2), ("y", 1)]
    assert sorted(rows(summary.column_profile(df))) == [("c", "string", 3), ("n", "double", 3)]
    assert rows(summary.column_means(df, ["n"])) == [(2.0,)]
    imp = spark.createDataFrame([("f", 1, 1.0), ("f", 2, 2.0), ("g", 1, 9.0), ("h", 1, 5.0),
                                 ("h", 2, 5.0)], "feat_name string, fold int, feat_imp double")
    table = summary.importance_all(imp, [1, 2])
    assert rows(table) == [("h", 5.0, 5.0, 10.0), ("f", 1.0, 2.0, 3.0)]
    wide = spark.createDataFrame([(1, 2, 3)], "id int, f int, h int")
    assert summary.select_features(wide, table, 1, ["id"]).columns == ["id", "h"]


def test_flags_with_missing_values(spark):
    df = spark.createDataFrame(
        [(None, 1.0, None, 9, "裏", 5, 5, 3, 1, 0, 0, "17:59:59"),
         (2.0, None, None, 1, None, 5, 6, None, 1, 0, 0, None)],
        "runner1_id double, runner2_id double, runner3_id double, inning int, half string,"
        " pitcher_team_id int, home_team_id int, home_point int, away_point int, out_cnt int,"
        " strike_cnt int, game_time string")
    a, b = situation_flags(df).collect()
    assert (a["base_cnt"], a["runner_23"], a["bant"], a["total_inning"], a["nighter"]) == (
        1, 1, 0, 17, 0)
    assert a["point_diff"] == 2 and b["point_diff"] is None and b["home"] == 0
    assert b["bant"] == 1 and b["top_bot"] == 0


def test_profile_defaults(spark):
    df = spark.createDataFrame(
        [(2018, None, None, "1990-05-01", 100.0, 180.0, 81.0, 2.0, None, None),
         (2018, "日本", 2018.0, "1990-05-01", 100.0, 180.0, 81.0, 2.0, "x", 0)],
        "year int, country string, draft_year double, birth_date string, salary double,"
        " height double, weight double, salary_rank double, company string, univ_id int")
    a, b = profile(df, schooling=True).collect()
    assert a["foreigner"] == 1 and a["play_year"] == 6 and a["age"] == 28
    assert a["salary_x_year"] == pytest.approx(math.log1p(600)) and a["bmi"] == 25.0
    assert a["univ"] == 1 and a["highsch"] == 0
    assert b["play_year"] == 0 and b["rank_year"] is None and b["salary_year"] is None
    assert b["worked"] == 1 and b["univ"] == 0


def test_arrays_are_sorted_behind_the_shuffle_alone(spark, monkeypatch):
    """What a task makes of a few narrow rows is not held before it is dealt by key."""
    df = spark.range(200).selectExpr("id div 4 as a", "id % 4 + 1 as fold", "id * 2 as x", "string(id) as y")
    plans, checkpoint = [], type(df).checkpoint
    monkeypatch.setattr(type(df), "checkpoint", lambda self, *args: (
        plans.append(self._jdf.queryExecution().sparkPlan().toString()
                     + self._jdf.queryExecution().executedPlan().toString()), checkpoint(self, *args))[1])
    kept, size = joins.stored_arrays(df, ["a"], "fold", range(1, 5), "_f")
    got = {r["a"]: [tuple(e) for e in r["_f"]] for r in kept.collect()}
    assert got == {a: [(8 * a + 2 * k, str(4 * a + k)) for k in range(4)] for a in range(50)} and size > 0
    below = plans[0].rsplit("Exchange hashpartitioning", 1)
    assert len(below) == 2 and "Aggregate" in below[0] and "Aggregate" not in below[1]
