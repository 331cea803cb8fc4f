"""The wide feature table, sources and training helpers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from foldcast import vocabulary as v
from foldcast.operators import folds, joins, sequence
from foldcast.operators.folds import fold_of
from foldcast.operators.joins import append_unlabelled
from foldcast.plans import features, learn
from foldcast.queries.views import pitch_like, player_like
from foldcast.sources import files

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def log(spark):
    pl, edges = pitch_like(spark, SF_DIR)
    return pl.drop("own_fold", "pit_bat", "count_key"), edges


@pytest.fixture(scope="module")
def wide(spark, log):
    events, edges = log
    return features.build_features(events, player_like(spark, SF_DIR), edges).persist()


def test_number_of_features():
    names = features.feature_names()
    assert len(names) == len(set(names)) == 640
    assert len(learn.model_features(names, "course", leaking=True)) == 640
    ball = learn.model_features(names, "ball", leaking=True)
    assert len([*ball, *v.LR_CLASSES, *v.HL_CLASSES]) == 637
    assert "last_ball" not in learn.model_features(names, "ball")


def test_wide_table(log, wide):
    events, edges = log
    assert len(wide.columns) == 640 + 4
    own = fold_of(edges)
    # a row never meets its own fold, and unlabelled rows meet all
    assert wide.where(F.col("fold") == own).count() == 0
    n = events.count()
    test = events.where(F.col("ball").isNull()).count()
    assert wide.count() == (n - test) * (len(edges) - 1) + test * len(edges)
    assert wide.select("row_no", "fold").distinct().count() == wide.count()


def same_rows(a, b):
    cols = ["row_no", "fold", *features.SEQUENCE, "straight_pit", "total_bat", "salary_rank_cat",
            "rate_bc_p_fork", "ave_b_c_high_str"]
    sides = []
    for df in (a, b):
        rows = df.selectExpr("row_no", "fold", *[f"cast({c} as double) as {c}" for c in cols[2:]])
        sides.append(rows.toPandas().sort_values(["row_no", "fold"]).to_numpy(dtype=float))
    np.testing.assert_allclose(*sides)


def test_order_of_input_does_not_matter(spark, log, wide):
    events, edges = log
    again = features.build_features(events.repartition(13).orderBy(F.xxhash64("row_no")),
                                    player_like(spark, SF_DIR).repartition(5), edges)
    same_rows(wide, again)


def test_beyond_the_bounds(spark, monkeypatch, log, wide):
    """No broadcast lookups, many heavy keys and small chunks give the same table."""
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins, "HEAVY_ROWS", 40)
    monkeypatch.setattr(sequence, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(sequence, "CHUNK_ROWS", 64)
    events, edges = log
    again = features.build_features(events, player_like(spark, SF_DIR), edges)
    same_rows(wide, again)


def test_mix_from_the_history_fold(spark, log):
    events, edges = log
    out = features.build_features(events, player_like(spark, SF_DIR), edges, mix_fold=True,
                                  fill=False, min_years=2)
    assert len(out.columns) == 644
    total = sum((F.col(f"bc_{z}") for z in v.ZONES), F.lit(0.0))
    assert out.where(F.abs(total - 1) > 1e-9).count() == 0


def test_strict_plate_key(log):
    events, _ = log
    timed = features.with_clock(features.situation_flags(features.with_keys(events)))
    loose = features.sequence_features(timed)
    strict = features.sequence_features(timed, features.PLATE_STRICT)
    assert loose.count() == strict.count()
    assert loose.select("row_no", "pre_ball_ball").exceptAll(
        strict.select("row_no", "pre_ball_ball")).count() > 0


def test_history_adds_up_over_folds(log):
    events, edges = log
    from foldcast.operators.history import actor_history

    keyed = features.with_keys(events)
    parts = actor_history(keyed.withColumn("fold", fold_of(edges)), "pitcher", "pitcher_id")
    whole = keyed.where(F.col("ball").isNotNull())
    assert parts.agg(F.sum("total")).first()[0] == whole.count()


def test_sources(spark, tmp_path):
    names = {name: source for source, (name, _) in v.EVENT_COLUMNS.items()}
    typed = ", ".join(f"`{s}` {t}" for s, (_, t) in v.EVENT_COLUMNS.items())
    row = [None] * len(names)
    order = list(v.EVENT_COLUMNS)
    row[order.index(names["row_no"])], row[order.index(names["ball"])] = 5, 2
    row[order.index(names["half"])] = "裏"
    raw = spark.createDataFrame([tuple(row)], typed)
    raw.write.csv(str(tmp_path / "train"), header=True)
    raw.drop("球種", "投球位置区域").write.csv(str(tmp_path / "test"), header=True)
    train = files.read_events(spark, str(tmp_path / "train"))
    test = files.number_unlabelled(files.read_events(spark, str(tmp_path / "test"), False), 99)
    assert len(train.columns) == 51 and len(test.columns) == 49
    got = append_unlabelled(train, test).orderBy("row_no").select("row_no", "ball", "half")
    assert [tuple(r) for r in got.collect()] == [(5, 2, "裏"), (105, None, "裏")]
    actors = spark.createDataFrame(
        [tuple([2017] + [None] * 24)],
        ", ".join(f"`{s}` {t}" for s, (_, t) in v.ACTOR_COLUMNS.items()))
    actors.write.csv(str(tmp_path / "actors"), header=True)
    assert files.read_actors(spark, str(tmp_path / "actors")).first()["year"] == 2017
    path = files.table_path(str(tmp_path), "probs", "62")
    probs = spark.createDataFrame([(101, 1, 0.25, 0.75)], "row_no bigint, fold int, a double, b double")
    files.write_table(probs, path, ["fold"])
    back = spark.read.parquet(path).where("fold = 1")
    files.write_submission(back, str(tmp_path / "sub"), ["a", "b"], offset=100)
    assert tuple(files.read_probs(spark, str(tmp_path / "sub"), ["a", "b"]).first()) == (
        1, 0.25, 0.75)
    assert files.table_path("r", "s", "62", 3) == "r/s/model_no=62/fold=3"


def test_best_round():
    assert learn.best_round([3.0, 2.0, 2.5, 1.0]) == (1.0, 4)
    assert learn.best_round([3.0, 2.0, 2.5, 2.6, 1.0], patience=2) == (2.0, 2)


def test_params():
    assert learn.mllib_params(v.TUNED["ball", "gbdt"])["maxDepth"] == 5
    assert learn.mllib_params(v.TUNED["course", "dart"])["maxDepth"] == math.ceil(math.log2(6))


def toy(spark):
    data = [(i, 1, i % 2, i % 2, float(i % 2) if i % 5 else None, float(i)) for i in range(80)]
    data += [(80 + i, 1, None, None, float(i % 2), float(i)) for i in range(4)]
    return spark.createDataFrame(
        data, "row_no bigint, fold int, ball int, course int, x double, noise double")


def test_fits(spark):
    df = toy(spark)
    train = df.where("ball is not null")
    matrix = learn.feature_matrix(train, ["x", "noise"])
    assert matrix.flagged == ["x"] and matrix.names == ["x", "noise", "x_missing"]
    model = learn.fit_multiclass(train, ["x", "noise"], "ball", ["a", "b"], "gbt", rounds=2)
    out = {r["row_no"]: r for r in model.predict(df.where("ball is null")).collect()}
    assert out[80]["a"] > 0.5 > out[80]["b"] and out[81]["b"] > 0.5
    assert all(r["a"] + r["b"] == pytest.approx(1) for r in out.values())
    for by in ("share", "splits", "gain"):
        found = {r["feat_name"]: r["feat_imp"] for r in learn.importance(
            spark, model.models, matrix.names, 1, by).collect()}
        assert set(found) == set(matrix.names) and found["x"] > 0
        assert by != "share" or max(found, key=found.get) == "x"
    score, rounds = learn.cv_rounds(train, ["x"], "noise", None, max_rounds=2, nfold=2)
    assert rounds >= 1 and score > 0
    with pytest.raises(ValueError):
        learn.fit_multiclass(train, ["x"], "ball", ["a", "b"], "svm", rounds=1)


def test_cv_folds_keep_class_shares(spark):
    df = spark.range(8000).selectExpr("id as row_no", "int(id % 4 = 0) as y")
    shares = df.groupBy(learn.cv_fold("y").alias("k")).agg(F.avg("y").alias("s")).collect()
    assert len(shares) == 4 and all(abs(r["s"] - 0.25) < 0.03 for r in shares)


def test_train_folds_with_cross_validation(spark):
    run = learn.train_folds(toy(spark), ["x", "noise"], "ball", ["a", "b"], [1], "gbt",
                            rounds=None, max_rounds=2, growth=1.1, cv_every_fold=False)
    assert run.probs.count() == 4 and run.cv_score > 0
    assert run.importance.columns == ["feat_name", "feat_imp_1", "sum"]


def test_rounds_stop_early(spark):
    """Noise is learnt by heart at once, so the loss outside grows and boosting stops."""
    noise = spark.range(300).selectExpr(
        "id as row_no", "int(pmod(xxhash64(id), 2)) as y", "double(pmod(xxhash64(id, 1), 97)) as x")
    loss, at = learn.cv_rounds(noise, ["x"], "y", None, max_rounds=40, patience=3, nfold=2,
                               params={"maxDepth": 4})
    assert at + 3 <= 40 and loss > 0
    fewer = learn.cv_rounds(noise, ["x"], "y", None, max_rounds=12, patience=3, nfold=2,
                            params={"maxDepth": 4})
    assert fewer == (loss, at)


def test_forest_with_a_class_without_a_name(spark):
    train = toy(spark).where("ball is not null")
    model = learn.fit_multiclass(train, ["x"], "ball", ["a", "b"], "rf", rounds=1)
    model.classes = ["a"]
    with pytest.raises(ValueError):
        model.predict(train)


def test_tuning_does_not_depend_on_layout(spark):
    train = toy(spark).where("ball is not null")
    grid = {"maxDepth": [1, 3]}
    tables = [learn.tune(df, ["x", "noise"], "ball", ["a", "b"], grid, rounds=2).collect()
              for df in (train.repartition(5, "noise"), train.coalesce(1))]
    assert [tuple(r) for r in tables[0]] == [
        (r["params"], pytest.approx(r["logloss"])) for r in tables[1]]


def test_more_folds(spark):
    """Three and five folds, as the fold edges say."""
    rows = spark.range(100).withColumnRenamed("id", "row_no")
    for edges in ([29, 59, 89], [19, 39, 59, 79, 89]):
        out = folds.out_of_fold(rows, edges)
        assert out.count() == 90 * (len(edges) - 1) + 10 * len(edges)


def test_scratch_folder_must_be_shared():
    from types import SimpleNamespace

    from foldcast.operators.joins import shared_folder

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    remote = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)
    with pytest.raises(RuntimeError):
        shared_folder(remote)
    context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        shared_folder(remote)
