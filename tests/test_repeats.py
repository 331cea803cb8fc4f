"""Fits and scores of rows that repeat: equal rows count as one with a weight."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from foldcast.plans import learn, trees


def vectors(df):
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(df)


@pytest.fixture(scope="module")
def rows(spark):
    return vectors(spark.range(600).selectExpr(
        "id as row_no", "cast(id % 4 as double) as a", "cast(id div 3 % 3 as double) as b",
        "cast(id * id % 7 % 3 as double) as label")).drop("a", "b").persist()


def plain(monkeypatch):
    monkeypatch.setattr(learn, "REPEATS", math.inf)


def test_equal_rows_become_weights(spark, rows):
    params = {"maxDepth": 12, "minInstancesPerNode": 1}
    few = learn.weighed(rows, "gbt", params)
    want = rows.groupBy("features", "label").count().count()
    assert few.count() == want <= 36
    assert few.agg(F.sum(learn.WEIGHT)).first()[0] == 600
    assert few.rdd.getNumPartitions() == 1
    # what draws rows, or counts them in leaves, keeps them, and so do rows that hardly repeat
    for learner, own in [("rf", {}), ("gbt", {"subsamplingRate": 0.5}),
                         ("gbt", {"minInstancesPerNode": 2})]:
        assert learn.weighed(rows, learner, own) is rows
    rare = vectors(spark.range(200).selectExpr("cast(id as double) as a", "0D as b", "0D as label"))
    assert learn.weighed(rare, "gbt", None) is rare
    none = rows.where("row_no < 0")
    assert learn.weighed(none, "gbt", None) is none


def test_trees_are_those_of_all_rows(spark, rows, monkeypatch, tmp_path):
    def nodes(name):
        model = learn.fit_vectors(rows, 3, rounds=3, params={"maxDepth": 12})[1]
        model.write().save(f"{tmp_path}/{name}")
        found = trees.tree_nodes(spark, f"{tmp_path}/{name}").toPandas().sort_values(["tree", "node"])
        return found.to_numpy(dtype=float)

    few = nodes("few")
    plain(monkeypatch)
    np.testing.assert_allclose(few, nodes("all"), atol=1e-12)


def test_one_vector_and_label(rows):
    same = rows.where("row_no % 12 = 0").withColumn("label", F.lit(0.0))
    models = learn.fit_vectors(same, 2, rounds=2, params={"maxDepth": 12})
    probs = learn.score(same, models, ["x", "y"], ["row_no"]).toPandas()
    assert len(probs) == 50 and (probs["x"] > probs["y"]).all()


@pytest.mark.parametrize("classes, metric", [
    (3, "multi_logloss"), (3, "class_logloss"), (None, "class_logloss")])
def test_cross_validation_is_that_of_all_rows(rows, monkeypatch, classes, metric):
    def curve():
        return learn.cv_vectors(rows.coalesce(1), "label", classes, 2, {"maxDepth": 12}, nfold=2,
                                parallelism=6, metric=metric)

    few, at = curve()
    plain(monkeypatch)
    every, whole_at = curve()
    assert at == whole_at
    for a, b in zip(few, every, strict=True):
        assert a == pytest.approx(b, abs=1e-9)


def test_each_vector_is_scored_once(rows, monkeypatch):
    members = [(learn.fit_vectors(rows, 3, rounds=2, params={"maxDepth": 12}), ["x", "y", "z"]),
               (learn.fit_vectors(rows, 2, rounds=1), ["u", "w"])]
    kept = rows.withColumn("ball", F.when(F.col("row_no") % 5 > 0, F.col("label")))
    twice = kept.unionByName(kept.where("row_no < 100"))
    scored, score = [], learn.score

    def spy(part, *more):
        scored.append(part.count())
        return score(part, *more)

    def run():
        scored.clear()
        out = learn.score_once(twice, members, ["row_no", "ball"]).toPandas()
        assert list(out.columns) == ["row_no", "ball", "x", "y", "z", "u", "w"]
        return out.sort_values("row_no").to_numpy(dtype=float)

    monkeypatch.setattr(learn, "score", spy)
    few = run()
    assert scored == [12, 12]
    monkeypatch.setattr(learn, "BROADCAST_BYTES", 0)
    np.testing.assert_allclose(few, run(), atol=1e-12)
    assert scored == [700, 700]
    assert len(few) == 700
