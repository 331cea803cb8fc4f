"""Fitted trees as a table of nodes: split counts, gains, and scores after every round."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldcast.operators.forecast import PROB_FLOOR
from foldcast.operators.joins import hand_dim

#: Rows times rounds times classes that are scored at once in a task.
CELLS = 1 << 20
#: Two classes as likely as that to each other are tied, which counts as an error.
TIE = 1e-9
METRICS = ["class_logloss", "multi_logloss", "multi_error"]


def tree_nodes(spark: SparkSession, path: str, **keys) -> DataFrame:
    """One row per node of the ensemble saved at ``path``, with the constant columns ``keys``.

    ``feature``, ``threshold``, ``left`` and ``right`` are NULL for a leaf; ``value`` is what a leaf
    predicts, ``weight`` that of its tree, ``rows`` the weight of the rows that it was fitted to.
    """
    data = spark.read.parquet(f"{path}/data")
    weights = spark.read.parquet(f"{path}/treesMetadata").select(
        F.col("_1").alias("tree"), F.col("_3").alias("weight"),
        F.col("_2").contains("DecisionTreeRegressionModel").alias("_variance"))
    inner = F.col("nodeData.split.featureIndex") >= 0

    def split(name: str) -> Column:
        return F.when(inner, F.col(f"nodeData.{name}"))

    stats = F.col("nodeData.impurityStats")  # of a variance: weight, sum and sum of squares
    total = F.aggregate(stats, F.lit(0.0), lambda a, b: a + b)  # of classes: the weight of each
    nodes = data.join(weights, F.col("treeID") == F.col("tree")).select(
        "tree", "weight", F.col("nodeData.id").alias("node"),
        split("split.featureIndex").alias("feature"),
        F.when(inner, F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        split("leftChild").alias("left"), split("rightChild").alias("right"),
        F.col("nodeData.prediction").alias("value"), split("gain").alias("gain"),
        F.when(F.col("_variance"), F.get(stats, F.lit(0))).otherwise(total).alias("rows"))
    return nodes.select(*[F.lit(v).alias(k) for k, v in keys.items()], "*")


def split_importance(nodes: DataFrame, names: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Number of ``splits`` and total ``gain`` (per row, times rows) of every feature, 0 for one
    that no tree uses; ``by`` must hold constant columns of ``nodes``."""
    spark = nodes.sparkSession
    listed = hand_dim(spark, [(str(i), n) for i, n in enumerate(names)], "feature", "feat_name")
    listed = listed.select(F.col("feature").cast("int").alias("feature"), "feat_name")
    used = nodes.where("feature is not null").groupBy(*by, "feature").agg(
        F.count(F.lit(1)).alias("splits"), F.sum(F.col("gain") * F.col("rows")).alias("gain"))
    # one entry per feature meets every combination of the constant columns
    listed = F.broadcast(listed)
    if by:
        entry = F.array(*[F.lit(i) for i in range(len(names))])
        every = nodes.select(*by).distinct().select(*by, F.explode(entry).alias("feature"))
        listed = every.join(listed, "feature")
    found = listed.join(used, [*by, "feature"], "left")
    return found.select(*by, "feat_name", F.coalesce("splits", F.lit(0)).alias("splits"),
                        F.coalesce("gain", F.lit(0.0)).alias("gain"))


def _arrays(nodes: DataFrame) -> list[dict[str, np.ndarray]]:
    """The trees of each class as arrays; as many entries as the trees have nodes."""
    rows = nodes.select("class", "tree", "node", "feature", "threshold", "left", "right", "value",
                        "weight").toPandas().sort_values(["class", "tree", "node"])
    out = []
    for _, own in rows.groupby("class"):
        own = own.reset_index(drop=True)
        first = own.index[own["node"] == 0].to_numpy()
        start = np.repeat(first, np.diff([*first, len(own)]))
        leaf = own["feature"].isna().to_numpy()
        here = np.arange(len(own))
        out.append({
            "first": first,
            "feature": own["feature"].fillna(0).to_numpy(np.int64),
            "threshold": own["threshold"].fillna(np.inf).to_numpy(float),
            "left": np.where(leaf, here, own["left"].fillna(0).to_numpy(np.int64) + start),
            "right": np.where(leaf, here, own["right"].fillna(0).to_numpy(np.int64) + start),
            "value": (own["value"] * own["weight"]).to_numpy(float),
        })
    return out


def _margins(x: np.ndarray, trees: dict[str, np.ndarray]) -> np.ndarray:
    """The sum of the trees' outputs after every round: rows by rounds."""
    at = np.tile(trees["first"], (len(x), 1))
    row = np.arange(len(x))[:, None]
    while True:
        low = x[row, trees["feature"][at]] <= trees["threshold"][at]
        below = np.where(low, trees["left"][at], trees["right"][at])
        if (below == at).all():
            return np.cumsum(trees["value"][at], axis=1)
        at = below


def _losses(x: np.ndarray, label: np.ndarray, forests: list[dict[str, np.ndarray]],
            weight: np.ndarray) -> np.ndarray:
    """Weighted sums of the three metrics over rows: metrics by rounds."""
    margin = np.stack([_margins(x, f) for f in forests])  # classes, rows, rounds
    sign = np.where(label[None, :] == np.arange(len(forests))[:, None], 1.0, -1.0)[:, :, None]
    each = np.logaddexp(0.0, -2 * sign * margin).sum(axis=0)
    prob = 1 / (1 + np.exp(-2 * margin))
    true = np.take_along_axis(prob, label[None, :, None], axis=0)[0]
    log = -np.log(np.maximum(true / prob.sum(axis=0), PROB_FLOOR))
    wrong = (prob >= true[None] - TIE).sum(axis=0) > 1
    return np.stack([weight @ each, weight @ log, weight @ wrong])


def staged_scores(rows: DataFrame, nodes: DataFrame, weight: str | None = None) -> DataFrame:
    """Mean of every metric after each round, over ``rows`` (``features``, ``label``), in one pass;
    a row counts as often as the column ``weight`` says.

    ``nodes`` has a column ``class`` with the number of the class that a booster tells from the
    rest. It is shipped to the tasks: its size is the rounds times the nodes of a tree times the
    classes, whatever the number of rows. Tasks return one row per round.
    """
    forests = _arrays(nodes)
    rounds = len(forests[0]["first"])
    step = max(1, CELLS // (rounds * len(forests)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros((len(METRICS), rounds)), 0.0
        for batch in batches:
            if not batch.num_rows:
                continue
            values = batch.column("x").flatten().to_numpy(zero_copy_only=False)
            x = values.reshape(batch.num_rows, -1)
            label = batch.column("label").to_numpy(zero_copy_only=False).astype(np.int64)
            count = batch.column("weight").to_numpy(zero_copy_only=False)
            for low in range(0, len(x), step):
                part = slice(low, low + step)
                total += _losses(x[part], label[part], forests, count[part])
            seen += count.sum()
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(1, rounds + 1)), pa.array([seen] * rounds), *map(pa.array, total)],
                names=["round", "n", *METRICS])

    count = F.lit(1.0) if weight is None else F.col(weight)
    parts = rows.select(vector_to_array("features").alias("x"), F.col("label").cast("int"),
                        count.alias("weight")).mapInArrow(
        run, "round long, n double, " + ", ".join(f"{m} double" for m in METRICS))
    return parts.groupBy("round").agg(*[
        (F.sum(m) / F.sum("n")).alias(m) for m in METRICS])
