"""Training: out-of-fold models, sub-models, cross-validated rounds, tuning, importance.

MLlib's learners do the fitting. Boosting is one binary ``GBTClassifier`` per class with the
probabilities scaled to sum 1; the second variant is a random forest.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from foldcast import vocabulary as v
from foldcast.functions.expr import recode_label
from foldcast.operators.folds import holdout, labelled, unlabelled
from foldcast.operators.forecast import fold_average, logloss, normalise
from foldcast.operators.joins import BROADCAST_BYTES, scratch_path, side_by_side, stored
from foldcast.operators.summary import importance_all
from foldcast.plans.trees import METRICS, split_importance, staged_scores, tree_nodes
from foldcast.plans.vectors import Vectors, store_vectors

IDS = ["row_no", "fold"]
# columns that look ahead; left out of training unless asked for
LEAKING = ["last_ball"]
#: Most boosting rounds of the published settings.
MAX_ROUNDS = max(t["rounds"] for t in v.TUNED.values())
#: Times that a row with its label comes on average, from which on equal rows are fitted as one.
REPEATS = 4
#: Rows of a partition of those that are left.
PART_ROWS = 1 << 14
WEIGHT = "_weight"
ROLE_ZONE_PARTS = ["_str_pit", "_ball_pit", "_str_bat", "_ball_bat"]


def mllib_params(tuned: dict) -> dict:
    """Tuned booster parameters under their MLlib names; the L1 and L2 terms have none."""
    return {
        "stepSize": tuned["learning_rate"],
        "subsamplingRate": tuned["bagging_fraction"],
        "featureSubsetStrategy": str(tuned["feature_fraction"]),
        "minInstancesPerNode": tuned["min_child_samples"],
        "maxDepth": math.ceil(math.log2(tuned["num_leaves"])),
    }


@dataclass
class Matrix:
    """How rows become feature vectors: medians for NULLs, and a flag per column that had any."""

    features: list[str]
    medians: list[float]
    flagged: list[str]

    @property
    def names(self) -> list[str]:
        return [*self.features, *[f"{c}_missing" for c in self.flagged]]

    def transform(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        filled = df.selectExpr(
            *keep,
            *[f"coalesce(cast(`{c}` as double), {m!r}D) as `_x{i}`"
              for i, (c, m) in enumerate(zip(self.features, self.medians))],
            *[f"cast(`{c}` is null as double) as `_m{i}`" for i, c in enumerate(self.flagged)],
        )
        inputs = [f"_x{i}" for i in range(len(self.features))]
        inputs += [f"_m{i}" for i in range(len(self.flagged))]
        return VectorAssembler(inputCols=inputs, outputCol="features").transform(filled).select(
            *keep, "features")


def feature_matrix(train: DataFrame, features: Sequence[str]) -> Matrix:
    """Medians and missing flags learnt from the training rows; one number per column."""
    features = list(features)
    typed = train.selectExpr(*[f"cast(`{c}` as double) as `{c}`" for c in features])
    medians = typed.approxQuantile(features, [0.5], 0.001)
    gaps = typed.agg(*[F.expr(f"count_if(`{c}` is null) as `{c}`") for c in features]).first()
    return Matrix(features, [m[0] if m else 0.0 for m in medians],
                  [c for c in features if gaps[c] > 0])


@dataclass
class Forecaster:
    """A fitted model that turns rows into one probability column per class."""

    matrix: Matrix
    classes: list[str]
    models: list = field(default_factory=list)
    scaled: bool = True

    def predict(self, df: DataFrame, keep: Sequence[str] = IDS) -> DataFrame:
        return score(self.matrix.transform(df, keep), self.models, self.classes, keep, self.scaled)


def score(rows: DataFrame, models: Sequence, classes: Sequence[str], keep: Sequence[str],
          scaled: bool = True) -> DataFrame:
    """``rows`` (with ``features``) as probabilities of the classes: by one model of all of them, or
    by one model for each, scaled to sum 1 on request."""
    if len(models) == 1:
        if models[0].numClasses > len(classes):
            raise ValueError(f"{models[0].numClasses} classes are learnt,"
                             f" {len(classes)} have a name")
        probs = vector_to_array("probability")
        return models[0].transform(rows).select(*keep, *[
            F.coalesce(F.get(probs, F.lit(i)), F.lit(0.0)).alias(c)
            for i, c in enumerate(classes)])
    out = rows
    for i, model in enumerate(models):
        model.setProbabilityCol(f"_p{i}").setRawPredictionCol(f"_r{i}")
        out = model.setPredictionCol(f"_c{i}").transform(out)
    out = out.select(*keep, *[
        F.get(vector_to_array(f"_p{i}"), F.lit(1)).alias(c) for i, c in enumerate(classes)])
    return normalise(out, classes) if scaled else out


def score_once(rows: DataFrame, members: Sequence[tuple[Sequence, Sequence[str]]],
               keep: Sequence[str]) -> DataFrame:
    """``score`` by several members (models and their classes) for rows that are stored.

    Where a vector comes ``REPEATS`` times or more on average, and the different ones with their
    scores are small enough to broadcast, each is scored once and looked up; else every row is.
    """
    classes = [c for _, names in members for c in names]

    def scored(part: DataFrame, kept: Sequence[str]) -> DataFrame:
        told: list[str] = []
        for models, names in members:
            part = score(part, models, names, list(dict.fromkeys([*kept, "features", *told])))
            told += names
        return part.select(*kept, *classes)

    n, different, some = rows.agg(
        F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64("features")),
        F.first("features")).first()
    if (not n or different * REPEATS > n
            or 16 * different * (some.size + len(classes) + 1) > BROADCAST_BYTES):
        return scored(rows, keep)
    each = rows.select("features").distinct().coalesce(-(-different // PART_ROWS))
    table, _ = stored(scored(each, ["features"]))
    return rows.join(F.broadcast(table), "features", "left").select(*keep, *classes)


def importance(spark: SparkSession, models: Sequence, names: Sequence[str], fold: int,
               by: str = "share") -> DataFrame:
    """Feature importance of one fold's models as a table, most important first.

    ``share`` is a feature's share of the loss reduction, averaged over the models that split at
    all (a class without rows has none). ``splits`` and ``gain`` come from the nodes of the models,
    which are saved for it.
    """
    if by == "share":
        shares = [model.featureImportances.toArray() for model in models]
        splitting = [s for s in shares if s.sum() > 0]
        rows = [(n, fold, float(sum(s[i] for s in splitting)) / max(1, len(splitting)))
                for i, n in enumerate(names)]
        table = spark.createDataFrame(rows, "feat_name string, fold int, feat_imp double")
    else:
        folder = scratch_path(spark, "models")
        for i, model in enumerate(models):
            model.write().save(f"{folder}/{i}")
        nodes = [tree_nodes(spark, f"{folder}/{i}", model=i) for i in range(len(models))]
        found = split_importance(functools.reduce(DataFrame.unionByName, nodes), names)
        table = found.select("feat_name", F.lit(fold).alias("fold"),
                             F.col(by).cast("double").alias("feat_imp"))
    return table.orderBy(F.desc("feat_imp"), "feat_name")


def fit_multiclass(train: DataFrame, features: Sequence[str], label: str,
                   classes: Sequence[str], learner: str = "gbt", *, rounds: int,
                   params: dict | None = None, scaled: bool = True, seed: int = 0,
                   parallelism: int = 1) -> Forecaster:
    """Fit class probabilities: ``gbt`` (one booster per class) or ``rf`` (one forest).

    ``scaled=False`` leaves the one-per-class probabilities as they come.
    """
    matrix = feature_matrix(train, features)
    rows = matrix.transform(train, [label]).withColumn("label", F.col(label).cast("double"))
    models = fit_vectors(rows, len(classes), learner, rounds=rounds, params=params, seed=seed,
                         parallelism=parallelism)
    return Forecaster(matrix, list(classes), models, scaled)


def fit_vectors(rows: DataFrame, classes: int, learner: str = "gbt", *, rounds: int,
                params: dict | None = None, seed: int = 0, parallelism: int = 1) -> list:
    """Models of ``rows`` (``features`` and a ``label`` from 0): one booster per class, or a forest."""
    rows = weighed(rows, learner, params).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        jobs = [lambda f=f, r=r: f.fit(r)
                for f, r in learners(rows, classes, learner, rounds, params, seed)]
        return side_by_side(rows.sparkSession, jobs, parallelism)
    finally:
        rows.unpersist()


def learners(rows: DataFrame, classes: int, learner: str, rounds: int, params: dict | None = None,
             seed: int = 0) -> list[tuple]:
    """The learners of ``fit_vectors``, each with the rows that it fits."""
    params = dict(params or {})
    if learner == "rf":
        params.pop("stepSize", None)
        return [(RandomForestClassifier(numTrees=rounds, seed=seed, **params), rows)]
    if learner != "gbt":
        raise ValueError(f"learner must be 'gbt' or 'rf', not {learner!r}")
    return [(_booster(GBTClassifier, rows, maxIter=rounds, seed=seed, **params),
             rows.select("features", _is_class(i).alias("label"), *_weight(rows)))
            for i in range(classes)]


def weighed(rows: DataFrame, learner: str, params: dict | None, label: str = "label",
            more: Sequence[str] = ()) -> DataFrame:
    """Equal ``features`` with equal labels (and equal ``more``) as one row with their number as its
    weight, where a row comes ``REPEATS`` times or more on average; else ``rows`` as they are.

    The trees are the same, as all sums that MLlib splits by are weighted. A learner that draws rows
    or counts them in its leaves is not: it keeps its rows. One narrow pass estimates the different
    rows, so that wide vectors that hardly repeat are never shuffled.
    """
    given = {"subsamplingRate": 1.0, "minInstancesPerNode": 1, **(params or {})}
    if learner != "gbt" or given["subsamplingRate"] != 1.0 or given["minInstancesPerNode"] > 1:
        return rows
    keys = ["features", label, *more]
    n, different = rows.agg(F.count(F.lit(1)), F.approx_count_distinct(F.xxhash64(*keys))).first()
    if not n or different * REPEATS > n:
        return rows
    grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))
    # a fit makes many short passes over the few rows that are left
    return grouped.coalesce(-(-different // PART_ROWS))


def _weight(rows: DataFrame) -> list[str]:
    return [WEIGHT] if WEIGHT in rows.columns else []


def _booster(kind: type, rows: DataFrame, **params):
    """A booster that minds the weights of ``rows``, if they have any."""
    return kind(**params, **({"weightCol": WEIGHT} if _weight(rows) else {}))


def _is_class(i: int) -> Column:
    return (F.col("label") == i).cast("double")


def cv_fold(label: str | None, nfold: int = 4, row_no: str = "row_no") -> Column:
    """Cross-validation fold of a row, by a multiplicative hash that any engine can repeat. The
    label shifts it, so that the rows of each class are dealt out separately."""
    shift = F.lit(0) if label is None else F.coalesce(F.col(label).cast("long"), F.lit(0)) * 31_337
    mixed = (F.pmod(F.col(row_no), F.lit(1_000_003)) * 48_271 + shift) % 65_521
    return F.pmod(mixed, F.lit(nfold)).cast("int")


def best_round(losses: Sequence[float], patience: int = v.EARLY_STOP) -> tuple[float, int]:
    """Lowest mean loss and its 1-based round, stopping after ``patience`` worse rounds."""
    best, at = math.inf, 0
    for i, loss in enumerate(losses, 1):
        if loss < best:
            best, at = loss, i
        elif i - at >= patience:
            break
    return best, at


def cv_rounds(train: DataFrame, features: Sequence[str], label: str,
              classes: Sequence[str] | None, max_rounds: int = MAX_ROUNDS,
              params: dict | None = None, nfold: int = 4, patience: int = v.EARLY_STOP,
              seed: int = 0, parallelism: int = 1, metric: str = "class_logloss",
              ) -> tuple[float, int]:
    """Mean cross-validated loss and the best number of rounds; see ``cv_vectors``."""
    matrix = feature_matrix(train, features)
    rows = matrix.transform(train, ["row_no", label])
    curve, at = cv_vectors(rows, label, len(classes) if classes else None, max_rounds, params, nfold,
                           patience, seed, parallelism, metric)
    return curve[at - 1][metric], at


def cv_vectors(rows: DataFrame, label: str, classes: int | None, max_rounds: int = MAX_ROUNDS,
               params: dict | None = None, nfold: int = 4, patience: int = v.EARLY_STOP,
               seed: int = 0, parallelism: int = 1, metric: str = "class_logloss",
               ) -> tuple[list[dict[str, float]], int]:
    """Cross-validated losses after every round, and the round of the first least ``metric``.

    ``rows`` holds ``row_no``, the label and ``features``. Boosting goes on in twice as many rounds
    as long as the best one is not ``patience`` rounds back, up to ``max_rounds``; a fit's first
    rounds do not depend on how many follow. With ``classes`` folds are dealt class by class, and
    the fitted trees are scored round by round in one pass over the rows left out: the sum of the
    classes' log losses, the log loss of the scaled probabilities, the share of rows whose class
    is not the likeliest. ``class_logloss`` alone is read from the boosters without that pass.
    Without ``classes`` the loss (under any name) is the rmse of a regression over plain folds.
    """
    params = dict(params or {})
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}, not {metric!r}")
    dealt = rows.withColumn("_cv", cv_fold(label if classes else None, nfold)).select(
        "features", F.col(label).cast("double").alias("label"), "_cv")
    dealt = weighed(dealt, "gbt", params, more=["_cv"]).persist(StorageLevel.MEMORY_AND_DISK)
    folder = scratch_path(rows.sparkSession, "cv-models")

    def binary(k: int, i: int, rounds: int, path: str):
        part = dealt.select("features", _is_class(i).alias("label"), "_cv", *_weight(dealt))

        def run() -> list[float] | None:
            booster = _booster(GBTClassifier, dealt, maxIter=rounds, seed=seed, **params)
            model = booster.fit(part.where(F.col("_cv") != k))
            if metric == "class_logloss":
                # MLlib's margin loss is twice the log loss
                return [x / 2 for x in model.evaluateEachIteration(part.where(F.col("_cv") == k))]
            model.write().save(f"{path}/fold_{k}/class_{i}")
            return None

        return run

    def number(k: int, rounds: int):
        def run() -> list[float]:
            booster = _booster(GBTRegressor, dealt, maxIter=rounds, seed=seed, **params)
            model = booster.fit(dealt.where(F.col("_cv") != k))
            return [math.sqrt(x) for x in model.evaluateEachIteration(
                dealt.where(F.col("_cv") == k), "squared")]
        return run

    def scored(k: int, path: str):
        def run() -> list[dict]:
            spark = rows.sparkSession
            nodes = [tree_nodes(spark, f"{path}/fold_{k}/class_{i}", **{"class": i})
                     for i in range(classes)]
            held = dealt.where(F.col("_cv") == k)
            found = staged_scores(held, functools.reduce(DataFrame.unionByName, nodes),
                                  WEIGHT if _weight(dealt) else None)
            return [r.asDict() for r in found.orderBy("round").collect()]  # one row per round
        return run

    def curve(rounds: int) -> list[dict[str, float]]:
        path = f"{folder}/rounds_{rounds}"
        jobs = ([binary(k, i, rounds, path) for k in range(nfold) for i in range(classes)]
                if classes else [number(k, rounds) for k in range(nfold)])
        losses = side_by_side(rows.sparkSession, jobs, parallelism)
        if not classes or metric == "class_logloss":
            return [{metric: sum(step) / nfold} for step in zip(*losses)]
        parts = side_by_side(rows.sparkSession, [scored(k, path) for k in range(nfold)], parallelism)
        return [{m: sum(r[m] for r in step) / nfold for m in METRICS} for step in zip(*parts)]

    rounds = min(max_rounds, 2 * patience)
    try:
        while True:
            steps = curve(rounds)
            _, at = best_round([s[metric] for s in steps], patience)
            if at + patience <= rounds or rounds == max_rounds:
                return steps, at
            rounds = min(max_rounds, 2 * rounds)
    finally:
        dealt.unpersist()


def fit_regression(train: DataFrame, features: Sequence[str], label: str, *, rounds: int,
                   params: dict | None = None, seed: int = 0):
    """Boosted regression; returns (matrix, model)."""
    matrix = feature_matrix(train, features)
    rows = matrix.transform(train, [label]).withColumn("label", F.col(label).cast("double"))
    rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return matrix, GBTRegressor(maxIter=rounds, seed=seed, **(params or {})).fit(rows)
    finally:
        rows.unpersist()


def regression_sub_model(wide: DataFrame, features: Sequence[str], label: str, fold: int,
                         *, rounds: int, params: dict | None = None,
                         name: str = "predict_lastball") -> DataFrame:
    """Predict a number for the training and the unlabelled rows of one fold."""
    rows = wide.where(F.col("fold") == fold)
    kept = [c for c in features if c != label]
    matrix, model = fit_regression(labelled(labelled(rows, "course"), label), kept, label,
                                   rounds=rounds, params=params)
    out = model.transform(matrix.transform(rows, IDS))
    return out.select(*IDS, F.col("prediction").alias(name))


def zone_free(features: Sequence[str]) -> list[str]:
    """Features without the roles' own zone columns, which the zone sub-models do without."""
    return [c for c in features if not any(p in c for p in ROLE_ZONE_PARTS)]


def coarse_rows(vectors: Vectors, features: Sequence[str], lookup: Sequence[int], fold: int,
                ) -> DataFrame:
    """One fold's training rows with the coarsened zone as ``label``."""
    train = labelled(vectors.of(fold), "course").select(
        "row_no", "features", recode_label("course", lookup).cast("double").alias("label"))
    return vectors.pick(train, zone_free(features))


def sub_model_specs(strike: bool = False) -> list[tuple[str, list[int], list[str]]]:
    """Name, lookup and class names of the zone sub-models."""
    specs = [("lr", v.LR_LOOKUP, v.LR_CLASSES), ("hl", v.HL_LOOKUP, v.HL_CLASSES)]
    if strike:
        # "ball" alone is the name of a label
        specs.append(("strike", v.STRIKE_LOOKUP, [f"zone_{c}" for c in v.STRIKE_CLASSES]))
    return specs


def with_sub_models(wide: DataFrame | Vectors, features: Sequence[str], folds: Sequence[int],
                    learner: str = "gbt", rounds: int | None = None, params: dict | None = None,
                    strike: bool = False, max_rounds: int = MAX_ROUNDS, parallelism: int = 1,
                    ) -> tuple[Vectors, list[str]]:
    """Add the side and height sub-models (and, on request, strike or ball) to every row.

    All folds' models come from one stored vector table and are fitted side by side. A fold's
    models are applied to that fold's rows, so their columns stand beside the features without a
    join. The outcome is stored once, by fold. ``rounds=None`` finds each model's number of rounds
    by cross-validation. Returns the table and the names of the added features.
    """
    vectors = as_vectors(wide, features, folds)
    spark, specs = vectors.rows.sparkSession, sub_model_specs(strike)

    def job(k: int, lookup: Sequence[int], classes: Sequence[str]):
        def run() -> list:
            rows, best = coarse_rows(vectors, features, lookup, k), rounds
            if best is None:
                _, best = cv_vectors(rows, "label", len(classes), max_rounds, params)
            return fit_vectors(rows, len(classes), learner, rounds=best, params=params,
                               parallelism=parallelism)
        return run

    jobs = [job(k, lookup, classes) for k in folds for _, lookup, classes in specs]
    models = iter(side_by_side(spark, jobs, parallelism))
    whole = None
    for k in folds:
        part = add_scores(vectors, vectors.of(k), features,
                          [(next(models), classes) for _, _, classes in specs])
        whole = part if whole is None else whole.unionByName(part)
    added = [c for _, _, classes in specs for c in classes]
    return vectors.widened(whole, added, scratch_path(spark, "sub-models")), added


def add_scores(vectors: Vectors, rows: DataFrame, features: Sequence[str],
               members: Sequence[tuple[Sequence, Sequence[str]]]) -> DataFrame:
    """``rows`` with the probabilities of zone sub-models (models, classes) beside their vectors."""
    keep = [c for c in rows.columns if c != "features"]
    picked = vectors.pick(rows.withColumn("_whole", F.col("features")), zone_free(features))
    out = score_once(picked, members, [*keep, "_whole"])
    return out.withColumnRenamed("_whole", "features")


def as_vectors(wide: DataFrame | Vectors, features: Sequence[str], folds: Sequence[int]) -> Vectors:
    """The stored vector table of ``wide``, unless it is one."""
    if isinstance(wide, Vectors):
        return wide
    labels = [c for c in v.LABELS if c in wide.columns]
    return store_vectors(wide, features, labels, folds, scratch_path(wide.sparkSession, "vectors"))


def model_features(names: Sequence[str], task: str, leaking: bool = False) -> list[str]:
    """Feature columns of a task; the ball task leaves out the zone shares of the count mix."""
    skip = set() if leaking else set(LEAKING)
    if task == "ball":
        skip |= {f"bc_{z}" for z in v.ZONES}
    return [n for n in names if n not in skip]


@dataclass
class Run:
    """Outcome of training all folds."""

    probs: DataFrame
    importance: DataFrame
    cv_score: float | None
    rounds: dict[int, int] = field(default_factory=dict)


def train_folds(wide: DataFrame | Vectors, features: Sequence[str], label: str,
                classes: Sequence[str], folds: Sequence[int], learner: str = "gbt",
                rounds: int | None = None, max_rounds: int = MAX_ROUNDS, params: dict | None = None,
                growth: float = 1.0, cv_every_fold: bool = True, parallelism: int = 1,
                metric: str = "class_logloss", by: str = "share", patience: int = v.EARLY_STOP) -> Run:
    """Fit each fold's rows, predict the unlabelled rows and average over the folds.

    ``rounds=None`` finds the number of rounds by cross-validation with ``metric``, in every fold
    or (with ``cv_every_fold=False``) in the first one only; ``growth`` scales it before the refit.
    Medians and gaps are learnt once, for all folds. Importance is a feature's ``share`` of the
    loss reduction, or counted from the node table: its ``splits`` or its total ``gain``.
    """
    vectors = as_vectors(wide, features, folds)
    spark = vectors.rows.sparkSession
    names = vectors.chosen(features)

    def rows_of(k: int) -> DataFrame:
        rows = labelled(vectors.of(k), label).select(
            "row_no", "features", F.col(label).cast("double").alias("label"))
        return vectors.pick(rows, features)

    scores, chosen, best = [], {}, rounds
    for k in folds:
        if rounds is None and (cv_every_fold or not scores):
            curve, found = cv_vectors(rows_of(k), "label", len(classes), max_rounds, params,
                                      patience=patience, parallelism=parallelism, metric=metric)
            scores.append(curve[found - 1][metric])
            best = max(1, int(found * growth))
        chosen[k] = best

    def fold(k: int) -> tuple[DataFrame, DataFrame]:
        models = fit_vectors(rows_of(k), len(classes), learner, rounds=chosen[k], params=params,
                             parallelism=parallelism)
        rest = vectors.pick(unlabelled(vectors.of(k), label), features)
        return (score_once(rest, [(models, classes)], IDS),
                importance(spark, models, names, k, by))

    done = side_by_side(spark, [lambda k=k: fold(k) for k in folds], parallelism)
    joined, table = done[0]
    for p, t in done[1:]:
        joined, table = joined.unionByName(p), table.unionByName(t)
    return Run(fold_average(joined, classes), importance_all(table, folds),
               sum(scores) / len(scores) if scores else None, chosen)


def tune(train: DataFrame, features: Sequence[str], label: str, classes: Sequence[str],
         grid: dict[str, Sequence], rounds: int, learner: str = "gbt", parts: int = 4,
         seed: int = 0, parallelism: int = 1) -> DataFrame:
    """Log loss of every parameter combination on the hash hold-out, best first.

    The hold-out depends on row numbers only, so the table is the same however the rows lie.
    """
    dealt = holdout(train, parts, seed)
    fitted, held = dealt.where("is_test = 0"), dealt.where("is_test = 1")
    combos = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]

    def job(params: dict):
        def run() -> tuple[str, float]:
            model = fit_multiclass(fitted, features, label, classes, learner, rounds=rounds,
                                   params=params)
            loss = logloss(model.predict(held, [label]), label, classes).first()[0]
            return ", ".join(f"{n}={x}" for n, x in sorted(params.items())), loss
        return run

    table = side_by_side(train.sparkSession, [job(c) for c in combos], parallelism)
    return train.sparkSession.createDataFrame(
        table, "params string, logloss double").orderBy("logloss", "params")


def halves(df: DataFrame, keep: int, seed: int = 0, row_no: str = "row_no") -> DataFrame:
    """One row in ``keep`` by a hash of its number; a sample of twice as many holds it."""
    mixed = (F.pmod(F.col(row_no), F.lit(1_000_003)) * 48_271 + seed * 104_729) % 65_537
    return df.where(mixed % keep == 0)


def tune_halving(train: DataFrame, features: Sequence[str], label: str, classes: Sequence[str],
                 grid: dict[str, Sequence], rounds: int, learner: str = "gbt", parts: int = 4,
                 seed: int = 0, parallelism: int = 1) -> DataFrame:
    """Search by successive halving: log loss of the combinations on the hash hold-out.

    All combinations meet on a small nested sample of the training rows; the better half goes on
    with twice the rows, until one or two are left with all of them. The work is about that of
    ``log2`` of the number of combinations with all rows, not of their number. Returns every
    combination with the ``share`` of the rows on which it was judged last, best first.
    """
    dealt = holdout(train, parts, seed)
    fitted, held = dealt.where("is_test = 0"), dealt.where("is_test = 1")
    left = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    steps = max(0, math.ceil(math.log2(max(1, len(left)))) - 1)
    told: dict[str, tuple[str, float, float]] = {}

    def job(params: dict, rows: DataFrame):
        def run() -> float:
            model = fit_multiclass(rows, features, label, classes, learner, rounds=rounds,
                                   params=params)
            return logloss(model.predict(held, [label]), label, classes).first()[0]
        return run

    for step in range(steps, -1, -1):
        rows = fitted if step == 0 else halves(fitted, 1 << step, seed)
        names = [", ".join(f"{n}={x}" for n, x in sorted(c.items())) for c in left]
        losses = side_by_side(train.sparkSession, [job(c, rows) for c in left], parallelism)
        for name, loss in zip(names, losses):
            told[name] = (name, 1.0 / (1 << step), loss)
        order = sorted(range(len(left)), key=lambda i: (round(losses[i], 9), names[i]))
        left = [left[i] for i in order[:math.ceil(len(left) / 2)]]
    return train.sparkSession.createDataFrame(
        list(told.values()), "params string, share double, logloss double").orderBy(
        F.desc("share"), "logloss", "params")
