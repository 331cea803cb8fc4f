"""The published run end to end: features, zone sub-models, zone and ball forecasts, ensemble.

The run is a chain of stages (``plans.stages``): the feature table, the vectors of all folds, and
then per fold the number of rounds, every class's booster, the forest, and the forecasts. Each is
stored under the root and marked when it is done, so a run that was stopped, or whose driver was
lost, repeats at most the fits that were under way; a run with the same input and parameters
repeats nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, RandomForestClassificationModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast import vocabulary as v
from foldcast.operators.folds import labelled, unlabelled
from foldcast.operators.forecast import ensemble, fold_average
from foldcast.operators.joins import side_by_side
from foldcast.operators.summary import importance_all
from foldcast.plans import learn
from foldcast.plans.features import build_features, feature_names
from foldcast.plans.stages import Stages, digest, table_digest
from foldcast.plans.trees import split_importance, tree_nodes
from foldcast.plans.vectors import Vectors, read_vectors, store_vectors
from foldcast.sources.files import read_probs, write_submission, write_table


@dataclass(frozen=True)
class Task:
    """What a set of models is fitted to, and how."""

    name: str
    classes: Sequence[str]
    features: Sequence[str]
    training: Callable[[Vectors, int], DataFrame]  # features and label of a fold
    learner: str = "gbt"
    rounds: int | None = None
    max_rounds: int = learn.MAX_ROUNDS
    params: dict | None = None
    metric: str = "multi_logloss"
    growth: float = 1.0

    def settings(self) -> tuple:
        return (self.name, list(self.classes), list(self.features), self.learner, self.rounds,
                self.max_rounds, sorted((self.params or {}).items()), self.metric, self.growth)


def direct(label: str, features: Sequence[str]) -> Callable[[Vectors, int], DataFrame]:
    """Training rows of a fold whose label is a column."""
    def rows(vectors: Vectors, k: int) -> DataFrame:
        own = labelled(vectors.of(k), label).select(
            "row_no", "features", F.col(label).cast("double").alias("label"))
        return vectors.pick(own, features)
    return rows


class Run:
    """One published run under ``root``."""

    def __init__(self, events: DataFrame, actors: DataFrame, root: str, model_no: str,
                 edges: Sequence[int], patience: int, parallelism: int):
        self.spark = events.sparkSession
        self.events, self.actors, self.edges = events, actors, list(edges)
        self.folds = list(range(1, len(edges) + 1))
        self.patience, self.parallelism = patience, parallelism
        self.stages = Stages(self.spark, root, model_no)
        self.digest = digest(table_digest(events), table_digest(actors), self.edges)

    def wide(self) -> DataFrame:
        path = self.stages.once("features", self.digest, lambda path: write_table(
            build_features(self.events, self.actors, self.edges), path, ["fold"]))
        return self.spark.read.parquet(path)

    def vectors(self, features: Sequence[str]) -> Vectors:
        """The vector table of all folds; its slots are in the stage's mark."""
        path, wide = self.stages.path("vectors"), self.wide()
        told = self.stages.value("vectors", digest(self.digest, list(features)), lambda: "\n".join(
            store_vectors(wide, features, list(v.LABELS), self.folds, path).slots))
        return read_vectors(self.spark, path, told.split("\n"))

    def rounds(self, task: Task, vectors: Vectors, before: str) -> dict[int, tuple[float | None, int]]:
        """Score and number of rounds of every fold."""
        if task.rounds is not None:
            return {k: (None, task.rounds) for k in self.folds}

        def job(k: int):
            def find() -> str:
                curve, at = learn.cv_vectors(
                    task.training(vectors, k), "label", len(task.classes), task.max_rounds,
                    task.params, patience=self.patience, parallelism=self.parallelism,
                    metric=task.metric)
                return f"{curve[at - 1][task.metric]!r} {at}"
            return lambda: self.stages.value(
                f"rounds_{task.name}", digest(before, *task.settings(), self.patience), find, k)

        told = [x.split() for x in side_by_side(self.spark, [job(k) for k in self.folds])]
        return {k: (float(score), max(1, int(int(at) * task.growth)))
                for k, (score, at) in zip(self.folds, told)}

    def fitted(self, task: Task, vectors: Vectors, before: str) -> tuple[Callable, str, float | None]:
        """What reads the models of a fold; a digest of all that they depend on; the score."""
        chosen = self.rounds(task, vectors, before)
        wanted = digest(before, *task.settings(), sorted(chosen.items()))
        rows = {k: learn.weighed(task.training(vectors, k), task.learner, task.params)
                for k in self.folds}
        kind = RandomForestClassificationModel if task.learner == "rf" else GBTClassificationModel
        jobs = []
        for k in self.folds:
            fits = learn.learners(rows[k], len(task.classes), task.learner, chosen[k][1], task.params)
            for i, (learner, own) in enumerate(fits):
                jobs.append(functools.partial(
                    self.stages.once, f"model_{task.name}", wanted,
                    lambda path, f=learner, r=own: f.fit(r).write().overwrite().save(path), k, str(i)))
        for own in rows.values():
            own.persist()
        try:
            paths = side_by_side(self.spark, jobs, self.parallelism)
        finally:
            for own in rows.values():
                own.unpersist()
        each = len(paths) // len(self.folds)

        def models(k: int) -> list:
            at = self.folds.index(k) * each
            return side_by_side(self.spark, [lambda p=p: kind.load(p) for p in paths[at:at + each]],
                                self.parallelism)

        known = [s for s, _ in chosen.values() if s is not None]
        return models, wanted, sum(known) / len(known) if known else None

    def forecast(self, task: Task, vectors: Vectors, models: Callable, label: str, before: str,
                 ) -> DataFrame:
        """The folds' forecasts of the unlabelled rows, averaged."""
        def job(k: int):
            rows = vectors.pick(unlabelled(vectors.of(k), label), task.features)
            return lambda: self.stages.once(
                f"forecast_{task.name}", before, lambda path: write_table(
                    learn.score_once(rows, [(models(k), task.classes)], learn.IDS), path), k)

        paths = side_by_side(self.spark, [job(k) for k in self.folds], self.parallelism)
        return fold_average(self.spark.read.parquet(*paths), task.classes)

    def importance(self, task: Task, vectors: Vectors, before: str) -> DataFrame:
        """Splits of every feature per fold, over the boosters of all classes."""
        names = vectors.chosen(task.features)

        def write(path: str) -> None:
            nodes = [tree_nodes(self.spark, self.stages.path(f"model_{task.name}", k, str(i)), fold=k)
                     for k in self.folds for i in range(len(task.classes))]
            found = split_importance(functools.reduce(DataFrame.unionByName, nodes), names, ["fold"])
            table = found.select("feat_name", "fold", F.col("splits").cast("double").alias("feat_imp"))
            write_table(importance_all(table, self.folds), path)

        return self.spark.read.parquet(self.stages.once(f"importance_{task.name}", before, write))

    def submission(self, name: str, probs: DataFrame, classes: Sequence[str], before: str) -> str:
        return self.stages.once(f"submit_{name}", before, lambda path: write_submission(
            probs, path, classes, self.edges[-1] + 1))

    def stacked(self, vectors: Vectors, features: Sequence[str], models: Sequence[Callable],
                before: str) -> Vectors:
        """The vectors with the zone sub-models' probabilities as further slots."""
        specs = learn.sub_model_specs()
        added = [c for _, _, classes in specs for c in classes]

        def write(path: str) -> None:
            parts = []
            for k in self.folds:
                parts.append(learn.add_scores(
                    vectors, vectors.of(k), features,
                    [(own(k), classes) for (_, _, classes), own in zip(specs, models)]))
            vectors.widened(functools.reduce(DataFrame.unionByName, parts), added, path)

        path = self.stages.once("stacked", before, write)
        return read_vectors(self.spark, path, [*vectors.slots, *added])


def run(events: DataFrame, actors: DataFrame, root: str, model_no: str,
        edges: Sequence[int] = v.EDGES_4, rounds: int | None = None,
        max_rounds: int | None = None, how: str = "mean", leaking: bool = False,
        parallelism: int = 4, features: Sequence[str] | None = None,
        params: dict[str, dict] | None = None, patience: int = v.EARLY_STOP,
        growth: float = 1.0) -> dict[str, object]:
    """Write features, models, forecasts and importance under ``root``; return what was found.

    ``rounds=None`` finds the number of rounds of every booster by cross-validation, sub-models
    included, up to the published most (``max_rounds`` sets another); zones are judged by the log
    loss, balls by the error. ``growth`` scales the rounds before the refit. ``features`` and
    ``params`` (by label) replace the published ones. Each member of the ensemble gets a
    submission of its own. The outcome holds the CV scores (``course``, ``ball``), the folders of
    the ``submissions`` and the stages that this call ``ran``.
    """
    job = Run(events, actors, root, model_no, edges, patience, parallelism)
    names = list(features or feature_names())
    given = params or {}
    tuned = {t: given.get(t, learn.mllib_params(v.TUNED[t, "gbdt"])) for t in v.LABELS}
    forest = given.get("forest", learn.mllib_params(v.TUNED["ball", "dart"]))
    most = {t: max_rounds or v.TUNED[t, "gbdt"]["rounds"] for t in v.LABELS}
    zone_names = learn.model_features(names, "course", leaking)
    vectors, start = job.vectors(names), digest(job.digest, names)

    sub_models, done = [], []
    for name, lookup, classes in learn.sub_model_specs():
        task = Task(name, classes, learn.zone_free(zone_names),
                    lambda x, k, lookup=lookup: learn.coarse_rows(x, zone_names, lookup, k),
                    rounds=rounds, max_rounds=most["course"], params=tuned["course"], growth=growth)
        models, made, _ = job.fitted(task, vectors, start)
        sub_models.append(models)
        done.append(made)
    zone = Task("course", v.ZONES, zone_names, direct("course", zone_names), rounds=rounds,
                max_rounds=most["course"], params=tuned["course"], growth=growth)
    zone_models, zone_made, zone_score = job.fitted(zone, vectors, start)
    zone_probs = job.forecast(zone, vectors, zone_models, "course", zone_made)

    after = digest(start, *done)
    wide = job.stacked(vectors, zone_names, sub_models, after)
    ball_names = [*learn.model_features(names, "ball", leaking),
                  *[c for _, _, classes in learn.sub_model_specs() for c in classes]]
    boosted = Task("ball_boosted", v.BALLS, ball_names, direct("ball", ball_names), rounds=rounds,
                   max_rounds=most["ball"], params=tuned["ball"], metric="multi_error", growth=growth)
    trees = rounds or max_rounds or v.TUNED["ball", "dart"]["rounds"]
    second = Task("ball_forest", v.BALLS, ball_names, direct("ball", ball_names), "rf", trees,
                  params=forest)
    ball_models, ball_made, ball_score = job.fitted(boosted, wide, after)
    forest_models, forest_made, _ = job.fitted(second, wide, after)
    first = job.forecast(boosted, wide, ball_models, "ball", ball_made)
    other = job.forecast(second, wide, forest_models, "ball", forest_made)

    both = digest(ball_made, forest_made, how)
    submissions = {
        "course": job.submission("course", zone_probs, v.ZONES, zone_made),
        "ball_boosted": job.submission("ball_boosted", first, v.BALLS, ball_made),
        "ball_forest": job.submission("ball_forest", other, v.BALLS, forest_made),
        "ball": job.submission("ball", ensemble(first, other, v.BALLS, how), v.BALLS, both)}
    job.importance(zone, vectors, zone_made)
    job.importance(boosted, wide, ball_made)
    return {"course": zone_score, "ball": ball_score, "submissions": submissions,
            "ran": job.stages.ran}


def submitted(events: DataFrame, found: dict[str, object], edges: Sequence[int],
              ) -> DataFrame:
    """The zone and boosted ball submissions of a run side by side, by row number."""
    spark, folders = events.sparkSession, found["submissions"]
    zone = read_probs(spark, folders["course"], v.ZONES)
    ball = read_probs(spark, folders["ball_boosted"], v.BALLS)
    return zone.join(ball, "index").withColumn(
        "row_no", F.col("index") + F.lit(edges[-1] + 1)).drop("index")
