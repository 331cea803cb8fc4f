"""The staged run, its node tables, vectors and manifest."""

import functools
import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foldcast import vocabulary as v
from foldcast.plans import contest, learn, stages, trees, vectors
from foldcast.queries.views import edges_of, label_cut, pitch_like, player_like
from foldcast.sources import files

SF_DIR = "/root/testdata/sf0.001"
DEEP = {"maxDepth": 3}


@pytest.fixture(scope="module")
def toy(spark):
    """Three classes, of which one is rare, and two columns with gaps; some rows without a label."""
    data = []
    for i in range(240):
        y = None if i >= 200 else (0 if i % 3 else 1 + (i % 2))
        data.append((i, 1 + i % 2, y, y, float(i % 7) if i % 5 else None, float(i * 7 % 11)))
    return spark.createDataFrame(
        data, "row_no bigint, fold int, ball int, course int, x double, z double").repartition(3)


def test_vectors(spark, toy, tmp_path):
    found = vectors.store_vectors(toy, ["x", "z"], list(v.LABELS), [1, 2], str(tmp_path / "vec"))
    assert found.slots == ("x", "z", "x_missing")
    assert found.chosen(["x"]) == ["x", "x_missing"]
    rows = {r["row_no"]: r for r in found.rows.select(
        "row_no", "fold", vector_to_array("features").alias("f")).collect()}
    assert len(rows) == 240
    for k in (1, 2):
        own = [r for r in toy.collect() if r["fold"] == k]
        seen = sorted(r["x"] for r in own if r["x"] is not None and r["ball"] is not None)
        median = seen[math.ceil(len(seen) / 2) - 1]
        for r in own:
            x = median if r["x"] is None else r["x"]
            assert rows[r["row_no"]]["f"] == [x, r["z"], float(r["x"] is None)]
    picked = found.pick(found.of(1), ["z"]).select(vector_to_array("features").alias("f")).first()
    assert len(picked["f"]) == 1
    wider = found.widened(found.rows.withColumn("p", F.lit(0.5)), ["p"], str(tmp_path / "wide"))
    assert wider.slots[-1] == "p" and len(wider.rows.select(
        vector_to_array("features").alias("f")).first()["f"]) == 4


def boosters(rows, path, rounds=4):
    models = []
    for i in range(3):
        own = rows.withColumn("label", (F.col("label") == i).cast("double"))
        models.append(GBTClassifier(maxIter=rounds, seed=1, **DEEP).fit(own))
        models[-1].write().overwrite().save(f"{path}/{i}")
    return models


def test_staged_scores(spark, toy, tmp_path):
    """After every round, by MLlib's own predictions with that many trees."""
    table = vectors.store_vectors(toy, ["x", "z"], list(v.LABELS), [1, 2], str(tmp_path / "vec"))
    rows = learn.labelled(table.rows, "ball").select(
        "row_no", "features", F.col("ball").cast("double").alias("label"))
    boosters(rows, str(tmp_path / "m"))
    nodes = functools.reduce(DataFrame.unionByName, [
        trees.tree_nodes(spark, f"{tmp_path}/m/{i}", **{"class": i}) for i in range(3)])
    got = {r["round"]: r for r in trees.staged_scores(rows, nodes).collect()}
    assert sorted(got) == [1, 2, 3, 4]
    local = nodes.toPandas()
    data = rows.select(vector_to_array("features").alias("f"), "label").collect()
    for n in range(1, 5):
        each = log = wrong = 0.0
        for f, y in data:
            margins = []
            for i in range(3):
                total = 0.0
                for t in range(n):
                    own = local[(local["class"] == i) & (local["tree"] == t)].set_index("node")
                    at = 0
                    while not np.isnan(own.loc[at, "feature"]):
                        low = f[int(own.loc[at, "feature"])] <= own.loc[at, "threshold"]
                        at = int(own.loc[at, "left" if low else "right"])
                    total += own.loc[at, "value"] * own.loc[at, "weight"]
                margins.append(total)
            probs = [1 / (1 + math.exp(-2 * m)) for m in margins]
            each += sum(math.log(1 + math.exp(-2 * (1 if i == y else -1) * m)) for i, m in enumerate(margins))
            log -= math.log(probs[int(y)] / sum(probs))
            wrong += sum(p >= probs[int(y)] - trees.TIE for p in probs) > 1
        for name, total in zip(trees.METRICS, (each, log, wrong)):
            assert got[n][name] == pytest.approx(total / len(data))


def test_node_table(spark, toy, tmp_path):
    table = vectors.store_vectors(toy, ["x", "z"], list(v.LABELS), [1, 2], str(tmp_path / "vec"))
    rows = learn.labelled(table.rows, "ball").select("features", F.col("ball").cast("double").alias("label"))
    models = boosters(rows, str(tmp_path / "m"), rounds=2)
    forest = RandomForestClassifier(numTrees=3, maxDepth=3, seed=2).fit(rows)
    forest.save(str(tmp_path / "rf"))
    for path, model in [(f"{tmp_path}/m/{i}", m) for i, m in enumerate(models)] + [(f"{tmp_path}/rf", forest)]:
        nodes = trees.tree_nodes(spark, path, k=7)
        assert nodes.count() == model.totalNumNodes
        assert [r[0] for r in nodes.select("weight").distinct().orderBy(F.desc("weight")).collect()] == \
            sorted(set(model.treeWeights), reverse=True)
        text = model.toDebugString
        found = {r["feat_name"]: r["splits"] for r in trees.split_importance(
            nodes, [*table.slots, "unused"], ["k"]).collect()}
        assert found == {n: text.count(f"If (feature {i} ") for i, n in enumerate([*table.slots, "unused"])}
    none = trees.split_importance(nodes.where("false"), ["a"]).collect()
    assert [tuple(r) for r in none] == [("a", 0, 0.0)]


def test_metrics_choose_differently(spark):
    """Rare second class: the likeliest class is found at once, its probability only later."""
    rows = spark.range(400).selectExpr("id as row_no", "int(id % 8 = 0) as y", "double(id % 4) as x")
    table = vectors.store_vectors(rows.selectExpr("*", "1 as fold", "y as ball"), ["x"], ["ball"], [1],
                                  learn.scratch_path(spark, "t"))
    found = {m: learn.cv_vectors(table.rows, "ball", 2, 6, {"maxDepth": 2}, patience=3, metric=m)
             for m in trees.METRICS}
    assert found["multi_error"][1] < found["multi_logloss"][1]
    # the shortcut without a pass over the nodes gives the same curve
    short = [s["class_logloss"] for s in found["class_logloss"][0]]
    long = [s["class_logloss"] for s in found["multi_logloss"][0]]
    assert short == pytest.approx(long[:len(short)])
    with pytest.raises(ValueError):
        learn.cv_vectors(table.rows, "ball", 2, 2, metric="auc")


def test_manifest(spark, tmp_path):
    made = []

    def write(path):
        made.append(path)
        spark.range(3).write.mode("overwrite").parquet(path)

    run = stages.Stages(spark, str(tmp_path), "9")
    path = run.once("a", "d1", write, 2)
    assert path == run.once("a", "d1", write, 2) and made == [path]
    assert run.value("b", "d1", lambda: 42) == "42"
    again = stages.Stages(spark, str(tmp_path), "9")
    assert again.value("b", "d1", lambda: 1 / 0) == "42"
    again.once("a", "d1", write, 2)
    assert made == [path] and again.ran == []
    again.once("a", "d2", write, 2)
    assert made == [path, path] and again.ran == [("a", 2, "all")]

    def fail(path):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        again.once("c", "d1", fail)
    assert stages.Stages(spark, str(tmp_path), "9").once("c", "d1", write) and len(made) == 3
    one, two = spark.range(10), spark.range(10).repartition(4)
    assert stages.table_digest(one) == stages.table_digest(two)
    assert stages.table_digest(one) != stages.table_digest(spark.range(11))


def test_run_is_resumed(spark, tmp_path, monkeypatch):
    """A run that is stopped half-way goes on without refitting; the matrix is learnt once."""
    pl, _ = pitch_like(spark, SF_DIR)
    edges = edges_of(label_cut(spark, SF_DIR), 2)
    events = pl.drop("own_fold", "pit_bat", "count_key")
    actors, fits, learnt = player_like(spark, SF_DIR), [], []
    options = dict(rounds=1, parallelism=4, features=["ball_cnt", "strike_cnt"],
                   params={k: {"maxDepth": 4} for k in ("ball", "course", "forest")})
    real, gaps = learn.learners, vectors.gaps_and_medians

    class Counted:
        def __init__(self, inner):
            self.inner = inner

        def fit(self, rows):
            if len(fits) == stop[0]:
                raise RuntimeError("lost")
            fits.append(1)
            return self.inner.fit(rows)

    monkeypatch.setattr(learn, "learners", lambda *a, **k: [(Counted(x), r) for x, r in real(*a, **k)])
    monkeypatch.setattr(vectors, "gaps_and_medians", lambda *a: learnt.append(1) or gaps(*a))
    stop = [20]
    with pytest.raises(RuntimeError):
        contest.run(events, actors, str(tmp_path), "62", edges, **options)
    half = len(fits)
    stop = [-1]
    found = contest.run(events, actors, str(tmp_path), "62", edges, **options)
    # two folds: five classes each of two sub-models, zones, balls and a forest
    assert half == 20 and len(fits) == 2 * (5 + 5 + len(v.ZONES) + len(v.BALLS) + 1)
    assert len(learnt) == 1
    again = contest.run(events, actors, str(tmp_path), "62", edges, **options)
    assert again["ran"] == [] and len(fits) == 2 * (5 + 5 + 13 + 8 + 1)
    rows = contest.submitted(events, found, edges)
    assert rows.count() == events.where("ball is null").count()
    for classes in (v.ZONES, v.BALLS):
        total = sum((F.col(c) for c in classes), F.lit(0.0))
        assert rows.where(F.abs(total - 1) > 1e-6).isEmpty()
    imp = spark.read.parquet(files.table_path(str(tmp_path), "importance_ball_boosted", "62", 0) + "/part=all")
    assert imp.columns == ["feat_name", "feat_imp_1", "feat_imp_2", "sum"]
    # another parameter undoes what follows from it: the forest alone and the ensemble
    changed = contest.run(events, actors, str(tmp_path), "62", edges,
                          **(options | {"params": options["params"] | {"forest": {"maxDepth": 2}}}))
    assert {s for s, _, _ in changed["ran"]} == {
        "model_ball_forest", "forecast_ball_forest", "submit_ball_forest", "submit_ball"}


def test_run_finds_rounds(spark, tmp_path):
    """Rounds by cross-validation of every fold and task, grown before the refit."""
    pl, _ = pitch_like(spark, SF_DIR)
    edges = edges_of(label_cut(spark, SF_DIR), 1) + [label_cut(spark, SF_DIR) - 1]
    job = contest.Run(pl.drop("own_fold", "pit_bat", "count_key"), player_like(spark, SF_DIR),
                      str(tmp_path), "62", edges[-1:], 2, 4)
    job.folds = [1]
    rows = spark.range(120).selectExpr("id as row_no", "1 as fold", "int(id % 3) as ball", "int(id % 3) as course",
                                       "double(id % 6) as x")
    table = vectors.store_vectors(rows, ["x"], list(v.LABELS), [1], str(tmp_path / "vec"))
    task = contest.Task("t", ["a", "b", "c"], ["x"], contest.direct("ball", ["x"]), max_rounds=3,
                        params={"maxDepth": 3}, growth=2.0)
    (score, found), = job.rounds(task, table, "d").values()
    assert score > 0 and found == 6
    models, _, mean = job.fitted(task, table, "d")
    assert mean == score and [m.getNumTrees for m in models(1)] == [6, 6, 6]


def test_broken_lines(spark, tmp_path):
    names = list(v.EVENT_COLUMNS)
    good = [",".join(["" if i else str(n) for i in range(len(names))]) for n in range(5)]
    bad = ["x" + good[0], good[1] + ",1,2", "7,8", good[2].replace("2,", "2.5,", 1)]
    for i, lines in enumerate((good[:3] + bad[:2], bad[2:] + good[3:])):
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"part{i}.csv").write_text("\n".join([",".join(names), *lines]) + "\n")
    rows, broken = files.read_events_checked(spark, str(tmp_path / "in"))
    assert sorted(r["row_no"] for r in rows.collect()) == [0, 1, 2, 3, 4]
    assert sorted((r["file"], r["line"]) for r in broken.collect()) == sorted(
        [("part0.csv", b) for b in bad[:2]] + [("part1.csv", b) for b in bad[2:]])
    assert len(rows.columns) == len(names)


def test_halving_finds_the_grid_s_best(spark, toy):
    train = toy.where("ball is not null")
    grid = {"maxDepth": [0, 1, 4], "minInstancesPerNode": [1, 60]}
    whole = learn.tune(train, ["x", "z"], "ball", ["a", "b", "c"], grid, rounds=2, parallelism=4).collect()
    found = learn.tune_halving(train, ["x", "z"], "ball", ["a", "b", "c"], grid, rounds=2,
                               parallelism=4).collect()
    assert len(found) == 6 and sorted({r["share"] for r in found}) == [0.25, 0.5, 1.0]
    assert found[0]["params"] in [r["params"] for r in whole if r["logloss"] == pytest.approx(whole[0]["logloss"])]
    assert found[0]["logloss"] == pytest.approx(whole[0]["logloss"])
    small = {r["row_no"] for r in learn.halves(train, 4).collect()}
    assert small < {r["row_no"] for r in learn.halves(train, 2).collect()}


def test_ranges_hold_large_and_small_parts(spark):
    """One part with most rows lies in many ranges, and ranks stay exact."""
    from foldcast.operators import ranks

    df = spark.range(3000).selectExpr("id", "if(id % 10 < 8, 0, id % 7) as part", "double(id * 7919 % 1009) as x")
    got = {(r["part"], r["x"]): (r["n"], r["n_before"], r["n_part"])
           for r in ranks.cumulative_counts(df, ["part"], "x", 16).collect()}
    want = {}
    rows = [(r["part"], r["x"]) for r in df.collect()]
    for p in {p for p, _ in rows}:
        own = [x for q, x in rows if q == p]
        for x in set(own):
            want[p, x] = (own.count(x), sum(y < x for y in own), len(own))
    assert got == want


def test_layout_by_key_needs_no_exchange(spark, tmp_path):
    """Fold averages and the ensemble of stored forecasts; folds may be appended one by one."""
    from foldcast.operators import forecast
    from foldcast.sources import layout

    rows = spark.range(200).selectExpr("id % 50 as row_no", "int(id div 50) + 1 as fold",
                                       "rand(1) as a", "rand(2) as b")
    rows = rows.checkpoint()
    paths = [f"{tmp_path}/{name}" for name in "pq"]
    layout.write_by_key(rows, paths[0], "row_no", 4)
    for k in range(1, 5):
        layout.write_by_key(rows.where(F.col("fold") == k), paths[1], "row_no", 4,
                            "overwrite" if k == 1 else "append")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        # a session that has lost its catalog
        spark.sql(f"drop table {layout._name(paths[1])}")
        p, q = (forecast.fold_average(layout.read_by_key(spark, x, "row_no", 4), ["a", "b"]) for x in paths)
        out = forecast.ensemble(p, q, ["a", "b"])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        got = {r["row_no"]: r for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    want = {r["row_no"]: r for r in forecast.fold_average(rows, ["a", "b"]).collect()}
    assert set(got) == set(want) and len(got) == 50
    assert all(got[n][c] == pytest.approx(want[n][c]) for n in want for c in "ab")


def test_events_are_joined_before_they_are_repeated(spark, monkeypatch):
    """The role joins see every event once, also as shuffled joins; the log is read once for all
    histories."""
    from foldcast.operators import joins, roles
    from foldcast.plans import features

    pl, edges = pitch_like(spark, SF_DIR)
    tables = features.role_tables(player_like(spark, SF_DIR), pl, edges)
    probes = []
    real = roles.sized_join
    monkeypatch.setattr(roles, "sized_join", lambda df, *a, **k: probes.append(df.count()) or real(df, *a, **k))
    out = roles.join_roles_by_fold(pl, tables, ["year", "pit_bat"], edges, ["row_no"])
    n = pl.count()
    assert probes == [n, n, n] and out.count() > 3 * n
    lattice = features.labelled_lattice(pl, edges)
    scans = lattice._jdf.queryExecution().executedPlan().toString().count("Scan parquet")
    assert scans == 1 and joins.BROADCAST_BYTES > 0


def test_lookups_follow_the_log(spark, monkeypatch):
    """Actors that no event has are in no lookup; broadcast and shuffled joins give the same rows."""
    from foldcast.operators import joins, roles
    from foldcast.plans import features

    pl, edges = pitch_like(spark, SF_DIR)
    actors = player_like(spark, SF_DIR)
    tables = features.role_tables(actors, pl, edges)
    mix = pl.groupBy("strike_cnt").agg(F.count("*").alias("seen"))
    narrow, held, real = pl.select("row_no", "year", "pit_bat", *features.ROLE_IDS.values()), [], roles.sized_join
    monkeypatch.setattr(roles, "sized_join", lambda df, side, size, on, *a, **k: (
        held.append((list(on), side.count())), real(df, side, size, on, *a, **k))[1])

    def joined(**more):
        out = roles.join_roles_by_fold(pl, tables, ["year", "pit_bat"], edges, ["row_no"], **more)
        columns = sorted({*out.columns} - {"seen"})
        return out, sorted(r[0] for r in out.select(F.xxhash64(*columns)).collect())

    _, want = joined()
    held.clear()
    more = dict(narrow=narrow, more=[(["strike_cnt"], mix)], near=True)
    out, got = joined(**more)
    assert got == want and out.where("seen is null").isEmpty()
    for on, n in held:
        assert n <= pl.select(*on).distinct().count()
    at = [r["fold"] for r in out.where(F.spark_partition_id() == 0).collect()]
    assert at == sorted(at) and len(set(at)) > 1
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(roles, "BROADCAST_BYTES", 0)
    out, got = joined(**more)
    assert got == want and out.where("seen is null").isEmpty()


def test_partitioned_write_keeps_files_open(spark, tmp_path, monkeypatch):
    """Wide rows are not sorted only to part them, and the session's setting comes back."""
    from pyspark.sql import DataFrameWriter

    seen, real = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path: (
        seen.append(spark.conf.get(files.WRITERS)), real(self, path))[1])
    before = spark.conf.get(files.WRITERS)
    for folds in (4, 2 * files.OPEN_FILES):
        df = spark.range(1000).selectExpr("id", f"int(id % {folds}) as fold").coalesce(1)
        path = str(tmp_path / f"{folds}")
        files.write_table(df, path, ["fold"])
        back = spark.read.parquet(path)
        assert sorted(map(tuple, back.select("id", "fold").collect())) == [(i, i % folds) for i in range(1000)]
        names = [n for k in range(folds) for n in (tmp_path / f"{folds}" / f"fold={k}").glob("*.parquet")]
        assert len(names) == folds and all(".zstd." in n.name for n in names)
    assert seen == [str(files.OPEN_FILES)] * 2 and spark.conf.get(files.WRITERS) == before


def test_broken_lines_keep_one_header_a_file(spark, tmp_path):
    """Several files in one task, and a part of a file without its header."""
    from foldcast.queries.tables import break_lines

    names = list(v.EVENT_COLUMNS)
    kinds = [t for _, t in v.EVENT_COLUMNS.values()]
    head = ",".join(names)
    for i in range(30):
        line = ",".join(str(i) if k == 0 else "1" if t in ("bigint", "int") else "" for k, t in enumerate(kinds))
        lines = [line] if i % 3 == 0 else [head, line]
        (tmp_path / "in").mkdir(exist_ok=True)
        (tmp_path / "in" / f"part{i:02}.csv").write_text("\n".join(lines) + "\n")
    break_lines(spark.read.text(str(tmp_path / "in")).coalesce(1), str(tmp_path / "out"))
    written = [p.read_text().splitlines() for p in (tmp_path / "out").glob("*.csv")]
    assert written and all(x[0] == head and head not in x[1:] for x in written)
    rows, broken = files.read_events_checked(spark, str(tmp_path / "out"))
    assert sorted(r["row_no"] for r in rows.collect()) == [i for i in range(30) if i not in (7, 8)]
    assert sorted(r["line"].split(",")[:2] for r in broken.collect()) == [["7", "word"], ["8", "1"]]
