"""Chunked windows against pandas, with groups that span many chunks."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from foldcast.operators import sequence
from foldcast.operators.sequence import Group, along_groups, lag_diff


def log(n=600, seed=1):
    rng = np.random.default_rng(seed)
    game = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 6, n)).astype(float)
    game[rng.random(n) < 0.05] = np.nan
    return pd.DataFrame({
        "row_no": np.arange(n), "game": game, "bat": rng.integers(0, 3, n),
        "x": rng.integers(0, 50, n).astype(float),
    })


def spark_log(spark, pdf):
    rows = [(int(r), None if np.isnan(g) else int(g), int(b), float(x))
            for r, g, b, x in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, "row_no bigint, game int, bat int, x double").repartition(7)


def by_row(df, cols):
    out = {}
    for r in df.select("row_no", *cols).collect():
        out[r["row_no"]] = [np.nan if r[c] is None else float(r[c]) for c in cols]
    return np.array([out[i] for i in sorted(out)])


@pytest.mark.parametrize("chunk_rows", [16, 100, 10_000])
@pytest.mark.parametrize("max_bytes", [0, 1 << 30])
def test_spanning_groups(spark, monkeypatch, chunk_rows, max_bytes):
    monkeypatch.setattr(sequence, "BROADCAST_BYTES", max_bytes)
    pdf = log()
    out = along_groups(spark_log(spark, pdf), "row_no", [
        Group(["game"], stats={"lo": ("min", "x"), "n": ("count", "x")}, previous={"before": "x"}),
        Group(["game", "bat"], stats={"hi": ("max", "x"), "s": ("sum", "x")},
              previous={"b2": "x"}),
    ], chunk_rows=chunk_rows)
    g, gb = pdf.groupby("game")["x"], pdf.groupby(["game", "bat"])["x"]
    want = np.column_stack([
        g.transform("min"), g.transform("count"), g.shift(), gb.transform("max"),
        gb.transform("sum"), gb.shift()])
    got = by_row(out, ["lo", "n", "before", "hi", "s", "b2"])
    np.testing.assert_allclose(got, want)


def test_lag_diff_options(spark):
    pdf = log(200, seed=3)
    df = spark_log(spark, pdf)
    diff = pdf.groupby("game")["x"].diff()
    plain = lag_diff(df, "x", ["game"], "row_no", "d", chunk_rows=32)
    np.testing.assert_allclose(by_row(plain, ["d"])[:, 0], diff)
    filled = lag_diff(df, "x", ["game"], "row_no", "d", fill=1.0, chunk_rows=32)
    np.testing.assert_allclose(by_row(filled, ["d"])[:, 0], diff.fillna(1.0))
    cut = lag_diff(df, "x", ["game"], "row_no", "d", boundary=F.col("bat") == 1, chunk_rows=32)
    np.testing.assert_allclose(by_row(cut, ["d"])[:, 0], diff.where(pdf["bat"] != 1))


def test_many_chunks_and_no_spanning_group(spark):
    df = spark.range(100).selectExpr("id as row_no", "cast(id div 10 as int) as game", "id as x")
    out = along_groups(df, "row_no", [Group(["game"], stats={"lo": ("min", "x")},
                                            previous={"a": "x"})], chunk_rows=20)
    got = {r["row_no"]: (r["lo"], r["a"]) for r in out.collect()}
    assert got == {i: (i // 10 * 10, None if i % 10 == 0 else i - 1) for i in range(100)}


def test_one_wide_shuffle(spark):
    df = spark.range(1000).selectExpr("id as row_no", "id % 5 as game", "id % 7 as bat", "id as x")
    out = along_groups(df, "row_no", [
        Group(["game"], stats={"lo": ("min", "x")}, previous={"a": "x"}),
        Group(["game", "bat"], stats={"hi": ("max", "x")}, previous={"b": "x"}),
    ])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_input_is_evaluated_twice(spark):
    """Once for the summary of all groups and once for the rows, with groups that span chunks."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    src = spark.range(400).selectExpr("id as no", "id div 90 as g", "id div 30 as h", "id * 7 % 13 as x")
    df = src.mapInArrow(count, src.schema)
    out = sequence.along_groups(df, "no", [
        sequence.Group(["g"], stats={"most": ("max", "x")}, previous={"px": "x"}),
        sequence.Group(["g", "h"], stats={"n": ("count", "x"), "least": ("min", "x")}, previous={"hx": "x"}),
    ], chunk_rows=16)
    rows = out.collect()
    assert len(rows) == 400 and seen.value == 800
    x = {r["no"]: r["x"] for r in rows}
    for r in rows:
        own = [i for i in range(400) if i // 90 == r["g"]]
        fine = [i for i in own if i // 30 == r["h"]]
        assert r["most"] == max(x[i] for i in own) and r["n"] == len(fine)
        assert r["least"] == min(x[i] for i in fine)
        assert r["px"] == (x[r["no"] - 1] if r["no"] - 1 in own else None)
        assert r["hx"] == (x[r["no"] - 1] if r["no"] - 1 in fine else None)


def test_tasks_follow_the_rows(spark, monkeypatch):
    """Rows that compress to next to nothing are dealt by their number, not by their bytes."""
    monkeypatch.setattr(sequence, "TASK_ROWS", 100)
    df = spark.range(4000).selectExpr("id as row_no", "id div 50 as g", "1 as x")
    out = sequence.along_groups(df, "row_no", [sequence.Group(["g"], stats={"n": ("sum", "x")},
                                                              previous={"before": "row_no"})])
    assert out.rdd.getNumPartitions() == 40
    rows = out.collect()
    assert {(r["row_no"], r["n"], r["before"]) for r in rows} == {
        (i, 50, None if i % 50 == 0 else i - 1) for i in range(4000)}
