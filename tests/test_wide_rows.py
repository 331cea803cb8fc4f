"""What wide rows cost: rounding without decimals, joins that carry few columns, lookups that follow the log."""

import math
import random

from pyspark.sql import functions as F

from foldcast.operators import roles
from foldcast.queries import actors
from foldcast.queries.registry import nearest, rounded

SF_DIR = "/root/testdata/sf0.001"


def test_rounding_is_the_same_to_the_bit(spark):
    dealt = random.Random(7)
    values = [None, 0.0, -0.0, math.nan, math.inf, -math.inf, 5e-7, -5e-7, 4.9e-7, -4e-7, 1 / 128, -1 / 128,
              1.0000005, 1.0000015, 0.1234565, 123456.1234565, 499999999.9999995, 1e9 + 1e-6, 1e15 / 3, 1e20,
              -1e300, 5e-324]
    values += [dealt.uniform(-1, 1) * 10 ** dealt.randint(-8, 14) for _ in range(3000)]
    values += [(2 * dealt.randint(0, 10 ** 9) + 1) / 2e6 for _ in range(2000)]  # halves of the last digit
    rows = spark.createDataFrame([(x,) for x in values], "x double")
    found = rows.selectExpr("round(x, 6) as a", f"{nearest('x', 6)} as b", "round(x, 2) as c",
                            f"{nearest('x', 2)} as d").collect()
    assert [(repr(r.b), repr(r.d)) for r in found] == [(repr(r.a), repr(r.c)) for r in found]
    assert rounded(rows.withColumn("n", F.lit(3))).dtypes == [("x", "double"), ("n", "int")]


def join_widths(plan) -> list[int]:
    """Columns that leave each join of an optimized plan."""
    own = [plan.output().size()] if plan.nodeName() == "Join" else []
    below = plan.children()
    return own + [n for i in range(below.size()) for n in join_widths(below.apply(i))]


def test_joins_carry_structs(spark):
    many = [f"c{i}" for i in range(40)]
    events = spark.range(8).selectExpr(
        "id as row_no", "if(id = 5, null, id % 3) as pit", "id % 2 as bat", "2024 as year", "'x' as k",
        *[f"id * {i} as {c}" for i, c in enumerate(many)])
    table = spark.range(2).selectExpr("id as player_id", "2024 as year", "explode(array(1, 2)) as fold",
                                      "id * 10 + 1 as a", "id * 10 + 2 as b")
    more = spark.sql("select 'x' as k, 1.5D as m, 2.5D as n")
    for near in (False, True):
        out = roles.join_roles_by_fold(
            events, {"_p": ("pit", table), "_b": ("bat", table)}, ["year"], [3, 7], ["row_no"],
            events.select("row_no", "pit", "bat", "year"), [(["k"], more)], near=near)
        assert out.columns == [*events.columns, "m", "n", "fold", "a_p", "b_p", "a_b", "b_b"]
        found = {r["row_no"]: r for r in out.collect()}
        assert len(found) == out.count() == 8  # of two folds, each row is of one
        for i, r in found.items():
            pit = None if i == 5 or i % 3 == 2 else i % 3
            assert r["fold"] == (2 if i <= 3 else 1) and r["c7"] == 7 * i and (r["m"], r["n"]) == (1.5, 2.5)
            assert (r["a_p"], r["b_p"]) == ((None, None) if pit is None else (pit * 10 + 1, pit * 10 + 2))
            assert (r["a_b"], r["b_b"]) == (i % 2 * 10 + 1, i % 2 * 10 + 2)
        widths = join_widths(out._jdf.queryExecution().optimizedPlan())
        assert len(widths) >= 3 and max(widths) < 20  # the 40 columns go through as one


def test_pair_combine_looks_up_the_logs_actors_alone(spark, monkeypatch):
    held = []
    stored_arrays = roles.stored_arrays
    monkeypatch.setattr(roles, "stored_arrays", lambda *a: held.append(stored_arrays(*a)) or held[-1])
    out = actors.pair_combine_(spark, SF_DIR)
    log = spark.read.parquet(f"{SF_DIR}/events.parquet")
    users = {r[0] for r in log.select("user_id").distinct().collect()}
    pitchers = next(t for t, _ in held if "pitcher_id" in t.columns)
    assert {r[0] for r in pitchers.select("pitcher_id").collect()} <= users
    assert out.count() == log.count() * 13 // 4  # three quarters have a fold of their own
