"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return con


def canonical(rows):
    tidy = [tuple(round(x, 5) + 0.0 if isinstance(x, float) else x for x in r) for r in rows]
    return sorted(tidy, key=lambda r: tuple((x is None, "" if x is None else x) for x in r))


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF_DIR)
    cols = sorted(df.columns)
    result = duck.execute(contract.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in result.description}
    names = [c[0] for c in result.description]
    assert sorted(names) == cols
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    want = canonical(tuple(r[names.index(c)] for c in cols) for r in result.fetchall())
    got = canonical(tuple(r[c] for c in cols) for r in df.collect())
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == pytest.approx(w, abs=2e-5) if all(x is not None for x in g) else g == w


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
