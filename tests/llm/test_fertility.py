"""Bands of fertility: brute force, thin classes, rare languages, and the base rules by SQL."""

import collections
import math

import duckdb
import pytest

from foldcast.llm import fertility, queries
from foldcast.llm.queries import PIECES, vocabulary
from foldcast.llm.scratch import kept
from tests.llm.conftest import SCHEMA, sentence

SF_DIR = "/root/testdata/sf0.001"


def verdicts(spark, rows):
    measured = kept(fertility.measure(spark.createDataFrame(rows, SCHEMA), vocabulary(PIECES)), "t")
    return {r["doc_id"]: r for r in fertility.verdicts(measured).collect()}


def usual(n, lang="en", start=0):
    return [(start + i, sentence(i, 120 + i % 9), lang, "s") for i in range(n)]


def junk(k):
    return " ".join(f"q{j}zx$$$###%%%{k}" for j in range(130))


def test_junk_under_a_rare_code(spark):
    out = verdicts(spark, usual(150) + [(900 + i, junk(i), "qq", "s") for i in range(3)]
                   + [(950, junk(7), None, "s")])
    assert not any(out[i]["kept"] for i in (900, 901, 902, 950))
    assert sum(out[i]["kept"] for i in range(150)) >= 147


def test_usual_texts_under_a_rare_code_stay(spark):
    out = verdicts(spark, usual(150) + usual(4, "xx", 500))
    assert all(out[500 + i]["kept"] for i in range(4))


def test_no_switch_at_a_number_of_texts(spark):
    """One more text of a class moves its bands a little and flips no verdict."""
    many = usual(120, "de", 1000)
    found = {}
    for n in (48, 49, 50, 51):
        rows = many + usual(n) + [(900, junk(0), "en", "s")]
        found[n] = {d: r["kept"] for d, r in verdicts(spark, rows).items()}
    for n in (49, 50, 51):
        assert all(found[n][d] == k for d, k in found[n - 1].items())
    assert not found[51][900]


def middles(values):
    """Quartiles as the least value that so many are not above, median and narrower half."""
    values = sorted(values)
    q = [values[max(0, math.ceil(p * len(values)) - 1)] for p in (0.25, 0.5, 0.75)]
    return q[1], min(q[2] - q[1], q[1] - q[0])


def pooled(parts, apart):
    n = sum(p[0] for p in parts)
    m = sum(k * x for k, x, _ in parts) / n
    h = sum(k * y for k, _, y in parts) / n
    if apart:
        h += 0.6745 * math.sqrt(max(0, sum(k * x * x for k, x, _ in parts) / n - m * m))
    return n, m, h


def test_bands_by_brute_force(spark):
    rows = [(f"g{i % 7 % 3}", i * i % 5, 3 + i % 11 / 7, i % 4 / 9, 5 + i % 13 / 3) for i in range(90)]
    df = spark.createDataFrame(rows, "_group string, _class int, _chars double, _bytes double, _entropy double")
    got = {(r["_group"], r["_class"]): r for r in fertility.bands(df).collect()}
    for at, value in enumerate(fertility.VALUES):
        classes, languages = collections.defaultdict(list), collections.defaultdict(list)
        for r in rows:
            classes[r[0], r[1]].append(r[2 + at])
            languages[r[0]].append(r[2 + at])
        fine = {k: (len(x), *middles(x)) for k, x in classes.items()}
        whole = {k: (len(x), *middles(x)) for k, x in languages.items()}
        assert set(got) == set(fine)
        every = pooled(list(whole.values()), True)
        for (g, c), own in fine.items():
            near = pooled([p for (a, b), p in fine.items() if a == g and abs(b - c) <= 1], False)
            alike = pooled([p for (_, b), p in fine.items() if b == c], True)
            for name, i in (("m", 1), ("h", 2)):
                want = every[i]
                for level in (alike, whole[g], near, own):
                    want = (level[0] * level[i] + fertility.WEIGHT * want) / (level[0] + fertility.WEIGHT)
                assert got[g, c][f"{value}_{name}"] == pytest.approx(want)


BASE_SQL = r"""
with w as (select doc_id, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
win as (
  select doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as k
  from w, unnest(range(1, greatest(len(ws) - 1, 1))) as r(i)),
often as (select *, count(*) over (partition by doc_id, k) as n from win),
cover as (select doc_id, count(distinct i + j) as n_repeat_words from often, (values (0), (1), (2)) as s(j)
  where n > 1 group by doc_id),
l as (select doc_id, unnest(string_split(text, chr(10))) as line from w),
dup as (select doc_id, sum(n - 1) as n_dup_lines from (
    select doc_id, line, count(*) as n from l where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1, 2)
  group by 1)
select w.doc_id, len(ws) as n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) as word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols, coalesce(n_dup_lines, 0) as n_dup_lines,
  coalesce(n_repeat_words, 0) as n_repeat_words,
  len(ws) < 50 or 100 * coalesce(n_repeat_words, 0) > 50 * len(ws) as base_failed
from w left join cover using (doc_id) left join dup using (doc_id)"""


def test_query_base_columns(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    result = con.execute(BASE_SQL)
    names = [c[0] for c in result.description]
    want = {r[0]: tuple(int(x) for x in r[1:]) for r in result.fetchall()}
    rows = queries.op9(spark, SF_DIR).collect()
    assert {r["doc_id"]: tuple(int(r[n]) for n in names[1:]) for r in rows} == want
    assert not any(r["kept"] and r["base_failed"] for r in rows) and any(r["kept"] for r in rows)
