import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from foldcast.llm import queries, runs

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words):
    """All runs, by every period."""
    found = []
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(24, 3 * q) and not any(
                    s <= i and s + n >= j + q for s, n, _ in found):
                found.append((i, j - i + q, q))
            i = max(j, i + 1)
    return sorted(found, key=lambda r: (r[0], r[2]))


def planted(doc_id, words):
    mark = zlib.crc32(str(doc_id).encode())
    n, g = len(words), mark // 10
    if mark % 10 or not n or doc_id is None:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(n - a)]


def collapsed(words, found):
    dropped = {i for s, n, q in found for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def answer(doc_id, text):
    words = planted(doc_id, WORD.findall(text or ""))
    found = brute(words)
    best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
    told = "".join(f"{s},{n},{q}\n" for s, n, q in found)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (doc_id, len(found), *best, milli, digest(told), digest(collapsed(words, found)))


def test_query(spark):
    docs = queries.documents(spark, SF_DIR).collect()
    want = {r["doc_id"]: answer(r["doc_id"], r["text"]) for r in docs}
    rows = queries.op12(spark, SF_DIR)
    assert rows.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli",
                            "runs_sha256", "collapsed_sha256"]
    got = {r["doc_id"]: tuple(r) for r in rows.collect()}
    assert got == want and sum(r[1] for r in want.values()) > 10


def test_odd_rows(odd_docs, no_docs):
    out = runs.periodic_runs(odd_docs)
    assert out.columns == [*odd_docs.columns, "runs", "collapsed"]
    rows = out.collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        words = WORD.findall(r["text"] or "")
        if len(words) < 2000:
            found = brute(words)
            assert [tuple(x) for x in r["runs"]] == found
            assert r["collapsed"] == collapsed(words, found)
        else:  # the long text has a period of eleven words
            assert [tuple(x) for x in r["runs"]] == [(0, len(words), 11)]
    assert runs.periodic_runs(no_docs).collect() == []


def test_planting(spark):
    rows = [(i, " ".join(random.Random(i).choices("abc", k=i % 90))) for i in range(200)]
    docs = spark.createDataFrame([*rows, (None, "a b"), (7, None)], "doc_id long, text string")
    got = queries.with_planted_runs(docs).select("doc_id", F.coalesce("text", F.lit(""))).collect()
    texts = dict(rows) | {None: "a b"}
    seen = 0
    for doc_id, text in got:
        if text == "" and doc_id == 7:
            continue
        want = planted(doc_id, texts[doc_id].split()) if doc_id is not None else ["a", "b"]
        assert text.split() == want
        seen += want != texts[doc_id].split()
    assert seen > 5


def made(dice):
    n, kinds = dice.choice([0, 5, 24, 100, 300, 600]), dice.choice([1, 2, 3, 5, 50])
    out = [dice.randrange(kinds) for _ in range(n)]
    for _ in range(dice.randrange(4) if n > 3 else 0):
        unit = [dice.randrange(kinds) for _ in range(dice.randrange(1, max(2, n // 3)))]
        if dice.random() < 0.3:
            unit = [0] * (len(unit) - 1) + [1]
        if dice.random() < 0.3:
            unit = unit[:max(1, len(unit) // 4)] * 4 + [7]
        length = dice.randrange(1, n)
        at = dice.randrange(0, n - length + 1)
        out[at:at + length] = (unit * (length // len(unit) + 1))[:length]
    return out


def test_random_sequences():
    dice = random.Random(1)
    for _ in range(120):
        texts = [made(dice) for _ in range(dice.randrange(1, 6))]
        codes, ends, want = [], [], []
        for k, t in enumerate(texts):
            want += [(s + len(codes), n, q) for s, n, q in brute(t)]
            codes += [*t, 1000 + k]
            ends.append(len(codes) - 1)
        got = runs.runs_of(np.array(codes, np.int64), np.array(ends))
        assert list(zip(*[x.tolist() for x in got])) == sorted(want, key=lambda r: (r[0], r[2]))


def test_transform():
    rng = np.random.default_rng(2)
    rows = rng.integers(0, runs.PRIME, (3, 64)).astype(np.uint64)
    assert (runs.backward(runs.forward(rows)) == rows).all()
    blocks = rng.integers(0, 2, (20, 8)).astype(np.uint64)
    windows = rng.integers(0, 2, (20, 22)).astype(np.uint64)
    got = set(zip(*[x.tolist() for x in runs.matches(blocks, windows)]))
    assert got == {(b, k) for b in range(20) for k in range(15)
                   if (windows[b, k:k + 8] == blocks[b]).all()}


def test_multiple_of_the_prime_does_no_harm(monkeypatch):
    """With a prime that small sums reach, false places are found and dropped again."""
    monkeypatch.setattr(runs, "PRIME", 97)
    monkeypatch.setattr(runs, "GENERATOR", 5)
    runs._roots.cache_clear()
    dice = random.Random(4)
    try:
        for _ in range(60):
            # 97 has roots of unity up to the order 32 only: one scale
            t = [dice.randrange(12) for _ in range(20)] + [3, 9, 4] * dice.randrange(2, 12)
            got = runs.runs_of(np.array([*t[:47], 999], np.int64), np.array([len(t[:47])]))
            assert list(zip(*[x.tolist() for x in got])) == brute(t[:47])
    finally:
        runs._roots.cache_clear()


def test_long_texts_stay_fast():
    import time

    began = time.perf_counter()
    for words in (np.zeros(100_000), np.tile(np.r_[np.zeros(1000), 1], 100), np.arange(100_000) % 777):
        codes = np.r_[words.astype(np.int64), 10**6]
        assert len(runs.runs_of(codes, np.array([len(words)]))[0]) >= 1
    assert time.perf_counter() - began < 60
