import re

import numpy as np
import pytest
import xxhash

from foldcast.llm import queries, simhash

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def print_of(text):
    words = WORD.findall((text or "").translate(LOWER))
    grams = [words[i:i + 3] for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(" ".join(g).encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, ids):
    """Smallest id of each row's component, by all pairs."""
    different = sorted(set(prints))
    root = {p: p for p in different}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for i, a in enumerate(different):
        for b in different[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for p, d in zip(prints, ids):
        if d is not None:
            least[find(p)] = min(d, least.get(find(p), d))
    return [least.get(find(p)) for p in prints]


def test_query(spark):
    docs = queries.documents(spark, SF_DIR).collect()
    want_prints = [print_of(r["text"]) for r in docs]
    ids = [r["doc_id"] for r in docs]
    want = {d: (f"{p:016x}", c) for d, p, c in zip(ids, want_prints, groups(want_prints, ids))}
    rows = queries.op11(spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == want
    assert len(rows) == len(docs)


def test_odd_rows(odd_docs, no_docs):
    rows = odd_docs.collect()
    prints = [print_of(r["text"]) for r in rows]
    want = sorted(zip([str(r["doc_id"]) for r in rows], prints,
                      groups(prints, [r["doc_id"] for r in rows])), key=str)
    out = simhash.near_duplicates(odd_docs)
    assert out.columns == [c for c in odd_docs.columns if c != "text"] + ["fingerprint", "component_id"]
    got = [(str(r["doc_id"]), r["fingerprint"] % (1 << 64), r["component_id"]) for r in out.collect()]
    assert sorted(got, key=str) == want
    assert simhash.near_duplicates(no_docs).collect() == []


def crowd(seed, n):
    """Fingerprints around a few centres, and unrelated ones."""
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    out = centres[rng.integers(0, 4, n)]
    for _ in range(5):
        out ^= np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)
    return np.r_[out, rng.integers(0, 1 << 63, n, dtype=np.uint64)]


@pytest.mark.parametrize("bucket", [7, 1 << 14])
def test_large_buckets(spark, bucket):
    """A bucket over the bound is dealt into pairs of blocks and loses no link."""
    values = np.unique(crowd(3, 300)).tolist()
    ids = list(range(len(values)))
    prints = spark.createDataFrame(
        [(d, p - (1 << 64) if p >> 63 else p) for d, p in zip(ids, values)],
        "doc_id long, fingerprint long")
    got = {r["fp"] % (1 << 64): r["component_id"] for r in simhash.components(prints, bucket).collect()}
    assert got == dict(zip(values, groups(values, ids)))
    assert len(set(got.values())) < len(values)


def test_tables_cover_the_radius():
    """Any three flipped bits leave some table's bits alone, for every number of fingerprints."""
    rng = np.random.default_rng(1)
    for count in (0, 10**4, 10**8, 10**12):
        masks = simhash.tables(count)
        for _ in range(2000):
            flips = 0
            for b in rng.integers(0, 64, simhash.RADIUS):
                flips |= 1 << int(b)
            assert any(not m & flips for m in masks)
    assert len(simhash.tables(10**12)) > len(simhash.tables(10**4)) == 4


def test_forest_is_a_forest():
    values = np.unique(crowd(5, 500))
    left, right = simhash.forest(values, np.full(len(values), len(values)))
    whole = groups(values.tolist(), list(range(len(values))))
    assert len(left) == len(values) - len(set(whole))
    assert all((int(values[a]) ^ int(values[b])).bit_count() <= 3 for a, b in zip(left, right))
