import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from foldcast.llm import merkle, queries

SF_DIR = "/root/testdata/sf0.001"
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return digest("".join("-" if x is None else f"{len(str(x).encode())}:{x}" for x in values))


def tree(nodes):
    """Top of a tree and, for every leaf, the siblings before and after it on each level."""
    floors = [nodes]
    while len(floors[-1]) > 1:
        below = floors[-1]
        floors.append([digest("".join(below[i:i + 3])) for i in range(0, len(below), 3)])
    proofs = []
    for i in range(len(nodes)):
        steps = []
        for floor in floors[:-1]:
            first = i - i % 3
            steps.append((floor[first:i], floor[i + 1:first + 3]))
            i //= 3
        proofs.append(steps)
    return floors[-1][0], proofs


def answer(rows):
    """doc_id, leaf, subroot, root and steps of every row."""
    sources = {}
    for r in rows:
        sources.setdefault(r["source"], []).append(r)
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    tops, out = [], []
    for s in order:
        own = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf_of([r[c] for c in FIELDS])), r["doc_id"])
                     for r in sources[s])
        top, proofs = tree([k[2] for k, _ in own])
        tops.append(top)
        out.append([(d, k[2], top, p) for (k, d), p in zip(own, proofs)])
    root, above = tree(tops)
    return [(d, x, top, root, p + a) for rows, a in zip(out, above) for d, x, top, p in rows]


def steps_of(row):
    return [(s["before"], s["after"]) for s in row["proof"]]


@pytest.mark.parametrize("height", [1, 2, 7])
def test_manifest(spark, odd_docs, no_docs, height):
    """Blocks of three leaves need several rounds; sources of all sizes, ragged ends."""
    more = spark.range(77).selectExpr("id as doc_id", "'t' || id as text", "'en' as lang",
                                      "if(id < 50, 'big', 's' || id) as source")
    docs = odd_docs.unionByName(more, allowMissingColumns=True).withColumn("n_chars", F.length("text"))
    want = answer(docs.collect())
    rows = merkle.manifest(docs, height=height).collect()
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], steps_of(r)) for r in rows]
    flat = [(d, x, s, r, [("".join(b), "".join(a)) for b, a in p]) for d, x, s, r, p in want]
    assert sorted(got, key=str) == sorted(flat, key=str)
    assert merkle.manifest(no_docs.withColumn("n_chars", F.lit(1)), height=height).collect() == []


def test_fold_finds_changes(odd_docs):
    docs = odd_docs.withColumn("n_chars", F.length("text"))
    changed = {"text": F.when(F.col("doc_id") == 100, F.lit("other")).otherwise(F.col("text"))}
    rows = merkle.manifest(docs, changed, height=2).select(
        "*", merkle.fold(F.col("changed_leaf"), F.col("proof")).alias("folded")).collect()
    assert {r["doc_id"] for r in rows if r["folded"] != r["root"]} == {100}


def test_query(spark):
    docs = queries.documents(spark, SF_DIR).collect()
    text = {r["doc_id"]: r for r in docs}
    rows = {r["doc_id"]: r for r in queries.op13(spark, SF_DIR).collect()}
    assert len(rows) == len(docs)
    for d, leaf, subroot, root, proof in answer(docs):
        r, own = rows[d], text[d]
        node = leaf
        if own["text"] is not None and zlib.crc32(str(d).encode()) % 2 == 0:
            node = leaf_of([*[own[c] for c in FIELDS[:-1]], own["text"].replace("\n", "")])
        for before, after in proof:
            node = digest("".join(before) + node + "".join(after))
        assert (r["leaf"], r["subroot"], r["root"]) == (leaf, subroot, root)
        assert r["proof_sha256"] == digest("".join(x for b, a in proof for x in b + a))
        assert r["folded_root"] == node and r["verified"] == (node == root)
