"""Every stage against a brute-force version of its own input."""

import collections
import hashlib

from pyspark.sql import functions as F

import corpus_pipeline
from foldcast.llm import neardup
from foldcast.llm.scratch import kept
from tests.llm.test_operators import WORD, brute_classes, drop_lines, library, targets


def test_stages(spark, odd_docs, no_docs):
    stages = dict(corpus_pipeline.STAGES)
    docs = odd_docs.withColumn("n_chars", F.length("text").cast("long"))
    columns = docs.columns

    ruled = kept(stages["quality rules"](spark, docs, ""), "t")
    assert ruled.columns == columns
    rows = ruled.collect()
    before = collections.Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert not collections.Counter((r["doc_id"], r["text"]) for r in rows) - before
    for r in rows:
        words = WORD.findall(r["text"] or "")
        windows = collections.Counter(zip(words, words[1:], words[2:]))
        again = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1
                 for j in range(i, i + 3)}
        assert len(words) >= 50 and 2 * len(again) <= len(words)
    assert {r["doc_id"] for r in rows} >= {100 + i for i in range(40)}

    cut = kept(stages["line dedup"](spark, ruled, ""), "t")
    assert cut.columns == columns
    want = drop_lines([(r["doc_id"], r["text"]) for r in rows], 10)
    got = cut.collect()
    assert collections.Counter((r["doc_id"], r["text"]) for r in got) == collections.Counter(
        {(d, t): n for (d, t, _), n in want.items()})
    assert all(r["n_chars"] == len(r["text"]) and "Shared line" not in r["text"] for r in got)

    one = kept(stages["near dedup"](spark, cut, ""), "t")
    assert one.columns == columns
    brute = brute_classes([(r["doc_id"], r["text"]) for r in got], neardup.learn_weights(cut), 0.8)
    assert collections.Counter(brute[r["text"]] for r in one.collect()) == collections.Counter(
        set(brute.values()))

    mixed = kept(stages["mix"](spark, one, ""), "t")
    assert mixed.columns == columns
    size, taken = collections.Counter(), collections.Counter()
    for r in one.collect():
        size[r["source"]] += len(WORD.findall(r["text"]))
    for r in mixed.collect():
        taken[r["source"]] += len(WORD.findall(r["text"]))
    order = sorted(s for s in size if s is not None) + ([None] if None in size else [])
    goal = targets(size, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
    assert all(abs(taken[s] - goal[s]) <= 200 for s in size)

    tokenizer = library()
    texts = {r["doc_id"]: r["text"] for r in mixed.collect()}
    coded = stages["encode"](spark, mixed, "").collect()
    assert len(coded) == mixed.count()
    for r in coded:
        ids = tokenizer.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["ids"] == ids and r["n_tokens"] == len(ids)
        text = tokenizer.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()

    empty = no_docs.withColumn("n_chars", F.lit(0).cast("long"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        empty = kept(stage(spark, empty, ""), "t")
        assert empty.count() == 0 and set(empty.columns) == {*no_docs.columns, "n_chars"}
    assert corpus_pipeline.STAGES[-1][1](spark, empty, "").count() == 0
