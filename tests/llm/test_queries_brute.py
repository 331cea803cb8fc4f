"""Queries without SQL against plain versions, on the smallest tables."""

import collections
import hashlib
import math
import re
import zlib

import pytest

from foldcast.llm import labelled, langid, neardup, queries, rules
from foldcast.llm.scratch import kept
from tests.llm.test_operators import brute_classes, library

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def docs(spark):
    return queries.documents(spark, SF_DIR).orderBy("doc_id").collect()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op1(spark, docs):
    rows = {r["doc_id"]: r for r in queries.op1(spark, SF_DIR).collect()}
    slots = collections.defaultdict(list)
    for d in docs:
        r, text = rows[d["doc_id"]], (d["text"] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(text) + 8, zlib.crc32(text))
        assert (r["law"], r["grown_shard"]) == ("rows", None)
        slots[r["shard"]].append(r["slot"])
    assert set(slots) <= set(range(24)) and len(rows) == len(docs)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(24)]
    assert max(sizes) - min(sizes) <= 1


def test_op2(spark, docs):
    rows = {r["doc_id"]: r for r in queries.op2(spark, SF_DIR).collect()}
    prints = {}
    for i, d in enumerate(docs):
        text, after = d["text"] or "", docs[(i + 1) % len(docs)]["text"] or ""
        last = len(text) // 4
        edited = text[:len(text) - last] + after[:last]
        r = rows[d["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), sha(edited))
        assert 0 <= r["near_next"] <= 1 and 0 <= r["near_edited"] <= 1
        assert prints.setdefault(text, r["fingerprint"]) == r["fingerprint"]
        if edited == text:
            assert r["edited_fingerprint"] == r["fingerprint"] and r["near_edited"] == 1
        nxt = rows[docs[(i + 1) % len(docs)]["doc_id"]]
        assert (r["near_next"] == 1) >= (r["fingerprint"] == nxt["fingerprint"] != "")
    # an edit of a quarter leaves more alike than another text
    usual = [r for r in rows.values() if r["n_chars"] > 400]
    assert sum(r["near_edited"] > r["near_next"] for r in usual) >= 0.95 * len(usual)


def test_op4(spark, docs):
    tokenizer = library()
    rows = {r["doc_id"]: r for r in queries.op4(spark, SF_DIR).collect()}
    for d in docs:
        ids = tokenizer.encode(d["text"] or "", add_special_tokens=False).ids
        r = rows[d["doc_id"]]
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), sha(" ".join(map(str, ids))), sha(tokenizer.decode(ids, skip_special_tokens=False)))


def test_op5(spark, docs):
    rows = [(d["doc_id"], d["text"]) for d in docs]
    brute = brute_classes(rows, neardup.learn_weights(queries.documents(spark, SF_DIR)), neardup.FLOOR)
    least = {}
    for d, t in rows:
        least[brute[t or ""]] = min(d, least.get(brute[t or ""], d))
    got = {r["doc_id"]: r["class_id"] for r in queries.op5(spark, SF_DIR).collect()}
    assert got == {d: least[brute[t or ""]] for d, t in rows}


def plain_statistics(text):
    words, lines = WORD.findall(text), text.split("\n")
    n, letters = max(1, len(words)), max(1, sum(map(len, words)))
    count = collections.Counter(words)
    windows = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    seen, again = set(), 0
    for line in lines:
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    alnum = re.compile(r"[^\W_]")
    return {
        "words_log": math.log1p(len(words)), "word_chars": sum(map(len, words)) / n,
        "long_words": sum(len(w) > 12 for w in words) / n, "distinct_words": len(count) / n,
        "top_word": max(count.values(), default=0) / n, "repeated_words": len(covered) / n,
        "repeated_lines": again / len(lines),
        "upper_share": sum(c.isupper() for w in words for c in w) / letters,
        "digit_share": sum(c.isdecimal() for w in words for c in w) / letters,
        "symbol_share": sum(c in r"#*$%&|<>~^=+_\{}@" for w in words for c in w) / letters,
        "punctuation_share": sum(c in ".,;:!?" for w in words for c in w) / letters,
        "bare_words": sum(not alnum.search(w) for w in words) / n,
        "symbol_ends": sum(bool(re.search(r"[\W_]{2,}$", w)) for w in words) / n,
        "line_words": math.log1p(len(words) / len(lines)),
        "word_entropy": sum(-k / n * math.log2(k / n) for k in count.values()) / math.log2(max(2, len(words))),
    }


def test_op3_statistics_and_score(spark, docs):
    measured = kept(rules.measure(queries.documents(spark, SF_DIR).select("doc_id", "text")), "t")
    sample = kept(labelled.training_labels(queries.labels(spark, SF_DIR), "quality"), "t")
    model = rules.fit(measured, sample)
    assert len(model) > 1
    found = {r["doc_id"]: r for r in measured.withColumn("score", rules.compiled(model)).collect()}
    for d in docs:
        r, want = found[d["doc_id"]], plain_statistics(d["text"] or "")
        assert {s: r[s] for s in rules.STATISTICS} == pytest.approx(want)
        values = {s: r[s] for s in rules.STATISTICS}
        total = sum(w for rule, w in model if eval(  # noqa: S307
            re.sub(r"(?<=[0-9])D\b", "", rule).replace("true", "True"), {}, values))
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-total)))


def test_op10_fusion(spark):
    documents = queries.documents(spark, SF_DIR)
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    langs, logs = langid.train(documents)
    rows = langid.text_evidence(pages, langs, logs).collect()
    each = range(len(langs))
    overall = [sum(r["said"][i] for r in rows) for i in each]
    shares = [(n + 1) / (sum(overall) + len(langs)) for n in overall]
    tallies = {k: collections.defaultdict(lambda: [0.0] * len(langs)) for k in ("host", "domain", "tld", "declared", "path")}
    counts = {k: collections.Counter(r[k] for r in rows) for k in tallies}
    for r in rows:
        for k, table in tallies.items():
            if r[k]:
                table[r[k]] = [a + b for a, b in zip(table[r[k]], r["said"])]
    got = {r["page_id"]: r for r in langid.identify(pages, documents).collect()}
    assert len(got) == len(rows)
    for r in rows:
        others = {k: [max(0.0, n - s) for n, s in zip(tallies[k][r[k]], r["said"])] if r[k] else None for k in tallies}
        prior = shares
        for k in ("tld", "domain", "host"):
            pages_there = counts[k][r[k]] - 1 if r[k] else 0
            own = others[k] or [0.0] * len(langs)
            prior = [(o + langid.SMOOTH * w) / (pages_there + langid.SMOOTH) for o, w in zip(own, prior)]
        log = [r["text_log"][i] + math.log(prior[i]) for i in each]
        for k in ("declared", "path"):
            if others[k]:
                log = [x + math.log((others[k][i] + 0.5) / (overall[i] + 1)) for i, x in enumerate(log)]
        best = max(log)
        out = got[r["page_id"]]
        assert out["posterior"] == pytest.approx(1 / sum(math.exp(x - best) for x in log), rel=1e-6)
        assert log[langs.index(out["lang"])] == pytest.approx(best)
        assert out["declared"] == (r["declared"] or None)
