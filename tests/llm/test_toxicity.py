"""Toxic vocabularies of many kinds planted in ordinary texts, and brute force of the arithmetic."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldcast.llm import labelled, queries, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLANTED, TEXTS = 6, 3000


@pytest.fixture(scope="module")
def ordinary(spark):
    """Texts without labelled toxicity, of all languages, of a usual length."""
    docs = queries.documents(spark, "/root/testdata/sf0.1")
    toxic = queries.labels(spark, "/root/testdata/sf0.1").where("toxic = 1")
    rows = docs.join(toxic, "doc_id", "left_anti").where("n_chars between 600 and 9000")
    return [(r["doc_id"], r["text"], r["lang"]) for r in
            rows.dropDuplicates(["text"]).orderBy("doc_id").limit(TEXTS).collect()]


def letters(dice, n):
    return "".join(dice.choice("abcdefghijklmnoprstuvwxyzéäñ") for _ in range(n))


def vocabularies(kind, texts):
    """For every language, a function that makes one toxic insertion."""
    dice = random.Random(11)
    known = collections.defaultdict(collections.Counter)
    for _, text, lang in texts:
        known[lang].update(set(WORD.findall(text)))
    out = {}
    for lang in sorted(known, key=str):
        stems = [letters(dice, 5) for _ in range(4)]
        usual = sorted(w for w, n in known[lang].items() if n > 0.05 * len(texts) / len(known) and w.isalpha())
        pairs = [tuple(dice.sample(usual, 2)) for _ in range(4)]
        out[lang] = {
            "words": lambda d, s=stems: d.choice(s) + "le",
            "beginnings": lambda d, s=stems: d.choice(s) + letters(d, 3),
            "endings": lambda d, s=stems: letters(d, 3) + d.choice(s),
            "middles": lambda d, s=stems: letters(d, 3) + d.choice(s) + letters(d, 3),
            "accents": lambda d, s=stems: "".join(d.choice([c, c + "́", c + "."]) for c in d.choice(s) + "le"),
            "apart": lambda d, s=stems: " ".join(d.choice(s) + "le"),
            "pairs": lambda d, p=pairs: " ".join(d.choice(p)),
        }[kind]
    return out


def planted(kind, texts):
    dice, make, out = random.Random(5), vocabularies(kind, texts), []
    for doc_id, text, lang in texts:
        toxic = dice.random() < 0.12
        words = text.split(" ")
        for _ in range(PLANTED if toxic else 0):
            words.insert(dice.randrange(len(words) + 1), make[lang](dice))
        out.append((doc_id, " ".join(words), int(toxic)))
    return out


@pytest.mark.parametrize("kind", ["words", "beginnings", "endings", "middles", "accents", "apart", "pairs"])
def test_planted(spark, ordinary, kind):
    rows = planted(kind, ordinary)
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(8)
    sample = labelled.training_labels(docs, "toxic")
    model = toxicity.fit(docs.drop("toxic"), sample)
    found = toxicity.score(docs, model).where(labelled.held_out()).select(
        "toxic", (F.col("score") >= 0.5).alias("hit")).collect()
    caught = [r["hit"] for r in found if r["toxic"] == 1]
    clean = [not r["hit"] for r in found if r["toxic"] == 0]
    assert len(caught) >= 50
    assert sum(caught) >= 0.9 * len(caught)
    assert sum(clean) >= 0.97 * len(clean)


def test_chance_labels_flag_little(spark, ordinary):
    """Labels that mean nothing give no units, or units that hold nothing."""
    dice = random.Random(9)
    rows = [(d, t, int(dice.random() < 0.1)) for d, t, _ in ordinary]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(8)
    model = toxicity.fit(docs.drop("toxic"), labelled.training_labels(docs, "toxic"))
    found = toxicity.score(docs, model).where(labelled.held_out())
    assert found.where("score >= 0.5").count() <= 0.03 * found.count()


def units(text):
    """Words of a text that have each unit, one by one."""
    import xxhash

    bare = [w.lower().strip(toxicity.EDGES) for w in WORD.findall(text)]
    out = collections.Counter()
    for w in bare:
        keys = toxicity.word_keys([w])
        out.update(set(toxicity.word_units([w], keys)[1].tolist()))
    for gap in toxicity.GAPS:
        for a, b in zip(bare, bare[gap:]):
            if a and b:
                x, y = (np.array([xxhash.xxh64_intdigest(w)], np.uint64) for w in (a, b))
                out[int(toxicity._mix(toxicity._mix(x, gap), y)[0])] += 1
    return out


def test_unit_counts(spark):
    dice = random.Random(2)
    rows = [(" ".join(dice.choices(["abc", "ab", "Déf!", "x", "...", "l0ok"], k=dice.randrange(9))), i % 3 == 0)
            for i in range(40)]
    docs = spark.createDataFrame([(t, int(x)) for t, x in rows], "text string, label int").repartition(3)
    want, every = collections.defaultdict(lambda: [0, 0, 0, 0]), [0, 0, 0, 0]
    for text, toxic in rows:
        at = 0 if toxic else 1
        for u, n in units(text).items():
            want[u][at] += 1
            want[u][2 + at] += n
        every[at] += 1
        every[2 + at] += len(text.split())
    want[toxicity.EVERY] = every
    names = ["toxic", "clean", "toxic_words", "clean_words"]
    got = {r["unit"] % (1 << 64): [r[n] for n in names] for r in toxicity.unit_counts(docs).collect()}
    assert got == dict(want)
    some = sorted(set(want) - {toxicity.EVERY})[::3]
    part = toxicity.unit_counts(docs, np.array(some, np.uint64)).collect()
    assert {r["unit"] % (1 << 64): [r[n] for n in names] for r in part} == {
        u: want[u] for u in [*some, toxicity.EVERY]}


def test_runs_of_letters():
    """Two words share a run's key exactly if they share the run, word ends included."""
    words = ["abcd", "xabc", "bcdx", "ab", "zz"]
    found = {w: set(toxicity.word_units([w], toxicity.word_keys([w]))[1].tolist()) for w in words}
    runs = {w: {m[i:i + n] for m in [f"^{w}$"] for n in toxicity.LETTERS for i in range(len(m) - n + 1)}
            for w in words}
    for a in words:
        for b in words:
            if a < b:
                assert len(found[a] & found[b]) == len(runs[a] & runs[b])
    assert toxicity.plain("ìd1.iöot") == "idiot"


def test_log_odds_and_law(spark):
    odds, error = toxicity.log_odds(F.col("t"), F.col("c"), 100.0, 900.0)
    rows = [(30, 10), (0, 5), (100, 900), (7, 0)]
    got = spark.createDataFrame(rows, "t long, c long").select(odds, error).collect()
    for (t, c), (o, e) in zip(rows, got):
        prior = max(50 * (t + c) / 1000, 0.5)
        a, b = t + prior, c + prior
        assert o == pytest.approx(math.log(a / (150 - t)) - math.log(b / (950 - c)))
        assert e == pytest.approx(math.sqrt(1 / a + 1 / b))
    z = spark.createDataFrame(rows, "t long, c long").select(
        toxicity.excess(F.col("t"), F.col("c"), 100.0, 900.0)).collect()
    assert [round(r[0], 4) for r in z] == [
        round(math.sqrt(2 * (30 * math.log(7.5) + 10 * math.log(10 / 36))), 4),
        round(-math.sqrt(2 * 5 * math.log(1 / 0.9)), 4), 0.0, round(math.sqrt(14 * math.log(10)), 4)]
    # the decay makes the mean of exp(decay * score) one; the chance of a segment follows its law
    scores, chances = np.array([2.0, 1.0, -0.5]), np.array([0.02, 0.05, 0.93])
    decay = toxicity.decay_of(scores, chances)
    assert float(np.sum(chances * np.exp(decay * scores))) == pytest.approx(1.0, abs=1e-6)
    model = toxicity.Model(np.empty(0, np.uint64), np.empty(0), decay=decay, scale=0.3)
    for score, n in ((1.0, 10), (4.0, 500), (30.0, 100)):
        chance = -math.expm1(-model.scale * n * math.exp(-decay * score))
        assert toxicity.strength_of(score, n, model) == pytest.approx(-math.log(chance), rel=1e-6)


def test_score_is_the_evidence(spark):
    """Word scores, segments, evidence and score of small texts by hand."""
    keys = np.array(sorted([toxicity.word_keys(["vile"])[0],
                            toxicity._mix(toxicity._mix(toxicity.word_keys(["so"]), 1),
                                          toxicity.word_keys(["it"]))[0]]), np.uint64)
    model = toxicity.Model(keys, np.array([3.0, 3.0]), other=-0.5, decay=1.0, scale=0.01, needed=5.0)
    texts = ["Vile a vile", "so it goes", "it so goes", "", "so vile it b c d e f g h i j vile"]
    best, offsets = toxicity.word_scores(pa.array(texts), model)
    hits = [np.flatnonzero(np.isfinite(best[a:b])).tolist() for a, b in zip(offsets, offsets[1:])]
    assert hits == [[0, 2], [1], [], [], [1, 12]]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["text"]: r for r in toxicity.score(docs, model).collect()}
    for text, parts in zip(texts, [[5.5], [3.0], [], [], [3.0, 3.0]]):
        n = len(WORD.findall(text))
        strength = [toxicity.strength_of(x, n, model) for x in parts]
        evidence = sum(s for s in strength if s >= -math.log(toxicity.CHANCE))
        assert got[text]["score"] == pytest.approx(evidence / (evidence + 5.0))
        assert len(got[text]["passages"]) == sum(s >= -math.log(toxicity.CHANCE) for s in strength)
