import collections
import hashlib
import math
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from foldcast.llm import (bpe, components, fertility, labelled, langid, lines, mixing, neardup, rules,
                          sharding, spotsigs, toxicity)
from foldcast.llm.queries import PIECES, WORD_BPE, vocabulary
from foldcast.llm.scratch import BATCH_BYTES, kept, running_totals
from tests.llm.conftest import SCHEMA, sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_running_totals(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as k").repartition(5)
    got = running_totals(df, [F.col("k"), F.col("id")], {"upto": F.col("id")}, "t").collect()
    total = 0
    for r in sorted(got, key=lambda r: (r["k"], r["id"])):
        total += r["id"]
        assert r["upto"] == total


def test_batches_follow_bytes(spark):
    """Long texts come to a task in batches of a few MB, and lines are cut in such parts."""
    texts = spark.range(0, 6000, 1, 1).selectExpr("id as doc_id", "repeat('some words ', 200) as text")

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["bytes"])

    setting = spark.conf.get(BATCH_BYTES, None)
    sizes = [r["bytes"] for r in kept(texts.mapInArrow(run, "bytes long"), "t").collect()]
    assert sum(sizes) > 13_000_000 and max(sizes) < 5_000_000
    assert spark.conf.get(BATCH_BYTES, None) == setting
    whole = pa.RecordBatch.from_arrays(
        [pa.array(["a line\n" * 300] * 6000), pa.array([None] * 6000, pa.binary())],
        names=["text", "_bitmap"])
    cut = list(lines._cut(iter([whole]), ["text"]))
    assert max(part.nbytes for part in cut) < 5_000_000
    assert pa.Table.from_batches(cut)["text"].to_pylist() == whole["text"].to_pylist()


def test_hypergeometric_draw(spark):
    drawn = spark.range(4000).selectExpr("id", "array(3L, 0L, 5L, 2L) as room", "4L as n").withColumn(
        "d", sharding.split_counts("n", "room", "3L, id")).collect()
    seen = collections.Counter(r["d"][0] for r in drawn)
    assert all(sum(r["d"]) == 4 and r["d"][1] == 0 and r["d"][2] <= 5 for r in drawn)
    for k in range(4):
        chance = math.comb(3, k) * math.comb(7, 4 - k) / math.comb(10, 4)
        assert abs(seen[k] / 4000 - chance) < 5 * math.sqrt(chance / 4000)


def test_shard(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(sharding, "PART_ROWS", 10)
    out = sharding.shard(odd_docs, 7)
    assert out.columns == [c for c in odd_docs.columns if c not in ("shard", "slot")] + ["shard", "slot"]
    rows = out.collect()
    slots = collections.defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert sum(sizes) == odd_docs.count() and max(sizes) - min(sizes) <= 1 and len(sizes) == 7
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    kept_rows = collections.Counter((r["doc_id"], r["text"], r["_part"]) for r in rows)
    assert kept_rows == collections.Counter(
        (r["doc_id"], r["text"], r["_part"]) for r in odd_docs.collect())
    again = {(r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard(odd_docs.coalesce(1), 7).collect()}
    assert again == {(r["doc_id"], r["shard"], r["slot"]) for r in rows}
    assert sharding.shard(no_docs, 3).collect() == []


def targets(sizes, weights, share, most):
    """Water-filling by rounds."""
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = budget - sum(most * sizes[s] for s in full)
        weight = sum(weights[s] for s in sizes if s not in full) or 1
        over = {s for s in sizes if s not in full and rest * weights[s] / weight >= most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in full else rest * weights[s] / weight for s in sizes}
        full |= over


def test_mix(odd_docs, no_docs, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 4)
    mixed, cuts = mixing.mix(odd_docs)
    rows = mixed.collect()
    size = collections.Counter()
    for r in odd_docs.collect():
        size[r["source"]] += len(WORD.findall(r["text"] or ""))
    order = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    want = targets(size, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 1.5, 2)
    taken = collections.Counter()
    for r in rows:
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - want[r["source"]]) < 1e-6
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["size"] * r["copies"]
    longest = max(r["size"] for r in rows)
    assert len(rows) == odd_docs.count()
    assert sum(taken.values()) <= 1.5 * sum(size.values())
    assert all(abs(taken[s] - want[s]) <= 2 * longest for s in size)
    out = mixing.apply_mix(odd_docs, cuts)
    assert out.columns == odd_docs.columns
    assert abs(out.count() - sum(r["copies"] for r in rows)) <= 2  # repeated rows go together
    empty, none = mixing.mix(no_docs)
    assert empty.collect() == [] and mixing.apply_mix(no_docs, none).collect() == []


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(vocabulary(WORD_BPE))


def test_bpe(spark, odd_docs, no_docs):
    tokenizer, path = library(), vocabulary(WORD_BPE)
    rows = bpe.decode(bpe.encode(odd_docs, path), path).collect()
    both = {(r["doc_id"], r["text"]): (r["ids"], r["decoded"]) for r in rows}
    assert len(rows) == odd_docs.count() and rows[0]["a b"] is not None
    for (_, text), (ids, decoded) in both.items():
        want = tokenizer.encode(text or "", add_special_tokens=False).ids
        assert ids == want and decoded == tokenizer.decode(want, skip_special_tokens=False)
    trip = bpe.round_trip(odd_docs, path).collect()
    assert {(r["doc_id"], r["text"]): (r["ids"], r["decoded"]) for r in trip} == both
    assert bpe.round_trip(no_docs, path).collect() == []


def test_bpe_random():
    import random

    tokenizer = library()
    with open(vocabulary(WORD_BPE), encoding="utf-8") as f:
        vocab = bpe.Vocabulary(f.read())
    dice = random.Random(5)
    texts = ["".join(dice.choice("abé'sT 中1<|>#.\nİΣ") for _ in range(dice.randrange(60)))
             for _ in range(1500)] + ["ab" * n + "a" * n for n in range(60)]
    got = bpe.encode_texts(pa.array(texts), vocab).to_pylist()
    assert got == [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]


def drop_lines(rows, least):
    key = lambda s: re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", s).translate(
        {c: c + 32 for c in range(65, 91)})
    docs = collections.defaultdict(set)
    for r in rows:
        for s in (r[1] or "").split("\n"):
            docs[key(s)].add((r[0], r[1] or ""))
    out = []
    for r in rows:
        cut = [s for s in (r[1] or "").split("\n") if not key(s) or len(docs[key(s)]) < least]
        out.append((r[0], "\n".join(cut), (r[1] or "").count("\n") + 1))
    return collections.Counter(out)


@pytest.mark.parametrize("ranges", [1, 8])
def test_lines(spark, odd_docs, odd_rows, no_docs, ranges):
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        for least in (2, 3, 10):
            out = lines.drop_shared_lines(odd_docs, least)
            got = collections.Counter(
                (r["doc_id"], r["text"] or "", r["n_lines"]) for r in out.collect())
            assert got == drop_lines(odd_rows, least)
        assert "_part" in out.columns and lines.drop_shared_lines(no_docs).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_line_ranges():
    """One key over many ranges and batches is settled as if it had been read at once."""
    data = sorted([(h, h, d, 0, p) for h in range(5) for d in range(h * 4 + 1) for p in range(2)])
    for cut in range(1, len(data), 5):
        got, parts = collections.Counter(), [data[:cut], data[cut:cut + 9], data[cut + 9:]]
        counts, open_rows = collections.Counter(), []
        for part in parts:
            batches = [pa.RecordBatch.from_pylist(
                [dict(zip(["h1", "h2", "doc", "same", "pos"], r)) for r in part[i:i + 4]],
                schema=pa.schema([(n, pa.int64()) for n in ["h1", "h2", "doc", "same"]] + [("pos", pa.int32())]))
                for i in range(0, len(part), 4)]
            # a document's lines of one key stay in one range
            for b in lines.settle(iter(batches), 6):
                for r in b.to_pylist():
                    if r["docs"] is None:
                        got[r["h1"], r["doc"], r["pos"]] += 1
                    elif r["docs"] == 0:
                        open_rows.append((r["h1"], r["doc"], r["pos"]))
                    else:
                        counts[r["h1"]] += r["docs"]
        if cut % 2 == 0:  # cuts between documents only
            got.update(r for r in open_rows if counts[r[0]] >= 6)
            assert got == collections.Counter((h, d, p) for h, _, d, _, p in data if h * 4 + 1 >= 6)


def test_fertility(spark, odd_docs, odd_rows, no_docs):
    path = vocabulary(PIECES)
    rows = fertility.verdicts(kept(fertility.measure(odd_docs, path), "t")).collect()
    assert len(rows) == len(odd_rows) and rows[0]["_part"] is not None
    for r in rows:
        text = r["text"] or ""
        words = WORD.findall(text)
        windows = collections.Counter(zip(words, words[1:], words[2:]))
        covered = {j for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1
                   for j in range(i, i + 3)}
        seen, again = set(), 0
        for s in text.split("\n"):
            if WORD.search(s):
                again += s in seen
                seen.add(s)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered))
        assert r["base_failed"] == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r["base_failed"] and r["kept"])
    assert sum(r["kept"] for r in rows) >= 40
    assert fertility.verdicts(kept(fertility.measure(no_docs, path), "t")).collect() == []


def test_fertility_bands(spark):
    docs = [(i, sentence(i, 120 + i % 9), "en", "s") for i in range(150)]
    docs += [(900 + i, " ".join(f"q{j}zx$$$###%%%" for j in range(130)), "en", "s") for i in range(3)]
    measured = kept(fertility.measure(spark.createDataFrame(docs, SCHEMA), vocabulary(PIECES)), "t")
    out = {r["doc_id"]: r["kept"] for r in fertility.verdicts(measured).collect()}
    assert not any(out[900 + i] for i in range(3))
    assert sum(out[i] for i in range(150)) >= 147


def test_fertility_copies(spark):
    """Copies of one text, or near copies that fill half of a class, reject no other document."""
    docs = [(i, sentence(i, 120 + i % 9), "en", "s") for i in range(150)]
    verdicts = {}
    for name, more in {"none": [], "copies": [sentence(3, 123)] * 150,
                       "near": [sentence(3, 123) + f"x{i}" for i in range(150)]}.items():
        rows = docs + [(1000 + i, t, "en", "s") for i, t in enumerate(more)]
        measured = kept(fertility.measure(spark.createDataFrame(rows, SCHEMA), vocabulary(PIECES)), "t")
        verdicts[name] = {r["doc_id"]: r["kept"] for r in fertility.verdicts(measured).collect()}
    assert all(verdicts["copies"][i] == verdicts["none"][i] for i in range(150))
    assert sum(verdicts["near"][i] for i in range(150)) >= 147


def weighted(a, b):
    common = sum(min(x, b[k]) for k, x in a.items() if k in b)
    return common / (sum(a.values()) + sum(b.values()) - common)


def brute_classes(rows, weights, floor):
    texts = sorted({r[1] or "" for r in rows})
    owner, digest, weight = neardup.shingles(pa.array(texts), weights)
    sets = [dict() for _ in texts]
    for o, d, w in zip(owner.tolist(), digest.tolist(), weight.tolist()):
        sets[o][d] = w
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and weighted(sets[i], sets[j]) >= floor:
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    return {t: root[i] for i, t in enumerate(texts)}


def test_near_duplicates(spark, odd_docs, odd_rows, no_docs):
    weights = neardup.learn_weights(odd_docs)
    brute = brute_classes(odd_rows, weights, neardup.FLOOR)
    rows = odd_docs.select("doc_id", "text").collect()
    got = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(odd_docs).collect()}
    least = {}
    for r in rows:
        c = brute[r["text"] or ""]
        if r["doc_id"] is not None:
            least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    assert neardup.near_duplicates(odd_docs).count() == len(rows)
    for r in rows:
        if r["doc_id"] is not None:
            assert got[r["doc_id"]] == least[brute[r["text"] or ""]]
    one = neardup.keep_one(odd_docs)
    assert one.columns == odd_docs.columns
    assert one.count() == len(set(brute.values()))
    assert neardup.near_duplicates(no_docs).collect() == []


@pytest.mark.parametrize("paired,block", [(100, 256), (2, 256), (2, 7)])
def test_buckets_are_settled(spark, monkeypatch, paired, block):
    """Buckets with several near groups are settled without loss, by pairs and by blocks."""
    monkeypatch.setattr(neardup, "PAIRED", paired)
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = []
    for g in range(4):
        words = sentence(g, 60).split()
        for i in range(12):
            own = list(words) + words[5:15] * (i % 3)
            own[(i * 5) % 40] = f"own{g}x{i}"
            rows.append((g * 100 + i, " ".join(own), "en", "s"))
    docs = spark.createDataFrame(rows, SCHEMA)
    weights = neardup.learn_weights(docs)
    copy = F.md5(F.col("text").cast("binary")).alias("copy")
    texts = kept(docs.select(copy, "text", F.array(F.lit(0).cast("long"), F.lit(0).cast("long"))
                             .alias("bands")), "t")
    # all of them in one bucket
    members = kept(texts.selectExpr("copy", "0 as band", "0L as key", "48L as texts"), "t")
    found = neardup.settle(members, texts, weights)
    labels = {r["copy"]: r["root"] for r in components.labels_of(
        found.select(F.col("left").alias("a"), F.col("right").alias("b"))).collect()}
    brute = brute_classes(rows, weights, neardup.FLOOR)
    digest = {t: hashlib.md5(t.encode()).hexdigest() for t in brute}
    mine = {t: labels.get(d, d) for t, d in digest.items()}
    assert all((mine[a] == mine[b]) == (brute[a] == brute[b]) for a in brute for b in brute)
    assert found.count() < len(rows) * (len(rows) - 1) / 4


def test_large_buckets_are_dealt_by_class(spark, monkeypatch):
    """Every pair of different classes meets in one block pair; few others cost few rows."""
    monkeypatch.setattr(neardup, "BLOCK", 10)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 400)
    rows = [("x", f"a{i:04}", "t" * 20) for i in range(2000)] + [("o", "o0", "t")]
    rows += [(c, f"{c}{i}", "t" * (1 + 60 * (i % 3))) for c in "bcd" for i in range(9)]
    texts = spark.createDataFrame([(k, t) for _, k, t in rows], "copy string, text string")
    members = spark.createDataFrame(
        [(0, 5, k, c) for c, k, _ in rows[:2001]] + [(1, 5, k, c) for c, k, _ in rows[2001:]],
        "band int, key long, copy string, class string")
    out = neardup.deal(members, texts).collect()
    sent = collections.Counter(r["band"] for r in out)
    assert sent[0] == 2000 + 201  # the odd member's own block, and one for each of 200 others
    met = collections.Counter()
    groups = collections.defaultdict(list)
    for r in out:
        groups[r["band"], r["i"], r["j"]].append(r)
    for (_, i, j), found in groups.items():
        for a in found:
            for b in found:
                if a["copy"] < b["copy"] and a["class"] != b["class"] and (
                        i == j or a["own"] != b["own"]):
                    met[a["copy"], b["copy"]] += 1
    want = [(k, "o0") for _, k, _ in rows[:2000]]
    want += [(a[1], b[1]) for a in rows[2001:] for b in rows[2001:] if a[0] < b[0]]
    assert met == dict.fromkeys(want, 1)
    assert max(len(g) for g in groups.values()) < 60


@pytest.mark.parametrize("paired", [2, 16])
def test_ties_at_the_floor_are_links(spark, monkeypatch, paired):
    """Texts that share 4 of 5 equal weights each are linked, by pairs and by blocks."""
    monkeypatch.setattr(neardup, "PAIRED", paired)
    rows = []
    for n in range(1, 16):
        # 8n shared shingles and n own ones: similarity 8n / 10n
        common = [f"c{n}x{i}" for i in range(8 * n + 4)]
        rows += [(n, " ".join(common + [f"{side}{n}x{i}" for i in range(n)])) for side in "ab"]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    weights = neardup.Weights({}, 1)
    copy = F.md5(F.col("text").cast("binary")).alias("copy")
    texts = kept(docs.select(copy, "text", F.array(F.lit(0).cast("long")).alias("bands")), "t")
    members = kept(texts.selectExpr("copy", "0 as band", "0L as key", "3L as texts"), "t")
    found = {(r["left"], r["right"]) for r in neardup.settle(members, texts, weights).collect()}
    digest = [hashlib.md5(t.encode()).hexdigest() for _, t in rows]
    assert found == {tuple(sorted(digest[i:i + 2])) for i in range(0, len(rows), 2)}


def test_sampling_agrees_with_similarity():
    import numpy as np

    texts = [sentence(3, 300), sentence(3, 300).replace("alpha", "omega")]
    weights = neardup.Weights({}, 10)
    owner, digest, weight = neardup.shingles(pa.array(texts), weights)
    sets = [dict(zip(digest[owner == i].tolist(), weight[owner == i].tolist())) for i in (0, 1)]
    drawn = neardup.samples(owner, digest, weight, 600)
    share = float(np.mean(drawn[0] == drawn[1]))
    assert abs(share - weighted(*sets)) < 0.1


def test_sampling_in_strips():
    """Texts that span strips of shingles get the samples of the plain formula, in little memory."""
    import tracemalloc

    import numpy as np

    strip, count = neardup._STRIP, 6
    sizes = [1, strip - 2, 1, 3, 3 * strip + 5, strip, 2]
    rng = np.random.default_rng(7)
    owner = np.repeat(2 * np.arange(len(sizes)), sizes)
    digest = rng.integers(0, 1 << 63, len(owner)).astype(np.uint64)
    weight = rng.random(len(owner)) + 0.05
    neardup.samples(owner[:1], digest[:1], weight[:1], count)  # draws the tables
    tracemalloc.start()
    drawn = neardup.samples(owner, digest, weight, count)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 64 * strip + 4 * len(owner)
    low = np.log(weight).astype(np.float32)
    for k in range(count):
        inverse, r, log_c, beta = neardup._draws(k)
        x = (digest ^ np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * np.uint64(0xD6E8FEB86659FD93)
        x ^= x >> np.uint64(32)
        i, j, m = [((x >> np.uint64(s)) % np.uint64(neardup._TABLE)).astype(int) for s in (0, 14, 28)]
        value = log_c[j] - r[i] * (np.floor(low * inverse[i] + beta[m]) - beta[m] + 1)
        assert drawn[:, k].tolist() == [value[owner == o].min() for o in np.unique(owner)]
    assert neardup.samples(owner[:0], digest[:0], weight[:0], count).shape == (0, count)


def test_components(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("500", f"{600 + i}") for i in range(30)]
    got = {r["copy"]: r["root"] for r in components.labels_of(
        spark.createDataFrame(edges, "a string, b string")).collect()}
    assert got == {**{f"{i:03}": "000" for i in range(41)},
                   **{k: "500" for k in ["500", *[f"{600 + i}" for i in range(30)]]}}
    assert components.labels_of(spark.createDataFrame([], "a string, b string")).collect() == []


def test_spot_signatures(spark, odd_docs, odd_rows, no_docs):
    rows = spotsigs.with_next(odd_docs).collect()
    order = sorted(odd_rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = collections.Counter((r[0], r[1] or "", order[(i + 1) % len(order)][1] or "")
                               for i, r in enumerate(order))
    assert collections.Counter((r["doc_id"], r["text"], r["next_text"]) for r in rows) == want
    prints = spotsigs.fingerprint(odd_docs, {"text": "fingerprint"})
    found = prints.collect()
    by_text = collections.defaultdict(set)
    for r in found:
        by_text[r["text"] or ""].add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values())
    assert by_text[""] == by_text["   \n\t\n "] == {""}
    sets = {p: {p[i:i + 8] for i in range(0, len(p), 8)} for r in found for p in [r["fingerprint"]]}
    keys = sorted(p for p in sets if p)
    brute = {(a, b) for i, a in enumerate(keys) for b in keys[i + 1:]
             if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8}
    pairs = spotsigs.similar_prints(prints, 0.8).collect()
    assert {tuple(sorted((r["left"], r["right"]))) for r in pairs} == brute
    assert spotsigs.with_next(no_docs).collect() == []
    assert spotsigs.similar_prints(spotsigs.fingerprint(no_docs, {"text": "fingerprint"})).collect() == []


def test_spot_likeness(spark):
    df = spark.createDataFrame([("", ""), ("", "0000000a"), ("0000000a0000000b", "0000000b0000000c")],
                               "x string, y string")
    assert [r["z"] for r in spotsigs.likeness(df, {"z": ("x", "y")}).collect()] == [1.0, 0.0, 1 / 3]


def labelled_docs(spark, bad):
    rows = [(i, sentence(i, 90) if i % 4 else bad(i), "en", "s") for i in range(400)]
    labels = [(i, int(bool(i % 4)), int(not i % 4)) for i in range(400)]
    return (spark.createDataFrame(rows, SCHEMA),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_quality_rules(spark, odd_docs, no_docs):
    docs, labels = labelled_docs(spark, lambda i: sentence(i, 60).replace(" ", "$$$ ### "))
    sample = labelled.training_labels(labels, "quality")
    measured = kept(rules.measure(docs), "t")
    model = rules.fit(measured, sample)
    scored = measured.select("doc_id", labelled.held_out().alias("out"),
                             rules.compiled(model).alias("score")).collect()
    held = [r for r in scored if r["out"]]
    assert 40 < len(held) < 130
    assert all((r["score"] >= 0.3) == bool(r["doc_id"] % 4) for r in held)
    odd = rules.measure(odd_docs).select(rules.compiled(model).alias("s")).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r["s"] <= 1 for r in odd)
    none = rules.fit(rules.measure(no_docs), sample.where("false"))
    assert rules.measure(no_docs).select(rules.compiled(none)).collect() == []


def test_rule_paths():
    tree = """DecisionTreeClassificationModel: depth=2
  If (feature 0 <= 1.5)
   If (feature 1 <= 0.25)
    Predict: 0.0
   Else (feature 1 > 0.25)
    Predict: 1.0
  Else (feature 0 > 1.5)
   Predict: 1.0
"""
    a, b = rules.STATISTICS[:2]
    assert rules.paths(tree) == {f"{a} <= 1.5D", f"{a} > 1.5D", f"{b} <= 0.25D and {a} <= 1.5D".replace(
        f"{b} <= 0.25D and {a} <= 1.5D", f"{a} <= 1.5D and {b} <= 0.25D"), f"{b} > 0.25D and {a} <= 1.5D"}


def test_toxicity(spark, odd_docs, no_docs):
    docs, labels = labelled_docs(
        spark, lambda i: sentence(i, 90).replace("delta", "vileword").replace("tango", "grimnoun"))
    sample = labelled.training_labels(labels, "toxic")
    model = toxicity.fit(docs, sample)
    rows = toxicity.score(docs, model).withColumn("out", labelled.held_out()).collect()
    held = [r for r in rows if r["out"]]
    right = sum((r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in held)
    assert right >= 0.95 * len(held)
    assert all(r["passages"] for r in held if r["score"] >= 0.5)
    odd = toxicity.score(odd_docs, model)
    assert "words" in odd.columns and odd.count() == odd_docs.count()
    assert all(0 <= r["score"] <= 1 for r in odd.collect())
    assert toxicity.fit(docs, sample.where("false")) is None
    assert [r["score"] for r in toxicity.score(docs.limit(2), None).collect()] == [0.0, 0.0]
    assert toxicity.score(no_docs, model).collect() == []


def brute_segments(values):
    """All maximal scoring segments by their recursive definition."""
    best, at = 0, None
    for i in range(len(values)):
        total = 0
        for j in range(i, len(values)):
            total += values[j]
            if total > best + 1e-12:
                best, at = total, (i, j)
    if at is None:
        return []
    i, j = at
    right = [(s, a + j + 1, b + j + 1) for s, a, b in brute_segments(values[j + 1:])]
    return brute_segments(values[:i]) + [(best, i, j)] + right


def test_segments():
    import random

    import numpy as np

    dice = random.Random(3)
    for _ in range(200):
        n = dice.randrange(1, 25)
        hits = sorted(dice.sample(range(n), dice.randrange(0, n + 1)))
        scores = [dice.uniform(0.5, 3) for _ in hits]
        values = [-0.7] * n
        for h, s in zip(hits, scores):
            values[h] = s
        got = toxicity.segments(np.array(hits, int), np.array(scores), -0.7, n)
        want = brute_segments(values)
        assert [(a, b) for _, a, b in got] == [(a, b) for _, a, b in want]


def test_language(spark, no_docs):
    texts = {"en": "the house of the man and the water with that", "fr": "la maison est dans le jardin avec une eau",
             "de": "das haus und der garten sind nicht mit dem wasser"}
    docs = spark.createDataFrame([(i, " ".join(texts[k].split()[j % 5:] * 3), k, "s")
                                  for i, (k, j) in enumerate((k, j) for k in texts for j in range(30))], SCHEMA)
    page = lambda k, t, d: f'<!DOCTYPE html><html lang="{d}"><script>x="</p>"</script><p>{t}</p></html>'
    pages = [(i, f"https://{k}{i % 3}.example.{k}/{k}/{i}", page(k, texts[k], k))
             for i, k in enumerate(["en", "fr", "de"] * 20)]
    pages += [(100, "https://fr0.example.fr/fr/1", page("fr", "", "fr")), (101, None, None),
              (102, "no address", "<p>das haus und der garten"), (103, "https://fr1.example.fr/x", "<html>123</html>"),
              (None, "https://en0.example.en/en/1", page("en", texts["en"], "xx")), (102, "no address", "<p>das haus und der garten")]
    out = langid.identify(spark.createDataFrame(pages, "page_id long, url string, html string"), docs).collect()
    got = collections.defaultdict(set)
    for r in out:
        got[r["page_id"]].add(r["lang"])
        assert 0 < r["posterior"] <= 1
    assert len(out) == len(pages)
    assert all(got[i] == {k} for i, k in enumerate(["en", "fr", "de"] * 20))
    assert got[100] == {"fr"} and got[102] == {"de"} and got[103] == {"fr"} and got[None] == {"en"}
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert langid.identify(none, docs).collect() == []
    assert langid.identify(spark.createDataFrame(pages[:2], none.schema), no_docs).collect()[0]["lang"] is None


def test_every_language_is_a_class(spark):
    """A language with a few short documents among long ones of others is found; odd text is not its."""
    docs = [(i, sentence(i, 400), k, "s") for i, k in enumerate(["en", "fr"] * 40)]
    docs += [(900 + i, "hus og vann med den lille fisken som ikke er der", "no", "s") for i in range(3)]
    docs += [(950, "", "xx", "s")] + [(1000 + i, f"w{i:02}", f"l{i:02}", "s") for i in range(60)]
    langs, logs = langid.train(spark.createDataFrame(docs, SCHEMA))
    assert langs == sorted({k for _, _, k, _ in docs}) and logs.shape == (len(langs), langid.BUCKETS)
    pages = [(1, "https://a.example.no/no/1", '<html lang="no"><p>den lille fisken er ikke med</p></html>'),
             (2, None, f"<p>{sentence(5, 200)} {'zqzqj ' * 20}</p>")]
    out = langid.identify(spark.createDataFrame(pages, "page_id long, url string, html string"),
                          spark.createDataFrame(docs, SCHEMA)).collect()
    got = {r["page_id"]: r["lang"] for r in out}
    assert got[1] == "no" and got[2] in ("en", "fr")


def test_training_labels(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(5000)] + [(1, None), (None, 1), (7, 0)],
                                   "doc_id long, toxic int")
    full = labelled.training_labels(labels, "toxic")
    assert full.count() == labels.where("doc_id is not null").select("doc_id").distinct().where(
        ~labelled.held_out()).count()
    some = labelled.training_labels(labels, "toxic", 1000)
    assert 800 < some.count() < 1200 and some.where(labelled.held_out()).isEmpty()


def test_shard_parts_rows_of_one_id(spark, monkeypatch):
    """Half of the rows under one id, or under none, fill no part twice as much as the others."""
    monkeypatch.setattr(sharding, "PART_ROWS", 100)
    docs = spark.range(1600).selectExpr(
        "case when id % 4 = 0 then null when id % 4 = 1 then 7 else id end as doc_id", "'t' || id as text")
    rows = sharding._marked(docs)
    parts = [r["n"] for r in rows.groupBy(F.pmod(F.xxhash64(F.lit(7), F.lit(1), "_mark"), F.lit(16))).agg(
        F.count(F.lit(1)).alias("n")).collect()]
    assert len(parts) == 16 and max(parts) < 2 * sorted(parts)[8]
    out = sharding.shard(docs, 5).groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.max("slot").alias("m"))
    assert sorted((r["n"], r["m"]) for r in out.collect()) == [(320, 319)] * 5
