"""Language of web pages by Bayesian fusion of evidence.

Per language: the likelihood of the page's text (byte trigrams of its words, learnt from documents
with a declared language), of the language declared in the markup, of the suffix of the address
(the path's first part or the top-level domain), and the prior of the host. The last three come
from grouped counts over all pages of what their text says. A host's prior is smoothed by its
domain's, that by its top-level domain's, that by the share over all pages; a page's own text is
left out of the counts behind its prior. Every language that a document declares is a class,
however rare: its trigrams are learnt from about ``TRAIN_DOCS`` of its documents, or all of a rarer
one's, and its table has at most ``BUCKETS`` entries.

Defined results: a NULL or empty page has no text evidence and rests on the rest; a NULL or odd
address has no host and uses the overall prior; a declared language that is no class is evidence
like any other; repeated rows are judged alike; without documents the language is NULL; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foldcast.llm.scratch import kept
from foldcast.llm.words import chunks, coded, owners, split, text_of
from foldcast.operators.joins import lookup_join

#: Documents of each language from which its trigrams are learnt.
TRAIN_DOCS = 20_000
BUCKETS = 1 << 16
#: Share of trigrams that are any bucket's alike. It is the same in every language: a trigram that
#: none of them has must not speak for the one learnt from the fewest documents.
UNSEEN = 0.01
#: Neighbouring trigrams overlap, so a text's log-likelihood counts this much.
TEXT_WEIGHT = 0.25
#: Weight of the wider level in a smoothed prior, in pages.
SMOOTH = 5.0
MARKUP = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<[^>]*>|&#?[a-z0-9]+;"


def trigrams(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every byte trigram of `` word ``, and the word it belongs to."""
    padded = pc.binary_join_element_wise(" ", pc.utf8_lower(words), " ", "")
    if not len(padded):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    data = np.frombuffer(b"".join(padded.cast(pa.binary()).to_pylist()), np.uint8)
    sizes = pc.binary_length(padded).to_numpy(zero_copy_only=False).astype(np.int64)
    word = np.repeat(np.arange(len(sizes)), sizes)
    code = data.astype(np.uint32)
    code = (code[:-2] << np.uint32(16)) | (code[1:-1] << np.uint32(8)) | code[2:]
    whole = word[:-2] == word[2:]
    bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(16)
    return bucket[whole].astype(np.int64), word[:-2][whole]


def train(documents: DataFrame, docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages of all documents and the log-likelihood of every trigram bucket in each, from
    about ``docs`` documents a language, chosen by the digest of their id."""
    rows = documents.where("lang is not null").select(
        "doc_id", F.col("lang").cast("string").alias("lang"), "text")
    labels = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(labels)
    if not langs:
        return [], np.zeros((0, BUCKETS), np.float32)
    bars = documents.sparkSession.createDataFrame(
        [(k, int(min(1.0, docs / n) * (1 << 30))) for k, n in labels.items()],
        "lang string, bar long")
    # one row per language
    rows = rows.join(F.broadcast(bars), "lang").where(
        F.pmod(F.xxhash64(F.lit("lang"), F.col("doc_id")), F.lit(1 << 30)) < F.col("bar"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                words, offsets = split(text_of(part))
                codes, distinct = coded(words)
                bucket, word = trigrams(distinct)
                kinds, langs = pd.factorize(part.column("lang").to_pandas())
                by_word = kinds[owners(offsets)]
                for k, lang in enumerate(langs):
                    times = np.bincount(codes[by_word == k], minlength=len(distinct))
                    n = np.bincount(bucket, weights=times[word], minlength=BUCKETS)
                    some = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(some), pa.string()),
                         pa.array(some.astype(np.int32)), pa.array(n[some].astype(np.int64))],
                        names=["lang", "bucket", "n"])

    # one row per language and bucket at most
    table = rows.select("lang", "text").mapInArrow(run, "lang string, bucket int, n long").groupBy(
        "lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    logs = np.zeros((len(langs), BUCKETS), np.float32)
    found = dict(list(table.groupby("lang")))
    for i, lang in enumerate(langs):
        share = np.full(BUCKETS, UNSEEN / BUCKETS)
        if lang in found:
            own = found[lang]
            share[own["bucket"].to_numpy()] += (1 - UNSEEN) * own["n"].to_numpy() / own["n"].sum()
        logs[i] = np.log(share)
    return langs, logs


def _address(pages: DataFrame) -> DataFrame:
    """Host, domain and top-level domain of the address, and the language marks around the text."""
    url, scheme = F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://"
    host = F.lower(F.regexp_extract(url, scheme + r"(?:[^/?#@]*@)?([^/?#:]+)", 1))
    path = F.lower(F.regexp_extract(url, scheme + r"[^/?#]*/([A-Za-z]{2})(?:[/?#-]|$)", 1))
    declared = F.lower(F.regexp_extract(
        F.coalesce("html", F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})", 1))
    return pages.select(
        "page_id", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
        F.regexp_extract(host, r"([^.]+)$", 1).alias("tld"),
        declared.alias("declared"), path.alias("path"))


def text_evidence(pages: DataFrame, langs: list[str], logs: np.ndarray) -> DataFrame:
    """The marks of every page with ``text_log``, its text's weighted log-likelihood per language,
    and ``said``, what that makes of each language alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "html"):
                bare = pc.replace_substring_regex(text_of(part, "html"), MARKUP, " ")
                words, offsets = split(bare)
                codes, distinct = coded(words)
                bucket, word = trigrams(distinct)
                rows, owner = [], owners(offsets)
                for table in logs:
                    value = np.bincount(word, weights=table[bucket], minlength=len(distinct))
                    rows.append(np.bincount(owner, weights=value[codes], minlength=part.num_rows))
                stacked = np.column_stack(rows) * TEXT_WEIGHT
                said = np.exp(stacked - stacked.max(axis=1, keepdims=True))
                said /= said.sum(axis=1, keepdims=True)
                lists = [pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(langs)).cast(
                    pa.list_(pa.float64())) for x in (stacked, said)]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], *lists], names=[*names, "text_log", "said"])

    marks = _address(pages)
    names = [c for c in marks.columns if c != "html"]
    schema = ", ".join([f"{c} {t}" for c, t in marks.dtypes if c != "html"])
    return marks.mapInArrow(run, f"{schema}, text_log array<double>, said array<double>")


def _tally(rows: DataFrame, key: str, langs: list[str]) -> DataFrame:
    """Pages of each value of ``key`` by the language of their text, as one array."""
    return rows.where(F.col(key) != "").groupBy(key).agg(F.array(*[
        F.sum(F.col("said")[i]) for i in range(len(langs))]).alias(f"{key}_n"),
        F.count(F.lit(1)).alias(f"{key}_pages"))


def identify(pages: DataFrame, documents: DataFrame) -> DataFrame:
    """``page_id``, ``lang`` and its ``posterior``, with ``text_lang`` and ``declared``."""
    langs, logs = train(documents)
    if not langs:
        return pages.selectExpr("page_id", "cast(null as string) as lang",
                                "cast(null as double) as posterior",
                                "cast(null as string) as text_lang",
                                "cast(null as string) as declared")
    count = len(langs)
    each = range(count)
    rows = kept(text_evidence(pages, langs, logs), "page-evidence")

    # counts per value of each mark; sums merge before the shuffle, so a hot host is no hot task
    overall = rows.agg(*[F.coalesce(F.sum(F.col("said")[i]), F.lit(0.0)) for i in each]).first()
    joined = rows
    for key in ("host", "domain", "tld", "declared", "path"):
        joined = lookup_join(joined, _tally(rows, key, langs), [key], ["page_id"])
    # arrays are zipped, so that neither plan nor work grows with the square of the languages
    shares = F.array(*[F.lit((n + 1.0) / (sum(overall) + count)) for n in overall])
    sizes = F.array(*[F.lit(n + 1.0) for n in overall])
    zeros = F.array_repeat(F.lit(0.0), count)

    def others(key: str) -> Column:
        """Pages of each language with this mark, without this page."""
        return F.zip_with(f"{key}_n", "said", lambda n, s: F.greatest(n - s, F.lit(0.0)))

    def smoothed(key: str, wider: Column) -> Column:
        """(own counts without this page + SMOOTH * wider share) / (their sum + SMOOTH)."""
        # what a page's text says adds up to one page
        whole = F.coalesce(F.col(f"{key}_pages") - 1, F.lit(0)) + SMOOTH
        return F.zip_with(F.coalesce(others(key), zeros), wider,
                          lambda o, w: (o + SMOOTH * w) / whole)

    def mark_log(key: str) -> Column:
        """Log-likelihood of a mark given a language: pages of that language that carry it."""
        return F.coalesce(F.zip_with(others(key), sizes, lambda o, n: F.log((o + 0.5) / n)), zeros)

    prior = smoothed("host", smoothed("domain", smoothed("tld", shares)))
    log = F.zip_with(F.zip_with("text_log", prior, lambda t, p: t + F.log(p)),
                     F.zip_with(mark_log("declared"), mark_log("path"), lambda d, p: d + p),
                     lambda x, y: x + y)
    fused = joined.withColumn("log", log)
    names = F.array(*[F.lit(x) for x in langs])
    best = F.array_max("log")
    return fused.select(
        "page_id",
        F.element_at(names, F.array_position("log", best).cast("int")).alias("lang"),
        (1 / F.aggregate("log", F.lit(0.0), lambda a, x: a + F.exp(x - best))).alias("posterior"),
        F.element_at(names, F.array_position("said", F.array_max("said")).cast("int"))
        .alias("text_lang"),
        F.expr("nullif(declared, '')").alias("declared"))
