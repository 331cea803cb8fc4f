"""Quality rules from tokeniser fertility.

A public piece vocabulary with byte fallback measures each document: characters per token, share
of byte tokens, and entropy of its tokens. What is usual depends on language and length, so the
bands come from the corpus: quartiles of every measure per language and size class, over all
different texts, so that copies move no band. What a class with few texts says is weighed against
its neighbouring classes, its language, its class in all languages and all texts, in this order;
``WEIGHT`` texts count as much as all that comes after. Where near copies fill a class its quartiles
draw together; a band is then as wide as ``USUAL`` of what is usual in the classes of its language,
and never narrower than a share of its middle. A document outside a band is rejected; so is one that
fails the base rules.

Defined results: a NULL or empty text has no words and fails the base rules; a NULL language is
the group ``und``; every document has a band, however rare its language or size, and no number of
texts switches between bands; repeated rows are judged alike; an empty table gives no rows. Input columns named like an output column are replaced.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foldcast.llm.scratch import aside, kept
from foldcast.llm.words import chunks, coded, owners, split, text_of
from foldcast.operators.joins import lookup_join

SYMBOLS = r"[#*$%&|<>]"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_tokens",
          "n_byte_tokens"]
#: Digest of the text, by which copies are told.
DIGEST = "text_digest"
#: Texts of a class that weigh as much as its wider surroundings.
WEIGHT = 50.0
#: Half-widths of the bands, in robust standard deviations.
CHARS_BAND, ENTROPY_BAND, BYTE_BAND = 5.0, 3.0, 6.0
#: Least spread of a band: of the usual spread in its language's classes, and of its own middle.
USUAL, NARROWEST = 0.5, 0.01


def repeated_words(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text: words inside windows of three words that the text holds more than once."""
    texts = len(offsets) - 1
    owner = owners(offsets)
    if len(codes) < 3:
        return np.zeros(texts, np.int64)
    whole = np.flatnonzero(owner[:-2] == owner[2:])
    pair, _ = pd.factorize(codes[:-1] * (codes.max() + 1) + codes[1:])
    window, found = pd.factorize(pair[whole].astype(np.int64) * (codes.max() + 1) + codes[whole + 2])
    own = owner[whole] * max(1, len(found)) + window
    again = whole[pd.Series(own).duplicated(keep=False).to_numpy()]
    covered = np.zeros(len(codes), bool)
    for step in range(3):
        covered[again + step] = True
    return np.bincount(owner[covered], minlength=texts)


def repeated_lines(texts: pa.Array) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of it."""
    cut = pc.split_pattern(texts, "\n")
    counts = pc.list_value_length(cut).to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), counts)
    lines = cut.flatten()
    full = pc.greater(pc.binary_length(pc.ascii_trim_whitespace(lines)), 0)
    codes, distinct = coded(lines.filter(full))
    owner = owner[full.to_numpy(zero_copy_only=False)]
    again = pd.Series(owner * max(1, len(distinct)) + codes).duplicated().to_numpy()
    return np.bincount(owner[again], minlength=len(texts))


def measures(texts: pa.Array, pieces) -> dict[str, np.ndarray]:
    """The counts of every text, and the entropy of its tokens in bits."""
    words, offsets = split(texts)
    codes, distinct = coded(words)
    n, owner = len(texts), owners(offsets)

    def per_text(values: np.ndarray, by: np.ndarray = owner) -> np.ndarray:
        return np.bincount(by, weights=values, minlength=n)

    # a word's tokens do not depend on its neighbours, so each different word is encoded once
    ids = pa.array(pieces.encode(distinct.to_pylist(), num_threads=1) if len(distinct) else [],
                   pa.list_(pa.int32()))
    sizes = pc.list_value_length(ids).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)
    is_byte = np.array([pieces.is_byte(i) for i in range(pieces.get_piece_size())])
    byte_tokens = np.zeros(len(distinct), np.int64)
    flat = ids.flatten().to_numpy(zero_copy_only=False)
    np.add.at(byte_tokens, np.repeat(np.arange(len(distinct)), sizes), is_byte[flat])
    tokens = np.diff(np.concatenate([[0], np.cumsum(sizes[codes])])[offsets])
    token_owner = np.repeat(np.arange(n), tokens)
    every = ids.take(pa.array(codes)).flatten().to_numpy(zero_copy_only=False) if len(codes) else flat
    kinds, times = np.unique(token_owner * len(is_byte) + every, return_counts=True)
    of = (kinds // len(is_byte)).astype(np.int64)
    share = times / tokens[of]
    return {
        "n_words": np.diff(offsets),
        "word_chars": per_text(chars[codes]),
        "n_symbols": pc.count_substring_regex(texts, SYMBOLS).to_numpy(zero_copy_only=False),
        "n_dup_lines": repeated_lines(texts),
        "n_repeat_words": repeated_words(codes, offsets),
        "n_tokens": tokens,
        "n_byte_tokens": per_text(byte_tokens[codes]),
        "entropy": per_text(-share * np.log2(share), of),
    }


@functools.cache
def pieces_of(name: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=SparkFiles.get(name))


def measure(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with the measures of ``text`` by the piece vocabulary at ``path``, and its digest."""
    docs.sparkSession.sparkContext.addFile(path)
    name = path.rsplit("/", 1)[-1]
    rest = docs.drop(*COUNTS, "entropy").withColumn(
        DIGEST, F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    names = rest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                found = measures(text_of(part), pieces_of(name))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names],
                     *[pa.array(found[c].astype(np.int64)) for c in COUNTS],
                     pa.array(found["entropy"])], names=[*names, *COUNTS, "entropy"])

    schema = StructType(list(rest.schema.fields))
    for c in COUNTS:
        schema = schema.add(c, "long")
    return rest.mapInArrow(run, schema.add("entropy", "double"))


VALUES = ["_chars", "_bytes", "_entropy"]


def _middles(rows: DataFrame, *keys: str) -> DataFrame:
    """Number of texts, and of every measure the median and the narrower half of the box (rejects
    widen one side only)."""
    quart = [F.percentile_approx(v, [0.25, 0.5, 0.75], 1000).alias(f"{v}_q") for v in VALUES]
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *quart)
    halves = [F.least(q[2] - q[1], q[1] - q[0]) for q in (F.col(f"{v}_q") for v in VALUES)]
    return found.select(*keys, "_n", *[F.col(f"{v}_q")[1].alias(f"{v}_m") for v in VALUES],
                        *[h.alias(f"{v}_h") for v, h in zip(VALUES, halves)])


def _pooled(rows: DataFrame, keys: list[str], level: str, apart: bool) -> DataFrame:
    """Groups of classes or languages taken together, weighed by their texts. With ``apart`` the
    spread between their medians adds to the box."""
    n = F.sum("_n")
    out = [n.alias(f"_n{level}")]
    for v in VALUES:
        m, h = F.col(f"{v}_m"), F.col(f"{v}_h")
        middle = F.sum(m * F.col("_n")) / n
        half = F.sum(h * F.col("_n")) / n
        if apart:
            between = F.sum(m * m * F.col("_n")) / n - middle * middle
            half = half + 0.6745 * F.sqrt(F.greatest(between, F.lit(0.0)))
        out += [middle.alias(f"{v}_m{level}"), half.alias(f"{v}_h{level}")]
    return rows.groupBy(*keys).agg(*out)


def bands(texts: DataFrame) -> DataFrame:
    """Middle ``_m`` and half-width ``_h`` of every measure for each language and size class, with
    what is usual (``_u``) in the language. ``texts`` is stored; the tables made of it have a row
    per language and class."""
    fine = kept(_middles(texts, "_group", "_class"), "fertility-classes")
    whole = kept(_middles(texts, "_group"), "fertility-languages")
    around = fine.withColumn("_class", F.explode(F.array(*[F.col("_class") + i for i in (-1, 0, 1)])))
    near = _pooled(around, ["_group", "_class"], "1", False)
    language = whole.withColumnsRenamed({c: f"{c}2" for c in whole.columns if c != "_group"})
    alike = _pooled(fine, ["_class"], "3", True)
    every = _pooled(whole, [], "4", True).first()
    usual = fine.groupBy("_group").agg(*[
        (F.sum(F.col(f"{v}_h") * F.col("_n")) / F.sum("_n")).alias(f"{v}_u") for v in VALUES])
    joined = (fine.join(near, ["_group", "_class"]).join(language, "_group")
              .join(alike, "_class").join(usual, "_group"))

    def shrunk(name: str):
        out = F.lit(float(every[f"{name}4"] or 0.0))
        for level in ("3", "2", "1", ""):
            n = F.col(f"_n{level}")
            out = (n * F.col(f"{name}{level}") + WEIGHT * out) / (n + WEIGHT)
        return out.alias(name)

    return joined.select("_group", "_class", *[shrunk(f"{v}_{x}") for v in VALUES for x in "mh"],
                         *[f"{v}_u" for v in VALUES])


def verdicts(measured: DataFrame) -> DataFrame:
    """``measured`` with ``base_failed`` and ``kept``. ``measured`` should be stored: it is read
    once for the bands and once for the verdicts."""
    rows, back = aside(measured.drop("base_failed", "kept"),
                       ["doc_id", "text", "lang", DIGEST, *COUNTS, "entropy"])
    names = rows.columns
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    rows = rows.select(
        *names, base.alias("base_failed"),
        F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("_group"),
        F.floor(F.log2(F.col("n_tokens") + 1)).cast("int").alias("_class"),
        (F.col("word_chars") / F.expr("nullif(n_tokens, 0)")).alias("_chars"),
        (F.col("n_byte_tokens") / F.expr("nullif(n_tokens, 0)")).alias("_bytes"),
        F.col("entropy").alias("_entropy"))
    # copies, quartiles and counts merge, so a hot text or language is summed up where it is read
    texts = kept(rows.where("n_tokens > 0").groupBy("_group", "_class", DIGEST).agg(
        *[F.first(v).alias(v) for v in VALUES]), "fertility-texts")
    banded = lookup_join(rows, bands(texts), ["_group", "_class"], names[:1])

    def off(value: str, low: float | None, high: float | None, floor: float):
        middle = F.col(f"{value}_m")
        half = F.greatest(f"{value}_h", USUAL * F.col(f"{value}_u"))
        spread = F.greatest(half / 0.6745, NARROWEST * middle, F.lit(floor))
        out = F.lit(False)
        if low is not None:
            out = out | (F.col(value) < middle - low * spread)
        if high is not None:
            out = out | (F.col(value) > middle + high * spread)
        return F.coalesce(out, F.lit(False))

    odd = (off("_chars", CHARS_BAND, CHARS_BAND, 0.01) | off("_bytes", None, BYTE_BAND, 0.01)
           | off("_entropy", ENTROPY_BAND, None, 0.01))
    return back(banded, "base_failed", (~F.col("base_failed") & ~odd).alias("kept"))
