"""Documents through the corpus operators, stage by stage; each stage is written and read again.

Every stage takes all documents that the stage before kept and returns their columns, so that
extra columns pass through whatever they are called. The last one returns the token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foldcast.llm import bpe, fertility, lines, mixing, neardup
from foldcast.llm.scratch import aside, kept

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and their language's fertility bands."""
    rows, back = aside(docs, ["doc_id", "text", "lang"])
    measured = kept(fertility.measure(rows, PIECES), "pipeline-measured")
    return back(fertility.verdicts(measured).where("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share; ``n_chars`` follows."""
    rows, back = aside(docs, ["doc_id", "text", "n_chars"])
    cut = lines.drop_shared_lines(rows)
    if "n_chars" in cut.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(dict(cut.dtypes)["n_chars"]))
    return back(cut)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    rows, back = aside(docs, ["doc_id", "text"])
    return back(neardup.keep_one(rows))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's share of the mix takes it."""
    rows, back = aside(docs, ["doc_id", "text", "source"])
    _, cuts = mixing.mix(rows)
    return back(mixing.apply_mix(rows, cuts))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, with the digest of what they decode to."""
    coded = bpe.round_trip(docs.select("doc_id", "source", "text"), WORD_BPE)
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("mix", mix_sources),
    ("encode", encode),
]
ORACLE_SQL = None  # the stages' samples, bands and encodings have no SQL; tests use brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
