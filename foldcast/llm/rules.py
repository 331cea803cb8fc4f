"""Document quality by a sparse rule ensemble.

Statistics of every document are measured in one pass. On the labelled sample a small forest is
grown; every path from a root to a node is a conjunctive rule. A lasso logistic regression keeps
few of them, and the rules that keep a weight are compiled into one Spark column over the
statistics, which scores all documents.

Defined results: a NULL text counts as empty; all statistics of an empty text are 0, so it is
scored like any other row; without labels of both kinds the score is the share of label 1 (0.5
without any); repeated rows score alike; an empty table gives no rows. Input columns named like
an output column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from foldcast.llm.fertility import repeated_lines, repeated_words
from foldcast.llm.words import chunks, coded, owners, split, text_of

STATISTICS = ["words_log", "word_chars", "long_words", "distinct_words", "top_word",
              "repeated_words", "repeated_lines", "upper_share", "digit_share", "symbol_share",
              "punctuation_share", "bare_words", "symbol_ends", "line_words", "word_entropy"]
TREES, DEPTH, LASSO = 24, 3, 0.002


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """Shares and means over the words and letters of each text."""
    words, offsets = split(texts)
    codes, distinct = coded(words)
    n, owner = len(texts), owners(offsets)
    count = np.diff(offsets)
    safe = np.maximum(count, 1)

    def mean(values: np.ndarray) -> np.ndarray:
        """Mean over a text's words of a value of each different word."""
        return np.bincount(owner, weights=values[codes], minlength=n) / safe

    def array(values) -> np.ndarray:
        return values.to_numpy(zero_copy_only=False).astype(float)

    chars = array(pc.utf8_length(distinct))
    letters = np.maximum(np.bincount(owner, weights=chars[codes], minlength=n), 1)

    def letter_share(pattern: str) -> np.ndarray:
        values = array(pc.count_substring_regex(distinct, pattern))
        return np.bincount(owner, weights=values[codes], minlength=n) / letters

    kinds, times = np.unique(owner * max(1, len(distinct)) + codes, return_counts=True)
    of = kinds // max(1, len(distinct))
    share = times / safe[of]
    top = np.zeros(n)
    np.maximum.at(top, of, share)
    lines = array(pc.count_substring(texts, "\n")) + 1
    return {
        "words_log": np.log1p(count),
        "word_chars": mean(chars),
        "long_words": mean((chars > 12).astype(float)),
        "distinct_words": np.bincount(of, minlength=n) / safe,
        "top_word": top,
        "repeated_words": repeated_words(codes, offsets) / safe,
        "repeated_lines": repeated_lines(texts) / lines,
        "upper_share": letter_share(r"\p{Lu}"),
        "digit_share": letter_share(r"\p{Nd}"),
        "symbol_share": letter_share(r"[#*$%&|<>~^=+_\\{}@]"),
        "punctuation_share": letter_share(r"[.,;:!?]"),
        "bare_words": mean(array(pc.invert(pc.match_substring_regex(distinct, r"[\p{L}\p{N}]")))),
        "symbol_ends": mean(array(pc.match_substring_regex(distinct, r"[^\p{L}\p{N}]{2,}$"))),
        "line_words": np.log1p(count / lines),
        "word_entropy": np.bincount(of, weights=-share * np.log2(share), minlength=n)
        / np.log2(np.maximum(count, 2)),
    }


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with the statistics of ``text``."""
    rest = docs.drop(*STATISTICS)
    names = rest.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                found = statistics(text_of(part))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names],
                     *[pa.array(found[s].astype(float)) for s in STATISTICS]],
                    names=[*names, *STATISTICS])

    schema = StructType(list(rest.schema.fields))
    for s in STATISTICS:
        schema = schema.add(s, "double")
    return rest.mapInArrow(run, schema)


def paths(tree: str) -> set[str]:
    """The rules of one printed tree: SQL conditions on the way to each node below the root."""
    found, above = set(), []
    for line in tree.splitlines():
        test = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not test:
            continue
        depth = len(test[1])
        above = [(d, t) for d, t in above if d < depth]
        above.append((depth, (int(test[2]), test[3], float(test[4]))))
        found.add(_condition([t for _, t in above]))
    return found


def _condition(tests: list[tuple[int, str, float]]) -> str:
    """Tests on one statistic melt into its tightest bounds."""
    low, high = {}, {}
    for feature, sign, value in tests:
        if sign == ">":
            low[feature] = max(value, low.get(feature, value))
        else:
            high[feature] = min(value, high.get(feature, value))
    parts = [f"{STATISTICS[f]} > {v!r}D" for f, v in sorted(low.items())]
    parts += [f"{STATISTICS[f]} <= {v!r}D" for f, v in sorted(high.items())]
    return " and ".join(parts)


def fit(measured: DataFrame, sample: DataFrame, seed: int = 11) -> list[tuple[str, float]]:
    """Rules with their weights; the first entry is the constant, as the rule ``true``.

    ``measured`` has ``doc_id`` and the statistics; ``sample`` is bounded.
    """
    rows = measured.select("doc_id", *STATISTICS).join(F.broadcast(sample), "doc_id")
    rows = rows.select(F.col("label").cast("double").alias("label"), *STATISTICS).cache()
    counts = {int(r["label"]): r["n"] for r in
              rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        share = counts.get(1, 0) / total if total else 0.5
        return [("true", float(np.log((share + 1e-6) / (1 - share + 1e-6))))]
    vectors = rows.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, subsamplingRate=0.6,
                                    featureSubsetStrategy="onethird", seed=seed,
                                    minInstancesPerNode=5).fit(vectors)
    rules = sorted(set().union(*[paths(t.toDebugString) for t in forest.trees]))
    bits = F.array(*[F.expr(f"cast({r} as double)") for r in rules])
    table = rows.select("label", array_to_vector(bits).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=LASSO, standardization=False,
                               maxIter=60).fit(table)
    rows.unpersist()
    weights = lasso.coefficients.toArray()
    return [("true", float(lasso.intercept)),
            *[(r, float(w)) for r, w in zip(rules, weights) if w != 0]]


def compiled(rules: list[tuple[str, float]]) -> Column:
    """The ensemble as one column: the logistic function of the weights of the rules that hold."""
    total = F.expr(" + ".join(f"if({r}, {w!r}D, 0D)" for r, w in rules))
    return 1 / (1 + F.exp(-total))
