import pytest

LONG = "The long road of the old town was in the rain. " * 3000
COPY = "one two three four five six seven eight nine ten eleven twelve " * 6
WORDS = [
    "alpha", "bravo", "charlie", "delta", "echo", "foxtrot", "golf", "hotel", "india", "juliet",
    "kilo", "lima", "mike", "november", "oscar", "papa", "quebec", "romeo", "sierra", "tango",
]


def sentence(seed: int, n: int = 80) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 7))
    return "The " + " ".join(out) + ".\nShared line\n"


@pytest.fixture(scope="session")
def odd_rows():
    """NULLs in every column, empty and long texts, copies, repeated rows, ties, odd characters."""
    rows = [
        (1, "", "en", "a"), (2, None, "en", "a"), (3, LONG, "en", "b"), (4, COPY, None, None),
        (5, COPY, "de", None), (5, COPY, "de", None), (None, COPY, "de", "b"), (None, None, None, None),
        (6, "   \n\t\n ", "fr", "c"), (7, "### $$$ | |", "fr", "c"), (8, "x" * 50_000, "en", "c"),
        (9, "中文 текст ñandú 😀   Σας", "es", "d"), (10, "<|endoftext|>ab'll 12<|ENDOFTEXT|>", "en", "d"),
        (11, "a\nA \n a\nb\n\n", "en", "a"), (12, "\r\n\x0b\x0c x", "en", "a"),
    ]
    rows += [(100 + i, sentence(i), "en", "s" + str(i % 3)) for i in range(40)]
    rows += [(200 + i, sentence(5).replace("echo", "echo", 1) + f" tail{i}", "en", "s0") for i in range(6)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    """The odd rows with columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    names = ["shard", "slot", "size", "n_words", "_part", "u", "key", "bands", "copy", "score",
             "ids", "doc", "_copies", "n_lines", "kept", "words", "a b"]
    df = spark.createDataFrame(odd_rows, SCHEMA).repartition(3)
    return df.withColumns({n: F.lit(i) for i, n in enumerate(names)}).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
