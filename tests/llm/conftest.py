from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use for their own columns; a table may have them too.
CLASHES = (
    "kept", "score", "predicted", "fingerprint", "spans", "items", "n_words", "row", "d", "t", "i", "a", "b", "key",
    "shard", "slot", "size", "node", "unit", "bits", "ids", "text_key", "n_lines", "N_COPIES", "lang_pred", "way", "rest", "line", "first",
)


def words(seed: int, n: int, size: int = 400) -> str:
    """``n`` words of a vocabulary of ``size``, a sentence a line."""
    rng = random.Random(seed)
    made = ["".join(rng.choice("abcdefgéß") for _ in range(rng.randint(2, 9))) for _ in range(size)]
    text = [rng.choice(made) for _ in range(n)]
    return "\n".join(" ".join(text[i : i + 12]) + "." for i in range(0, n, 12))


@pytest.fixture(scope="session")
def edge_rows() -> list[tuple]:
    """NULLs in any column, empty, blank and very long texts, ties and rows that repeat."""
    text = words(1, 200)
    long = words(2, 30_000)
    rows = [
        (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t \n", "en", "s", 5), (4, "a", "en", "s", 1),
        (5, text, "en", "s", len(text)), (6, text, "en", "s", len(text)), (6, text, "en", "s", len(text)),
        (7, long, "de", "s", len(long)), (8, text + " end", "en", None, None), (None, text, None, "s", None),
        (None, None, None, None, None), (9, words(3, 300), "fr", "s", 1), (10, "\x00 ümlaut <|endoftext|> 漢字 😀", "de", "s", 2),
    ]
    return rows


@pytest.fixture(scope="session")
def edge(spark, edge_rows):
    """The edge rows, with a column of every name that operators use."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows, SCHEMA)
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in CLASHES])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
