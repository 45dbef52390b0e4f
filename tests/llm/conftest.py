from __future__ import annotations

import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int"


def text_of(seed: int, n: int) -> str:
    rng = random.Random(seed)
    words = ["the", "of", "aread", "énter", "thing", "over", "under", "straße", "house", "river", "Stone", "cloud", "año"]
    return " ".join(rng.choice(words) + rng.choice(["", "", "", ".", ",", "\n"]) for _ in range(n))


def edge_rows():
    """Nulls in every column, empty, blank and very long texts, repeated rows, ties."""
    base = text_of(1, 200)
    near = base.replace("river", "lake", 1)
    texts = [base, near, base, "", None, "  \n\t ", "one", "one two", "one two three", text_of(2, 60), text_of(3, 30000),
             "same line\nsame line\n" + text_of(4, 80), "word " * 120, "é😀 ▁x  y\r\n", "A B C D", "a b c d"]
    rows = [(i, t, "en" if i % 3 else None, [None, "s1", "s2", "s3"][i % 4], None if i % 5 == 0 else len(t or ""))
            for i, t in enumerate(texts)]
    return rows + [rows[9], rows[9], (None, text_of(5, 70), None, None, None)]


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(edge):
    """Extra columns named like the operators' own outputs and working columns, in other cases too."""
    from pyspark.sql import functions as F

    names = ["SIZE", "target", "taken", "source_size", "ids", "base", "spans", "linked", "q", "votes", "kept", "n_words", "row",
             "id", "fingerprint", "n_tokens", "mix_key", "candidates", "pii_text", "score"]
    return edge.select("*", *[F.lit("x").alias(n) for n in names])
