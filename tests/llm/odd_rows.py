"""Fixtures: rows that every operator must handle."""

import pytest

EDGES = [
    (1, "One plain sentence of words that says nothing at all.", "en", "a"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n ", "fr", "b"),
    (5, "word", "en", "a"),
    (6, "été déjà où 😀 naïve", "fr", "b"),
    (None, "A row without a number, but with words.", "en", None),
    (8, "One plain sentence of words that says nothing at all.", "en", "a"),
    (8, "One plain sentence of words that says nothing at all.", "en", "a"),
    (9, "long " * 40_000, "en", "c"),
]


@pytest.fixture(scope="session")
def edges(spark):
    """Nulls, empty, blank and long texts, repeated rows, and columns with clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(EDGES, "doc_id long, text string, lang string, source string")
    clash = ("score", "lang_pred", "secrets", "node", "hub", "keys", "size", "spans", "media", "toxicity", "_key", "n_chars")
    return df.withColumns({c: F.lit(7).cast("long") for c in clash})


@pytest.fixture(scope="session")
def nothing(edges):
    return edges.where("false")


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
