"""Rows of every odd kind, as fixtures for the tests of this folder."""

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty, blank and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    base = " ".join(f"alpha{i} beta{i}" for i in range(40))
    return [
        (1, base, "en", "a", len(base)), (2, base, "en", "a", len(base)), (3, base + " tail", "en", "b", None),
        (3, base + " tail", "en", "b", None), (4, None, None, None, None), (5, "", "en", "a", 0), (6, " \n\t ", "en", None, 4),
        (7, "one two", "en", "a", 7), (8, "one two", "de", "a", 7), (None, "no id here", "en", "a", 10), (9, long, "en", "c", len(long)),
        (10, "12345 !!! ---", "fr", "a", 13), (50, "É漢😀 ñandú", "es", "a", 9), (11, "x" * 30_000, "en", "a", 30_000),
    ]


@pytest.fixture()
def edge_docs(spark, edge_rows):
    from pyspark.sql import functions as F

    # an extra column whose name clashes with names the operators use
    return spark.createDataFrame(edge_rows, DOCS).withColumn("n", F.lit(7)).withColumn("rep", F.lit("r")).withColumn("value", F.lit(1.5))


@pytest.fixture()
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
