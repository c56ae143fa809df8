import pytest
from pyspark.sql import functions as F

ODD_DOCS = [
    (1, "The quick brown fox jumps over the lazy dog today", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, "   \n\t \n", "fr"),
    (5, "The quick brown fox jumps over the lazy dog today", "en"),
    (5, "The quick brown fox jumps over the lazy dog today", "en"),
    (6, "é" * 3000 + " ünïcödé 漢字 and 😀\n" * 50, "de"),
    (7, "word " * 20000, "en"),
    (8, "x" * 60000, "en"),
    (None, "a row without an id", "en"),
    (-9, "Negative id\nThe quick brown fox jumps over the lazy dog today\nend", "en"),
]


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns named like the operators' own."""
    df = spark.createDataFrame(ODD_DOCS, "doc_id long, text string, lang string")
    return (
        df.withColumn("n_chars", F.length("text").cast("long")).withColumn("source", F.lit("s"))
        .withColumn("score", F.lit("mine")).withColumn("n_lines", F.lit(3)).withColumn("hi", F.lit(1))
        .withColumn("component", F.lit("c")).withColumn("own", F.lit(0.5)).withColumn("print", F.lit(2))
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("1 = 0")
