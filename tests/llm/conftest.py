import pytest
from pyspark.sql import functions as F

LONG = 2_500_000


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and columns with clashing names."""
    rows = [
        (1, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (2, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (2, "the quick brown fox jumps over the lazy dog", "en", "a", 43),
        (3, "", "en", "a", 0),
        (4, None, None, None, None),
        (None, "no id but text a@b.co", "en", None, 4),
        (None, None, None, None, None),
        (5, "   \n\t ", "en", "a", 6),
        (6, "x" * 30_000, "en", "b", 30_000),
        (7, "word " * (LONG // 5), "en", "b", LONG),
        (8, "Ünïcödé ñ 日本語 😀 +1 (017) 555-7713", "de", "b", 30),
        (9, "<|endoftext|> 's ''s it'll\n\n 1.2.3.4", "en", "b", 30),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    clashing = [
        "score", "fp", "ids", "block", "length", "n", "component_id", "__spans", "words", "bucket", "toxic", "rank", "size",
    ]
    return spark.createDataFrame(rows, schema).withColumns({name: F.lit("clash") for name in clashing})


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def some_docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
