import pytest


@pytest.fixture(scope="session")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty, blank and very long texts, repeated rows, and extra columns with clashing names."""
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(60_000))
    rows = [
        (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \t\n ", None, None, 4), (4, "one", "en", None, 3), (5, long, "en", "b", len(long)),
        (6, "Same Text here now and again", "en", "a", 28), (6, "Same Text here now and again", "en", "a", 28), (7, "same text HERE now and again", "en", "b", 28),
        (None, "same text here now and again", None, None, None), (8, "▁ a b c \0 \U0001f600 ▁▁ d", "de", "a", 17), (9, long, "en", None, 1),
    ]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return d.selectExpr("*", "1 as n", "'x' as value", "0 as th", "'y' as row", "2 as rank", "3 as _id", "'z' as component")
