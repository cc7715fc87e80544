import pytest

ODD = [
    (1, "", "en", "a", 0),
    (2, None, None, None, None),
    (None, "A text without an id, of some ten words or so it says.", "en", "a", 1),
    (3, "same line here, long enough to compare\nsame line here, long enough to compare", "fr", "b", 1),
    (4, "the quick brown fox jumps over the lazy dog and runs away from it all", "en", "a", 1),
    (5, "the quick brown fox jumps over the lazy dog and runs away from it all", "en", "a", 1),
    (5, "the quick brown fox jumps over the lazy dog and runs away from it all", "en", "a", 1),
    (6, "x" * 300_000 + " " + "word " * 60_000, "en", "a", 1),
    (7, "  \n\t \r\n ", "de", "c", 1),
    (8, "日本語 の テスト ééé Σας <|endoftext|> 🙂 a\u00a0b", "ja", "c", 1),
    (9, "one two", "en", "c", 1),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, ties, a repeated row, and extra columns with names used inside."""
    frame = spark.createDataFrame(ODD, SCHEMA)
    return frame.selectExpr("*", "1 AS row", "'x' AS key", "2 AS n", "3 AS start", "'y' AS kept", "4 AS node", "5 AS version")


@pytest.fixture(scope="session")
def none(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
