import pytest

LONG = "lorem ipsum dolor sit amet " * 20000


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows, and columns whose names operators use themselves."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog", "en", "a", 1),
        (1, "The quick brown fox jumps over the lazy dog", "en", "a", 1),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (None, "Keine Schlüssel, aber ein Text", "de", "b", 9),
        (4, " \n\t ", "de", "b", 3),
        (5, LONG, "la", "c", len(LONG)),
        (6, "日本語のテキスト 🙂 é", None, "c", 5),
        (7, "12345 !!! ???", "en", "d", 5),
        (8, "The quick brown fox jumps over the lazy dog", "en", "z", 7),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("key", "k", "v", "p", "a", "b", "h", "fp", "ids", "root", "_key", "marks", "n", "score"):
        df = df.selectExpr("*", f"'x' AS `{name}`")
    return df


@pytest.fixture(scope="session")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")
