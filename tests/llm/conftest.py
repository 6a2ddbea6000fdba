import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, fp string, mark string, k string"


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, repeated
    rows, and columns whose names clash with the operators' own."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    same = "alpha beta gamma delta " * 20
    rows = [(0, same, "en", "a"), (1, same.replace(" ", "  "), "en", "a"), (2, same, None, None), (2, same, None, None),
            (3, None, "en", "b"), (4, "", "en", "b"), (5, " \t\n ", "fr", "b"), (6, "one", "fr", None),
            (7, "One two", None, "c"), (8, long, "en", "a"), (9, long + " x", "en", "c"), (10, "x" * 70_000, "de", "c"),
            (None, "a null id\nsecond line\nthird line", "de", "a"), (11, "a null id\nsecond line\nthird line\nfourth", "de", "a"),
            (None, None, None, None), (12, "It's  café — naïve\x1c\x1dz <|endoftext|> 日本 42nd x", "fr", "a"),
            (13, "same line\nsame line\nother\nsame line", "es", "a"), (-14, "negative", "es", "\U0001f600")]
    return spark.createDataFrame([(i, t, g, s, None if t is None else len(t), "7", "f", "m", "k") for i, t, g, s in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def vocabulary():
    from spindex.llm.catalog import vocabulary
    return vocabulary()
