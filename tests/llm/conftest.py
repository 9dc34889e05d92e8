import pytest

LONG = " ".join(f"word{i % 977} tail{i % 13}." for i in range(30_000))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty and very long texts, repeated rows, an extra column with a clashing name."""
    rows = [
        (1, None, "en", "s", 0, "x"), (2, "", None, "s", 0, "x"), (3, " \n\t ", "en", None, None, None), (None, "a row without id. It is short.", "en", "s", 30, "x"),
        (4, "same text twice. password=0123456789abcdef01 ends it.", "en", "s", 54, "x"), (4, "same text twice. password=0123456789abcdef01 ends it.", "en", "s", 54, "x"),
        (5, LONG, "en", "s", len(LONG), "x"), (6, LONG + " more", "de", "t", len(LONG) + 5, "x"), (7, "ein Wörterbuch für späße. " * 30, "de", "t", 780, "y"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")


@pytest.fixture(scope="session")
def small(spark):
    return "/root/testdata/sf0.001"
