import pytest

KIND = "doc_id bigint, text string, lang string, source string, n_chars bigint, word string, key bigint, size bigint, _row bigint, u bigint, path string, license string"


@pytest.fixture(scope="session")
def documents(spark):
    """Make documents from (doc_id, text[, lang, source]) rows, with columns whose names operators use themselves."""

    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", 0, "w", 1, 2, 3, 4, "p", "l") for r in rows]
        return spark.createDataFrame(full, KIND)

    return make


@pytest.fixture(scope="session")
def labels(spark):
    return lambda rows: spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


LONG = "lorem ipsum dolor " * 40_000


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty, white and very long texts, ties and repeated rows."""
    return [(1, None), (2, ""), (3, " \n\t "), (None, "a text without an id"), (4, LONG), (5, "same text here twice over and over"), (6, "same text here twice over and over"), (6, "same text here twice over and over"), (7, "Ünïcödé ￿ \x00 text\x1c!"), (8, "word", None, None)]
