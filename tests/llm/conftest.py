import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "score double, n_tokens long, cls long, shard string, size string, words string")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table with extra columns whose names clash with results."""
    def build(rows):
        """rows: (doc_id, text[, lang[, source]])"""
        full = [(*r, *[None] * (4 - len(r)), 0, 0.5, 7, 7, "x", "y", "z") for r in rows]
        return spark.createDataFrame(full, SCHEMA)
    return build


LONG = "lorem ipsum dolor sit amet " * 20_000


@pytest.fixture(scope="session")
def messy(docs_of):
    """Nulls in every column, empty, blank and very long texts, repeated rows, a null id."""
    return docs_of([
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
        (1, "the quick brown fox jumps over the lazy dog again and again", "en", "a"),
        (2, None, None, None), (3, "", "de", "b"), (4, " \n\t ", "en", None), (None, "one two", None, "a"),
        (None, None, None, None), (5, LONG, "en", "b"), (6, "12345 !!! \U0001F600", None, ""),
        (7, "ĀĂ ſK İstanbul ǅ", "tr", "c"),
    ])
