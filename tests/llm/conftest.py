import pytest

DOC_SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make_docs(spark):
    """A documents table from (doc_id, text[, lang, source]) tuples."""

    def make(rows, extra=""):
        full = [(*r, *(("en", "s")[len(r) - 2 :] if len(r) < 4 else ()))[:4] + (len(r[1] or ""),) for r in rows]
        return spark.createDataFrame(full, DOC_SCHEMA)

    return make


@pytest.fixture
def hard_rows():
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = "lorem ipsum dolor " * 20_000
    return [(1, None), (2, ""), (3, "   \n "), (4, long), (5, long), (6, "one two"), (6, "one two"), (None, "one two three four"), (None, None), (7, "aé \U0001f600 Z")]
