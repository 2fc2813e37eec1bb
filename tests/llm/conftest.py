import pytest

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    """documents of (doc_id, text) pairs, or of longer tuples."""

    def make(rows, schema=DOCUMENTS):
        full = [(*r, *("en", "s", len(r[1] or ""))[len(r) - 2 :]) for r in rows] if schema == DOCUMENTS else rows
        return spark.createDataFrame(full, schema)

    return make
