import pytest

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, row string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents of (doc_id, text[, lang]), with columns whose names clash with those of the operators."""
    def make(rows):
        return spark.createDataFrame(
            [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or ""), "x", "y") for r in rows], DOCUMENTS)
    return make
