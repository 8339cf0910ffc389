import pytest


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from rows (doc_id, text, lang, source), with n_chars and columns that clash with names inside."""

    def make(rows):
        full = [(i, t, lg, s, len(t) if t is not None else None, 7, "x", "y") for i, t, lg, s in rows]
        schema = "doc_id long, text string, lang string, source string, n_chars long, size long, words string, id string"
        return spark.createDataFrame(full, schema)

    return make
