import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) rows, with columns whose names
    the operators use themselves."""
    def make(rows, parts=3):
        full = [(d, t, "en", "s", None if t is None else len(t), "x", 1.5) for d, t in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, code string, score double").repartition(parts)
    return make
