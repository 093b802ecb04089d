import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) rows, spread over a few partitions."""
    def make(rows, parts=3):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make
