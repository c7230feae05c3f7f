import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, score double, label int, item_id long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table with extra columns whose names clash with those of the operators."""

    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        rows = [(i, t, "en", "src0", None if t is None else len(t), "x", -1.0, 9, 9) for i, t in zip(ids, texts, strict=True)]
        return spark.createDataFrame(rows, SCHEMA)

    return make
