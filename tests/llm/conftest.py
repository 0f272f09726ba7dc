import pytest


@pytest.fixture
def docs_of(spark):
    """A documents frame of texts (ids 0, 1, ... unless given), with a clashing extra column."""

    def make(texts, ids=None):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "s", None if t is None else len(t), 1) for i, t in zip(ids, texts, strict=True)]
        kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words int"
        return spark.createDataFrame(rows, kinds)

    return make
