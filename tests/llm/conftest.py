import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from texts, or from (doc_id, text) pairs; extra columns have names that operators use themselves."""

    def build(*texts, extra=""):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)

    return build
