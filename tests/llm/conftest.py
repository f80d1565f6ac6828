import pytest

from fieldgauge.llm.shipping import ship_code

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def spark(spark):
    return ship_code(spark)


@pytest.fixture
def documents(spark):
    """Documents from ``(doc_id, text, lang, source)`` rows."""

    def make(rows):
        return spark.createDataFrame([(i, t, g, s, None if t is None else len(t)) for i, t, g, s in rows], DOCUMENTS)

    return make
