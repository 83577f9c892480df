import pytest
from edge_rows import EDGE


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text, source) rows, with two columns of awkward names."""
    def make(rows):
        rows = [(r[0], r[1], r[2] if len(r) > 2 else "s", "x", 1) for r in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, source string, _digest string, _KEY int")

    return make


@pytest.fixture
def edge(docs_of):
    return docs_of(EDGE)


@pytest.fixture
def empty(docs_of):
    return docs_of([])
