import pytest


@pytest.fixture(scope="session")
def spark():
    from bench import session

    return session("4")


@pytest.fixture
def docs(spark):
    """A documents table from texts or (doc_id, text) pairs."""
    def make(rows, extra=""):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        return spark.createDataFrame(rows, "doc_id long, text string" + extra)

    return make
