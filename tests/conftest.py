import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from bench import session  # noqa: E402

# Started on import: test modules hold column expressions, which need a session.
SESSION = session("4")


@pytest.fixture(scope="session")
def spark():
    return SESSION


@pytest.fixture
def values(spark):
    """Evaluate column expressions on one row and give back the values."""
    def run(data: dict, *columns):
        schema = ", ".join(f"{k} string" for k in data)
        df = spark.createDataFrame([tuple(data.values())], schema)
        return list(df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).collect()[0])

    return run
