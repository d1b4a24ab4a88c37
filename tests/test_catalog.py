"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import TABLES, canonical, types_of

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = df.toPandas()
    sql = entry.oracle_sql()[name]
    assert dict(df.dtypes) == types_of(con, sql)
    assert canonical(got) == canonical(con.execute(sql).df())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
