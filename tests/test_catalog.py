"""Every registered SQL query at the smallest scale, against DuckDB."""

import os

import pytest

import __spark_entry__ as spark_entry
from tools import check_oracle

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables absent")


@pytest.fixture(scope="module")
def con():
    return check_oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(spark_entry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    df = spark_entry.queries()[name](spark, SF)
    cur = con.execute(spark_entry.oracle_sql()[name])
    problem = check_oracle.compare(df.columns, [tuple(r) for r in df.collect()], [d[0] for d in cur.description], cur.fetchall())
    assert problem is None, problem


def test_every_sql_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    out = spark_entry.entry(spark)
    assert out.columns == ["Store", "n", "wmae"] and out.count() > 0
