"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    made = duckdb.connect()
    for t in TABLES:
        made.execute(f"CREATE VIEW {t} AS FROM '{FOLDER}/{t}.parquet'")
    return made


@pytest.mark.parametrize("name", list(entry_points.queries()))
def test_query_equals_sql(spark, con, name):
    mine = entry_points.queries()[name](spark, FOLDER).toPandas()
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert len(mine)
    else:
        assert differences(mine, con.sql(sql).df()) == ""


def test_entry_has_an_answer_for_every_question(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["query_id", "query", "answer"]
    assert df.count() == spark.read.parquet(f"{FOLDER}/benchmark.parquet").count()
