"""Every registered query against its SQL, and the shape of its plan."""

import re
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry_points
from check_oracles import TABLES, rows_of, types_of
from predia.workload import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"
WITHOUT_SQL = set()
# What no plan may hold: a sort of whole groups in one task, all pairs of rows, rows sent to Python.
BANNED = re.compile(r"\bWindow\b|CartesianProduct|BroadcastNestedLoopJoin|EvalPython|InPandas|InArrow|CollectLimit|GlobalLimit")


@pytest.fixture(scope="module")
def database():
    base = duckdb.connect()
    for table in TABLES:
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return base


@pytest.mark.parametrize("name", QUERIES)
def test_query_equals_its_sql(spark, database, name):
    df = entry_points.queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not BANNED.search(plan), BANNED.search(plan)
    mine = df.toArrow()
    if name in WITHOUT_SQL:
        assert mine.num_rows > 0
        return
    theirs = database.sql(entry_points.oracle_sql()[name]).to_arrow_table()
    assert types_of(mine) == types_of(theirs)
    assert rows_of(mine) == rows_of(theirs)


def test_only_known_queries_lack_sql():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert not set(entry_points.oracle_sql()) - set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
