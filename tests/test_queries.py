"""Every registered query against its SQL, at the smallest scale."""

import pytest

import __spark_entry__ as entry
import compare
from tillhouse.plans.catalogue import QUERIES

SF = "/root/testdata/sf0.001"

# DuckDB's names of the types a result may have.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


# The operators of the training-data package have tests of their own.
NAMES = sorted(QUERIES)
# Their results are plain tables that loads have written.
LANDED = {
    "dimension_refresh", "dimension_refresh_all", "order_load", "backfill_by_window", "load_by_restaurant", "stream_cash_entries",
    "insert_by_index", "cash_load", "labor_load", "load_after_failure", "two_tenants_load", "backfill_resume", "empty_load",
    "load_stamp", "stream_rejects", "ndjson_export", "scd2_apply",
}


def test_all_are_registered():
    assert set(NAMES) <= set(entry.queries()) and set(NAMES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, SF)
    assert compare.differences(frame, con, entry.oracle_sql()[name]) is None
    described = con.execute(f"DESCRIBE {entry.oracle_sql()[name]}").fetchall()
    assert {f.name: TYPES[f.dataType.simpleString()] for f in frame.schema} == {d[0]: d[1] for d in described}


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()


@pytest.mark.parametrize("name", sorted(set(NAMES) - LANDED))
def test_no_python_in_the_plan(spark, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().toString()
    for word in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "CartesianProduct"):
        assert word not in plan
