"""Every registered query against its SQL in DuckDB, on the smallest test data."""

import pytest
from compare import differences, open_duckdb

import __spark_entry__ as contract
from tillhouse.oracle import statements
from tillhouse.queries import REGISTRY

SF = "/root/testdata/sf0.001"
QUERIES = REGISTRY
ORACLE = statements()
# Writes every day of two years several times over; compare_all.py covers it.
SLOW = {"backfill_run", "unique_over_days"}


@pytest.fixture(scope="module")
def duck():
    return open_duckdb(SF)


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in SLOW])
def test_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    assert not differences(df, duck, ORACLE[name])


def test_every_query_has_a_statement():
    assert set(ORACLE) == set(QUERIES)


def test_contract_holds_every_query():
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


def test_entry(spark):
    assert contract.entry(spark).count() == 5697


def test_memory_of_a_task_does_not_grow_with_the_tables(spark, monkeypatch):
    """What a task sums up before the shuffle and what it reads from one are shares of fixed size; items are summed up once."""
    monkeypatch.setattr("tillhouse.queries._input_bytes", lambda *_: 6 * 1024**3)
    plan = REGISTRY["dq_summary"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert int(spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum")) >= 96
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "32m"
    # scans of the same columns under the same filters are shuffled once
    scans = [line.split("DataFilters: ")[1].split("], ")[0] for line in plan.splitlines() if "FileScan parquet [l_orderkey" in line]
    assert len(scans) == 3 and not any("date_add" in filters for filters in scans)
