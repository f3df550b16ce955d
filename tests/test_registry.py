"""Every registered query against its SQL, whole results."""

import check
import pytest

import __spark_entry__ as entry_module
from spendlake.registry import QUERIES

SMALL = "/root/testdata/sf0.001"
CHECKED = "/root/testdata/sf0.01"

# Their SQL reads footers of the directory that it names.
BY_PATH = {"storage_profile", "storage_totals", "storage_report", "row_and_file_counts", "directory_sizes"}


@pytest.fixture(scope="module")
def connections():
    return {d: check.connect(d) for d in (SMALL, CHECKED)}


def test_names_match():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connections, name):
    sf_dir = CHECKED if name in BY_PATH else SMALL
    expected = check.sql_rows(connections[sf_dir], entry_module.oracle_sql()[name])
    result = entry_module.queries()[name](spark, sf_dir)
    assert check.spark_rows(result) == expected
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("name", ["ri_report", "sp_report", "sp_account_plan_detail", "sp_totals"])
def test_lines_are_read_once(spark, name):
    result = entry_module.queries()[name](spark, SMALL)
    result.collect()
    plan = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan parquet") == 2  # lineitem and orders
    assert name == "sp_totals" or "ReusedExchange" in plan


def test_entry(spark):
    rows = entry_module.entry(spark)
    assert rows.columns == ["line_item_line_item_type", "n", "cost"]
    assert rows.count() > 0
