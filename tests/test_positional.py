"""Partition keys that are directories by position."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from spendlake.sources import positional, schema, tables
from spendlake.sources.positional import folder_pattern, partition_folders, position_keys
from spendlake.streaming.ingest import ingest_incremental

KEYS = schema.PARTITION_KEYS
DATA = "line_item_line_item_type string, line_item_usage_start_date timestamp_ntz, line_item_unblended_cost double"


def write(spark, folder, n=1, cost=1.0):
    rows = [("Usage", datetime(2025, 6, 3), cost)] * n
    spark.createDataFrame(rows, DATA).coalesce(1).write.mode("append").parquet(str(folder))


@pytest.fixture
def root(spark, tmp_path):
    for account in ("0001", "0002"):
        for month in ("BILLING_PERIOD=2025-06", "2025-07"):
            write(spark, tmp_path / "cur" / account / "daily report" / "data" / month, n=int(account))
    write(spark, tmp_path / "cur" / "0001" / "daily report" / "cost_and_usage_data_status" / "2025-06")
    (tmp_path / "cur" / "notes.json").write_text("{}")
    os.makedirs(tmp_path / "cur" / "_temporary" / "0")
    return f"{tmp_path}/cur"


def read(spark, root, predicate=None):
    return tables.read_table(spark, root, predicate=predicate, positional=KEYS)


def test_keys_of_directories_by_position(spark, root):
    rows = read(spark, root)
    assert len(rows.columns) == 129 and rows.columns[-4:] == list(KEYS)
    counts = {tuple(r)[:4]: r["count"] for r in rows.groupBy(*KEYS).count().collect()}
    assert counts == {
        (a, "daily report", "data", m): int(a) for a in ("0001", "0002") for m in ("2025-06", "2025-07")
    }
    assert read(spark, f"file:{root}/").count() == 6


def test_predicates_prune_what_is_listed(spark, root):
    def listed(*predicates):
        counter = spark.sparkContext.accumulator(0)
        found = partition_folders(spark, root, KEYS, predicates, tables.EXCLUDED_PARTS, counter)
        return sorted(tuple(r)[1:] for r in found.collect()), counter.value

    every, n = listed()
    assert len(every) == 4 and n == 1 + 2 + 2 + 2  # the root, accounts, reports, the data of each
    one, n = listed("source_account_id = '0002'", "billing_period >= '2025-07'")
    assert one == [("0002", "daily report", "data", "2025-07")] and n == 4
    assert listed("source_account_id IN ('9')") == ([], 1)
    # A condition over several keys waits for the last of them.
    both, n = listed("source_account_id = '0001' OR billing_period = '2025-06'")
    assert len(both) == 3 and n == 7
    with pytest.raises(ValueError, match="other columns than the keys"):
        listed("line_item_unblended_cost > 0")
    with pytest.raises(Exception, match="PARSE"):
        listed("this is no SQL")


def test_only_folders_that_are_left_are_read(spark, root):
    rows = read(spark, root, ["source_account_id = '0002'", "billing_period < '2025-07'"])
    assert rows.count() == 2 and len(rows.inputFiles()) == 1
    none = read(spark, root, ["source_account_id = '0'"])
    assert none.count() == 0 and none.columns == rows.columns


def test_files_above_the_last_key_are_an_error(spark, root):
    write(spark, f"{root}/0002/daily report")
    with pytest.raises(ValueError, match="beside the partitions"):
        read(spark, root)
    assert read(spark, root, ["source_account_id = '0001'"]).count() == 2  # never seen


def test_names_with_odd_characters(spark, tmp_path):
    names = ["a b", "a+b", "50%", "x{1,2}", "q?*", "é", "a%3Ab", positional.NO_VALUE, "k=v=w", "[z]"]
    for name in names:
        write(spark, tmp_path / "t" / name / "m")
    root = f"{tmp_path}/t"
    rows = tables.read_table(spark, root, positional=("name", "month"))
    wanted = {"a b", "a+b", "50%", "x{1,2}", "q?*", "é", "a:b", None, "v=w", "[z]"}
    assert {r.name for r in rows.select("name").collect()} == wanted
    pattern = folder_pattern(partition_folders(spark, root, ("name", "month")), root, 2)
    globbed = spark.read.schema(DATA).parquet(pattern).select(*position_keys(root, ("name",)))
    assert {r.name for r in globbed.collect()} == wanted


def test_declared_with_positional_keys(spark, root):
    spark.sql("DROP TABLE IF EXISTS positional_cur")
    tables.create_table(spark, "positional_cur", root, positional=True)
    try:
        rows = tables.read_table(spark, "positional_cur", predicate="billing_period = '2025-06'")
        assert {r.source_account_id for r in rows.collect()} == {"0001", "0002"} and rows.count() == 3
        files = rows.inputFiles()
        assert len(files) == 2 and all("2025-06" in f for f in files)
    finally:
        spark.sql("DROP TABLE positional_cur")


def test_stream_with_positional_keys(spark, root, tmp_path):
    target, state = f"{tmp_path}/target", f"{tmp_path}/state"

    def run():
        ingest_incremental(
            spark, root, target, state, schema.cur_schema(),
            lambda new: new.select("line_item_line_item_type", "source_account_id", "billing_period"),
            "billing_period", positional=KEYS, predicates=["billing_period >= '2025-07'"],
        )
        rows = spark.read.parquet(target).groupBy("source_account_id", "billing_period").count()
        return {tuple(r) for r in rows.collect()}

    assert run() == {("0001", "2025-07", 1), ("0002", "2025-07", 2)}
    write(spark, f"{root}/0002/daily report/data/2025-07", n=5)
    write(spark, f"{root}/0003/r/data/2025-08")  # an account that was not there
    assert run() == {("0001", "2025-07", 1), ("0002", "2025-07", 7), ("0003", "2025-08", 1)}
    assert run() == {("0001", "2025-07", 1), ("0002", "2025-07", 7), ("0003", "2025-08", 1)}
