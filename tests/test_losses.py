"""Rows, files and documents that used to vanish without a word."""

import gzip
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.operators import inventory, lines
from spendlake.operators.ids import ids_frame, matches_any_id
from spendlake.sources.accounts import collect_accounts
from spendlake.sources.exports import _tagged, find_exports, read_exports
from spendlake.sources.tables import read_table
from spendlake.streaming.ingest import ingest_incremental

SCHEMA = T.StructType([T.StructField("n", T.LongType())])


def test_files_of_any_age_are_ingested(spark, tmp_path):
    source, target, state = (str(tmp_path / d) for d in ("source", "target", "state"))
    spark.range(3).select(F.col("id").alias("n")).coalesce(1).write.parquet(source)

    def run():
        ingest_incremental(spark, source, target, state, SCHEMA, partition_by=None)
        return spark.read.parquet(target).count()

    assert run() == 3
    spark.range(4).select(F.col("id").alias("n")).coalesce(1).write.mode("append").parquet(source)
    newest = max((tmp_path / "source").glob("*.parquet"), key=os.path.getmtime)
    old = time.time() - 30 * 86400
    os.utime(newest, (old, old))
    assert run() == 7


def test_ingest_leaves_status_files_out(spark, tmp_path):
    good, status = tmp_path / "s" / "a", tmp_path / "s" / "cost_and_usage_data_status"
    for folder in (good, status):
        spark.range(3).select(F.col("id").alias("n")).write.parquet(str(folder))
    target = str(tmp_path / "t")
    ingest_incremental(spark, f"{tmp_path}/s/*", target, f"{tmp_path}/c", SCHEMA, partition_by=None)
    assert spark.read.parquet(target).count() == 3


def test_files_beside_partitions_are_an_error(spark, tmp_path):
    rows = spark.range(4).select(F.col("id").alias("n"), (F.col("id") % 2).alias("k"))
    rows.write.partitionBy("k").parquet(str(tmp_path / "t"))
    schema = T.StructType([*SCHEMA.fields, T.StructField("k", T.LongType())])
    assert read_table(spark, f"{tmp_path}/t", schema).count() == 4
    rows.drop("k").write.parquet(str(tmp_path / "t" / "more"))
    with pytest.raises(ValueError, match="beside the partitions"):
        read_table(spark, f"{tmp_path}/t", schema)


@pytest.mark.parametrize("more", [0, 60])
def test_ids_match_alike_at_any_length(spark, more):
    rows = spark.createDataFrame([("x-ri-1",), ("x-ri-2",), ("",), (None,)], "arn string")
    ids = ["ri-1", "", None, *(f"none-{i}" for i in range(more))]
    assert [r.arn for r in matches_any_id(rows, "arn", ids).collect()] == ["x-ri-1"]


def test_many_ids_are_planned_at_once(spark):
    began = time.time()
    assert ids_frame(spark, [f"id-{i}" for i in range(20_000)]).count() == 20_000
    assert time.time() - began < 10


def _export(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    with gzip.open(folder / name, "wt", newline="") as f:
        f.write(text)


def test_malformed_exports_are_rejected_whole(spark, tmp_path):
    _export(tmp_path / "m", "good.csv.gz", 'a,b\n1,"x\ny"\n2,z\n3\n')
    _export(tmp_path / "m", "open.csv.gz", 'a,b\n1,"x\n2,y\n3,z\n')
    _export(tmp_path / "m", "wide.csv.gz", "a,b\n1,x\n2,y,z\n")
    exports = read_exports(spark, find_exports(spark, str(tmp_path)))
    assert exports.lines.count() == 3
    assert sorted(r.path.rsplit("/", 1)[1] for r in exports.rejected.collect()) == [
        "open.csv.gz",
        "wide.csv.gz",
    ]


def test_accounts_without_files_or_with_one_directory(spark, tmp_path):
    _export(tmp_path / "b" / "one", "x.csv.gz", "a\n1\n")
    kind = "aws_id string, bucket string, monthly_dir string"
    registry = spark.createDataFrame(
        [("1", str(tmp_path / "b"), "one"), ("2", str(tmp_path / "b"), "two")], kind
    )
    found = collect_accounts(spark, registry)
    assert found.lines.collect()[0].source_account_id == "1"
    assert [r.problem for r in found.rejected.collect()] == ["no such directory"]
    shared = spark.createDataFrame(
        [("1", str(tmp_path / "b"), "one"), ("2", str(tmp_path / "b"), "/one/")], kind
    )
    with pytest.raises(ValueError, match="accounts 1 and 2"):
        collect_accounts(spark, shared)


def test_tags_of_many_folders(spark):
    paths = [f"file:/r/{a}/d{i}/x.csv" for a in range(2_000) for i in range(10)]
    rows = spark.range(1).withColumn("__folder", F.lit("file:/r/7/d3"))
    began = time.time()
    tagged = _tagged(spark, rows, paths, {f"/r/{a}": str(a) for a in range(2_000)}, "account")
    assert time.time() - began < 5
    assert tagged.collect()[0].account == "7"


def test_malformed_documents_are_listed(spark):
    good = '{"Resources":[{"Arn":"a","Region":"r","OwningAccountId":"1","ResourceType":"t"}]}'
    documents = [good, good[:-4], '{"Other":1}', '{"Resources":[]}', "{}"]
    rows = spark.createDataFrame([(d,) for d in documents], "value string")
    found = {r.value for r in inventory.malformed_documents(rows).collect()}
    assert found == {good[:-4], '{"Other":1}'}


def test_repeated_keys_of_lookups_repeat_nothing(spark):
    kind = "Arn string, Region string, OwningAccountId string, ResourceType string"
    rows = spark.createDataFrame([("arn:a:b:c:2:d", "r", "1", "t")], kind)
    aliases = spark.createDataFrame([("1", "b"), ("1", "a")], "account_id string, alias string")
    found = inventory.untagged_resources(rows, [("r", "R"), ("r", "S")], aliases, ["t"]).collect()
    assert [(r.region_label, r.account) for r in found] == [("R", "HK-a")]


def test_unparsable_cells_are_counted(spark):
    rows = spark.createDataFrame(
        [("2025-06-01 00:00:00", "1.5"), ("06/01/2025", "1,234.5"), ("", None)], "t string, c string"
    )
    found = {r["column"]: (r.unparsable, r.present) for r in lines.unparsable_counts(rows, ["t"], ["c"]).collect()}
    assert found == {"t": (1, 2), "c": (1, 2)}
