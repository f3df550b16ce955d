import json
import os
import random

from pyspark.sql import functions as F

from spendlake.operators import inventory as I
from spendlake.operators import profile as P
from spendlake.plans import profiling, untagged
from spendlake.registry import inventory as queries
from spendlake.sinks.documents import write_documents
from spendlake.sources import files, footers, lists


def resource(arn, region="ap-east-1", owner="1", kind="s3:bucket"):
    return {"Arn": arn, "Region": region, "OwningAccountId": owner, "ResourceType": kind}


RESOURCES = [
    resource("arn:aws:s3:::b"),
    resource("arn:aws:ec2:r:1:res/2", "ap-southeast-1", "2", "ec2:volume"),
    resource("arn:aws:ec2:r:851805:res/3"),
    resource("arn:aws:s3:::c", owner="851805"),
    resource("arn:aws:s3:::d", region="us-east-1"),
    resource("arn:aws:iam:::e", kind="iam:role"),
    resource("arn:aws:s3:::cf-templates-f"),
    resource("arn:aws:s3:::aws-tagging-automation"),
    resource("x"),
]


def write_inventory(root):
    root.mkdir()
    (root / "a.notag").write_text(json.dumps({"Resources": RESOURCES}, indent=2))
    (root / "b.notag").write_text('{"a"}\n'[:6])
    (root / "c.notag").write_text(json.dumps({"Resources": []}))
    (root / "d.other").write_text(json.dumps({"Resources": RESOURCES}))


def aliases(spark):
    return spark.createDataFrame([("1", "shop")], "account_id string, alias string")


def test_untagged_report(spark, tmp_path):
    write_inventory(tmp_path / "in")
    alert = untagged.run(spark, f"{tmp_path}/in", f"{tmp_path}/out", aliases(spark)).first()
    lines = [r.value for r in spark.read.text(f"{tmp_path}/out").collect()]
    assert lines == [
        "Region * Account ***** No migration tag resource.",
        "HK    HK-shop             arn:aws:s3:::b",
        "HK    HK-shop             x",
        "SG    HK-2                arn:aws:ec2:r:1:res/2",
    ]
    assert alert.n_resources == 3 and alert.should_alert
    assert alert.report_length == sum(len(line) + 1 for line in lines)


def test_nothing_untagged_is_no_alert(spark):
    none = spark.createDataFrame([], "region_label string, account string, arn string")
    assert tuple(I.should_alert(none).first()) == (0, 50, False)


def test_documents_by_suffix(spark, tmp_path):
    write_inventory(tmp_path / "in")
    assert I.flatten_resources(lists.read_inventory(spark, f"{tmp_path}/in")).count() == 9
    assert I.flatten_resources(lists.read_inventory(spark, f"{tmp_path}/in", ".other")).count() == 9


def test_lists_as_tables(spark):
    frame = spark.createDataFrame([tuple(r.values()) for r in RESOURCES], list(RESOURCES[0]))
    kinds = spark.createDataFrame([("iam:role",)], "t string")
    regions = spark.createDataFrame([("ap-east-1", "HK")], "region string, label string")
    rows = I.untagged_resources(frame, regions, aliases(spark), kinds, ()).collect()
    assert [r.arn for r in rows] == ["arn:aws:iam:::e"]


def test_short_arn(spark):
    frame = spark.createDataFrame([("x",), ("arn:aws:s3:::b",), ("a:b:c:d:e:f",)], "a string")
    got = [r[0] for r in frame.select(I.arn_account(F.col("a"))).collect()]
    assert got == [None, "", "e"]


def test_monitored_types():
    assert len(I.MONITORED_TYPES) == len(set(I.MONITORED_TYPES)) == 40


def test_column_profile(spark):
    rows = [(1, "aé", float("nan"), {"k": "v"}), (2, None, 1.0, None), (None, "b", None, {})]
    frame = spark.createDataFrame(rows, "a int, `b.c` string, d double, m map<string,string>")
    got = {r.column: r for r in P.column_profile(frame).collect()}
    assert {c: (r.nulls, r.value_bytes) for c, r in got.items()} == {
        "a": (1, 8), "b.c": (1, 4), "d": (2, 16), "m": (1, 11),
    }
    assert round(sum(r.share_percent for r in got.values()), 9) == 100
    assert got["a"].n_rows == 3 and round(got["a"].null_percent, 3) == 33.333


def test_profile_of_nothing(spark):
    frame = spark.createDataFrame([], "a int, b string")
    assert [(r.nulls, r.value_bytes, r.null_percent) for r in P.column_profile(frame).collect()] == [
        (0, 0, 0.0), (0, 0, 0.0),
    ]


def test_null_profile_order(spark):
    frame = spark.createDataFrame([(None, 1, None)] * 2, "b int, a int, c int")
    assert [r.column for r in P.null_profile(frame, 2).collect()] == ["b", "c"]
    wide = spark.range(5).select(*(F.lit(None).cast("int").alias(f"c{i:03}") for i in range(125)))
    assert P.null_profile(wide).count() == 10


def test_footers_by_full_path(spark, tmp_path):
    r = random.Random(0)
    rows = [(i, {f"k{r.randrange(9)}": "v" * i}, {"z": 1.0}) for i in range(300)]
    frame = spark.createDataFrame(rows, "i long, tags map<string,string>, discount map<string,double>")
    for part in range(3):
        frame.repartition(2).write.mode("append").parquet(f"{tmp_path}/t/p={part}")
    chunks = footers.read_footers(spark, f"{tmp_path}/t")
    profile = {r.column: r for r in P.storage_profile(chunks).collect()}
    assert sorted(profile) == [
        "discount.key_value.key", "discount.key_value.value", "i", "tags.key_value.key",
        "tags.key_value.value",
    ]
    assert profile["i"].num_values == 900 and profile["i"].physical_type == "INT64"
    totals = P.storage_totals(chunks).first()
    assert totals.n_rows == 900
    assert totals.compressed == sum(r.compressed for r in profile.values())
    assert totals.ratio == totals.uncompressed / totals.compressed


def test_whole_profile(spark, tmp_path):
    spark.range(50).withColumn("t", F.lit("x")).write.parquet(f"{tmp_path}/t")
    p = profiling.run(spark, f"{tmp_path}/t")
    assert tuple(p.shape.first()) == (50, 2)
    assert [r.column for r in p.value_bytes.collect()] == ["id", "t"]
    assert {r.type: r.n_columns for r in p.types.collect()} == {"bigint": 1, "string": 1}
    assert p.storage_totals.first().n_rows == 50
    sizes = files.file_sizes(p.files).first()
    assert sizes.n_files == p.files.count() and sizes.n_bytes > 0
    assert [r.column for r in p.storage_report.collect()][-1] == "TOTAL"
    assert [r.size for r in p.report.collect()] == ["400.00 B", "50.00 B"]
    assert p.nulls.count() == 2
    assert profiling.run(spark, f"{tmp_path}/t", 7).shape.first().n_rows == 7


def test_documents_as_files(spark, tmp_path):
    values = ["{}", "", None, "{}", "a\nü"]
    rows = spark.createDataFrame([(v,) for v in values], "value string").repartition(3)
    assert write_documents(rows, f"{tmp_path}/out") == 5
    found = sorted(open(f"{tmp_path}/out/{n}", encoding="utf-8").read() for n in os.listdir(f"{tmp_path}/out"))
    assert found == ["\n", "\n", "a\nü\n", "{}\n", "{}\n"]
    assert write_documents(rows.limit(0), f"{tmp_path}/none") == 0
    assert lists.read_inventory(spark, f"{tmp_path}/none", ".txt").count() == 0


def test_small_files_are_written_by_many_tasks(spark, tmp_path, monkeypatch):
    events = [(i, 7, "view", '{"k": 1}') for i in range(3)]
    spark.createDataFrame(events, "event_id long, user_id long, event_type string, props string").write.parquet(
        f"{tmp_path}/sf/events.parquet"
    )
    keys = spark.createDataFrame([(i,) for i in range(40)], "s_suppkey long").coalesce(1)
    keys.write.parquet(f"{tmp_path}/sf/supplier.parquet")
    monkeypatch.setattr(queries, "FILES_PER_TASK", 5)
    monkeypatch.setattr(queries, "scratch", lambda *_: f"{tmp_path}/files")
    assert queries.inventory_whole_files(spark, f"{tmp_path}/sf").count() == 3
    written = os.listdir(f"{tmp_path}/files")
    assert len(written) == 41
    assert len({name.split("-")[1] for name in written}) > 4
