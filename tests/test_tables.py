import os
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spendlake.operators import lines as L
from spendlake.plans import billing
from spendlake.registry import etl
from spendlake.sinks import tables as sinks
from spendlake.sources import files, schema, tables

JUNE, JULY = datetime(2025, 6, 3), datetime(2025, 7, 1)
READ = "line_item_line_item_type string, usage_period string"


def lines(spark, rows):
    return spark.createDataFrame(
        rows, "line_item_line_item_type string, line_item_usage_start_date timestamp_ntz"
    )


def counts(spark, target):
    rows = spark.read.schema(READ).parquet(target).groupBy("usage_period").count().collect()
    return {r.usage_period: r["count"] for r in rows}


def test_replace_keeps_other_periods_and_repeats(spark, tmp_path):
    target = f"{tmp_path}/t"
    source = lines(spark, [("Usage", JUNE)] * 3 + [("Usage", JULY)] * 2 + [("Credit", JUNE)])
    assert billing.run(spark, source, target, "2025-06") == 3
    assert billing.run(spark, source, target, "2025-07") == 2
    assert billing.run(spark, source, target, "2025-06", rebalance=True) == 3
    assert counts(spark, target) == {"2025-06": 3, "2025-07": 2}


def test_replace_by_nothing_empties_the_period(spark, tmp_path):
    target = f"{tmp_path}/t"
    billing.run(spark, lines(spark, [("Usage", JUNE), ("Usage", JUNE)]), target, "2025-06")
    billing.run(spark, lines(spark, [("Usage", JULY)]), target, "2025-07")
    assert billing.run(spark, lines(spark, [("Credit", JUNE)]), target, "2025-06") == 0
    assert counts(spark, target) == {"2025-07": 1}


def test_failed_run_leaves_the_period(spark, tmp_path):
    target = f"{tmp_path}/t"
    billing.run(spark, lines(spark, [("Usage", JUNE)]), target, "2025-06")
    broken = lines(spark, [("Usage", JUNE)] * 5).withColumn(
        "line_item_line_item_type",
        F.when(F.col("line_item_usage_start_date").isNotNull(), F.raise_error(F.lit("broken"))),
    )
    with pytest.raises(Exception, match="broken"):
        billing.run(spark, broken, target, "2025-06")
    assert counts(spark, target) == {"2025-06": 1}


def test_usage_month_under_the_name_of_the_billed_one(spark, tmp_path):
    source = lines(spark, [("Usage", JUNE)]).withColumn("billing_period", F.lit("2025-07"))
    billing.run(spark, source, f"{tmp_path}/t", "2025-06", column="BILLING_PERIOD")
    assert os.path.isdir(f"{tmp_path}/t/BILLING_PERIOD=2025-06")
    row = spark.read.parquet(f"{tmp_path}/t").first()
    assert row.BILLING_PERIOD == "2025-06" and "billing_period" not in row.asDict()


def test_slack_prunes_the_source(spark, tmp_path):
    months = ["2025-05", "2025-06", "2025-08"]
    source = spark.createDataFrame(
        [("Usage", JUNE, m) for m in months],
        "line_item_line_item_type string, line_item_usage_start_date timestamp_ntz, billing_period string",
    )
    assert billing.run(spark, source, f"{tmp_path}/t", "2025-06", slack_months=1) == 2
    assert billing.run(spark, source, f"{tmp_path}/t", "2025-06") == 3


def test_append_adds(spark, tmp_path):
    rows = L.billable_lines(lines(spark, [("Usage", JUNE), ("Usage", JULY)]))
    for rebalance in (False, True):
        sinks.append_periods(rows, f"{tmp_path}/t", rebalance=rebalance)
    assert counts(spark, f"{tmp_path}/t") == {"2025-06": 2, "2025-07": 2}


def cur_table(spark, root, keys=schema.PARTITION_KEYS):
    full = schema.cur_schema(partitions=True)
    values = {"source_account_id": "1", "report_name": "r", "data": "d"}
    rows = [("Usage", JUNE, "202506", 1.5), ("Credit", JUNE, "202506", 1.0), ("Usage", JULY, "202507", 2.0)]
    frame = spark.createDataFrame(
        rows,
        "line_item_line_item_type string, line_item_usage_start_date timestamp_ntz, "
        "billing_period string, line_item_unblended_cost double",
    )
    columns = [
        F.col(f.name) if f.name in frame.columns
        else F.lit(values.get(f.name)).cast(f.dataType).alias(f.name)
        for f in full.fields
    ]
    named = frame.select(*columns).withColumnsRenamed(dict(zip(schema.PARTITION_KEYS, keys)))
    named.write.partitionBy(*keys).parquet(root)
    return root


def test_declared_table(spark, tmp_path):
    root = cur_table(spark, f"{tmp_path}/cur")
    rows = tables.read_table(spark, root)
    assert len(rows.columns) == 129
    assert {r.billing_period for r in rows.collect()} == {"202506", "202507"}
    tables.create_table(spark, "declared_cur", root)
    assert tables.read_table(spark, "declared_cur", predicate="billing_period = '202506'").count() == 2
    spark.sql("DROP TABLE declared_cur")


def test_partition_keys_named_by_a_crawler(spark, tmp_path):
    root = cur_table(spark, f"{tmp_path}/cur", schema.PARTITION_ALIASES)
    crawled = schema.cur_schema(True, schema.PARTITION_ALIASES)
    rows = tables.read_table(spark, root, crawled, "report_name = 'r'", renamed=tables.CRAWLED_KEYS)
    assert rows.columns[-4:] == list(schema.PARTITION_KEYS)
    assert {r.billing_period for r in rows.collect()} == {"202506", "202507"}
    assert "PartitionFilters: [isnotnull(partition_1" in plan(rows)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark, tmp_path):
    root = cur_table(spark, f"{tmp_path}/cur")
    rows = tables.read_table(spark, root, predicate="billing_period = '202506'")
    text = plan(L.billable_lines(rows, "2025-06").select("usage_period", "line_item_unblended_cost"))
    assert "PartitionFilters: [isnotnull(billing_period" in text
    pushed = text.split("PushedFilters: [")[1].split("ReadSchema")[0]
    assert "GreaterThanOrEqual(line_item_usage_start_date,2025-06-01T00:00" in pushed
    assert "LessThan(line_item_usage_start_date,2025-07-01T00:00" in pushed
    assert "Not(In(line_item_line_item_type, [" in pushed
    assert "struct<line_item_line_item_type:string,line_item_unblended_cost:double,line_item_usage_start_date:timestamp_ntz>" in text
    assert "Exchange" not in text


def test_other_files_are_ignored(spark, tmp_path):
    root = cur_table(spark, f"{tmp_path}/cur")
    os.makedirs(f"{root}/cost_and_usage_data_status")
    for name in ("manifest.json", "create.sql", "x.csv", "cost_and_usage_data_status/s.json"):
        open(f"{root}/{name}", "w").write("no line item")
    assert tables.read_table(spark, root).count() == 3


def test_schema():
    full = schema.cur_schema(partitions=True)
    kinds = [f.dataType.simpleString() for f in schema.cur_schema().fields]
    assert len(kinds) == 125 and len(full.fields) == 129
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "string": 73, "double": 44, "timestamp_ntz": 4, "map<string,string>": 3,
        "map<string,double>": 1,
    }
    parsed, keys = schema.from_json_list(schema.to_json_list(full, schema.PARTITION_KEYS))
    assert parsed == full and keys == list(schema.PARTITION_KEYS)
    with pytest.raises(ValueError, match="unknown type"):
        schema.from_json_list('[{"Name": "a", "Type": "blob"}]')


def test_typed_file_is_snappy_with_statistics(spark, tmp_path):
    sinks.write_typed(lines(spark, [("Usage", JUNE)]).coalesce(1), f"{tmp_path}/t")
    name = next(f for f in os.listdir(f"{tmp_path}/t") if f.endswith(".parquet"))
    column = pq.ParquetFile(f"{tmp_path}/t/{name}").metadata.row_group(0).column(0)
    assert column.compression == "SNAPPY" and column.is_stats_set


def arrive(spark, root, rows):
    full = schema.cur_schema(partitions=True)
    frame = lines(spark, rows)
    columns = [
        F.col(f.name) if f.name in frame.columns else F.lit(None).cast(f.dataType).alias(f.name)
        for f in full.fields
    ]
    frame.select(*columns).write.mode("append").parquet(root)


def test_incremental_runs_equal_one_run(spark, tmp_path):
    source, target, progress = (f"{tmp_path}/{n}" for n in ("s", "t", "p"))
    batches = [[("Usage", JUNE), ("Credit", JUNE)], [("Usage", JULY)] * 2 + [(None, JULY)]]
    seen = []
    for rows in batches:
        arrive(spark, source, rows)
        for _ in range(2):  # the second run finds nothing new
            billing.run_incremental(spark, source, target, progress)
        seen.append(counts(spark, target))
    assert seen == [{"2025-06": 1}, {"2025-06": 1, "2025-07": 2}]


class FakeSession:
    def __init__(self, **settings):
        self.settings = settings
        self.conf = self

    def get(self, key, default):
        return self.settings.get(key.replace(".", "_"), default)


def test_scratch_is_in_the_shared_folder(tmp_path):
    shared = FakeSession(spark_checkpoint_dir="s3a://bucket/shared/", spark_master="yarn")
    assert files.scratch(shared, "x").startswith("s3a://bucket/shared/x-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        files.scratch(FakeSession(spark_master="yarn"), "x")
    assert "spendlake-" in files.scratch(FakeSession(spark_master="local[2]"), "x")


def test_what_is_computed_is_not_moved(spark, tmp_path):
    rows = L.billable_lines(lines(spark, [("Usage", JUNE), ("Usage", JULY)] * 3)).select(L.TYPE, "usage_period")
    seen = []

    def shape(parts):
        seen.append((parts.columns, parts._jdf.queryExecution().optimizedPlan().toString()))
        return parts.withColumn("arn", F.concat(F.lit("arn:"), L.TYPE))

    sinks.append_periods(rows, f"{tmp_path}/t", rebalance=True, shape=shape)
    columns, plan = seen[0]
    assert columns == [L.TYPE, "usage_period"] and "Sort" in plan and "Rebalance" in plan
    assert counts(spark, f"{tmp_path}/t") == {"2025-06": 3, "2025-07": 3}
    assert {r.arn for r in spark.read.parquet(f"{tmp_path}/t").collect()} == {"arn:Usage"}


def test_stored_lines_are_brought_together_as_their_parts(spark, monkeypatch):
    moved = []
    monkeypatch.setattr(etl, "append_periods", lambda rows, *_, **__: moved.extend(rows.columns))
    etl._stored_cur.__wrapped__(spark, "/root/testdata/sf0.001")
    assert "l_partkey" in moved and "reservation_reservation_a_r_n" not in moved
