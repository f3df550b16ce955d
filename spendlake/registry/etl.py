"""Billing ETL, partitions and incremental ingestion."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.operators import lines as L
from spendlake.registry.catalog import fixture, query
from spendlake.registry.views import CUR_SQL, PERIOD, as_double, cur, cur_columns, cur_parts
from spendlake.sinks.tables import append_periods, replace_period, write_typed
from spendlake.sources.files import file_store, open_output, scratch
from spendlake.sources.tables import create_table, read_table
from spendlake.streaming.ingest import ingest_incremental

COST = "line_item_unblended_cost"

BILLABLE_SQL = f"""{CUR_SQL},
billable AS (
  SELECT *, cast(line_item_usage_start_date AS date) AS usage_date,
    cast(year(line_item_usage_start_date) AS int) AS year,
    cast(month(line_item_usage_start_date) AS int) AS month,
    strftime(line_item_usage_start_date, '%Y-%m') AS usage_period
  FROM cur
  WHERE line_item_line_item_type NOT IN ('Discount', 'Credit', 'Refund')
    AND line_item_line_item_type NOT LIKE '%Discount%')"""


def _count_and_cost(rows: DataFrame, *keys: str) -> DataFrame:
    grouped = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(COST).alias("cost"))
    return as_double(grouped, "cost")


@fixture
def _stored_cur(spark: SparkSession, sf_dir: str) -> str:
    """The line items as a table partitioned by billing month."""
    target = scratch(spark, "cur")
    append_periods(cur_parts(spark, sf_dir), target, "billing_period", rebalance=True, shape=cur_columns)
    return target


@query(f"""WITH {BILLABLE_SQL}
SELECT line_item_usage_account_id, bill_payer_account_id, line_item_line_item_type,
  line_item_usage_start_date, line_item_usage_type,
  cast(line_item_usage_amount AS double) AS line_item_usage_amount,
  cast(line_item_unblended_cost AS double) AS line_item_unblended_cost,
  cast(reservation_effective_cost AS double) AS reservation_effective_cost,
  savings_plan_savings_plan_a_r_n, reservation_subscription_id, reservation_reservation_a_r_n,
  billing_period, cast(usage_date AS varchar) AS usage_date, year, month, usage_period
FROM billable WHERE usage_period = '{PERIOD}'""")
def etl_billable_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.billable_lines(cur(spark, sf_dir), PERIOD).drop(
        "pricing_public_on_demand_cost", "savings_plan_savings_plan_effective_cost"
    )
    rows = rows.withColumn("usage_date", F.col("usage_date").cast("string"))
    return as_double(rows, "line_item_usage_amount", COST, "reservation_effective_cost")


@query(f"""WITH {BILLABLE_SQL}
SELECT line_item_line_item_type, count(*) AS n, cast(sum({COST}) AS double) AS cost
FROM billable WHERE usage_period = '{PERIOD}' GROUP BY line_item_line_item_type""")
def etl_billable_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count_and_cost(L.billable_lines(cur(spark, sf_dir), PERIOD), L.TYPE)


@query(f"""WITH {BILLABLE_SQL}
SELECT usage_period, line_item_line_item_type, count(*) AS n,
  cast(sum({COST}) AS double) AS cost
FROM billable GROUP BY usage_period, line_item_line_item_type""")
def etl_billable_all_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count_and_cost(L.billable_lines(cur(spark, sf_dir)), "usage_period", L.TYPE)


@query(f"""WITH {CUR_SQL}
SELECT line_item_line_item_type, count(*) AS n, cast(sum({COST}) AS double) AS cost
FROM cur
WHERE line_item_line_item_type = 'DiscountedUsage'
  OR (line_item_line_item_type NOT IN ('Discount', 'Credit', 'Refund')
    AND line_item_line_item_type NOT LIKE '%Discount%')
GROUP BY line_item_line_item_type""")
def etl_keep_discounted_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count_and_cost(L.billable(cur(spark, sf_dir), ("DiscountedUsage",)), L.TYPE)


@query(f"""WITH {BILLABLE_SQL}
SELECT 'all' AS stage, count(*) AS n,
  count(*) FILTER (line_item_line_item_type IS NULL) AS n_null FROM cur
UNION ALL
SELECT 'billable', count(*), count(*) FILTER (line_item_line_item_type IS NULL) FROM billable""")
def etl_null_type_dropped(spark: SparkSession, sf_dir: str) -> DataFrame:
    def counted(stage: str, rows: DataFrame) -> DataFrame:
        return rows.agg(
            F.lit(stage).alias("stage"),
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col(L.TYPE).isNull()).alias("n_null"),
        )

    lines = cur(spark, sf_dir)
    return counted("all", lines).unionByName(counted("billable", L.billable(lines)))


@query(f"""WITH {BILLABLE_SQL}
SELECT usage_period, count(*) AS n, cast(sum({COST}) AS double) AS cost
FROM billable GROUP BY usage_period""")
def etl_replace_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months are appended, one is replaced twice; the table is as after one write."""
    rows = L.billable_lines(cur(spark, sf_dir)).select("usage_period", L.TYPE, COST)
    target = scratch(spark, "billable")
    append_periods(rows, target, rebalance=True)
    for _ in range(2):
        replace_period(rows, target, PERIOD)
    schema = "line_item_line_item_type string, line_item_unblended_cost decimal(18,4), usage_period string"
    return _count_and_cost(spark.read.schema(schema).parquet(target), "usage_period")


@query(f"""WITH {CUR_SQL}
SELECT billing_period, line_item_line_item_type, count(*) AS n,
  cast(sum({COST}) AS double) AS cost
FROM cur WHERE billing_period >= '1997-01'
GROUP BY billing_period, line_item_line_item_type""")
def etl_prune_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = cur(spark, sf_dir).schema
    rows = read_table(spark, _stored_cur(spark, sf_dir), schema, "billing_period >= '1997-01'")
    return _count_and_cost(rows, "billing_period", L.TYPE)


@query(f"""WITH {BILLABLE_SQL}
SELECT line_item_line_item_type, count(*) AS n, cast(sum({COST}) AS double) AS cost
FROM billable
WHERE usage_period = '{PERIOD}' AND billing_period BETWEEN '2000-01' AND '2000-07'
GROUP BY line_item_line_item_type""")
def etl_near_billing_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = L.near_billing_period(cur(spark, sf_dir), PERIOD, 3)
    return _count_and_cost(L.billable_lines(rows, PERIOD), L.TYPE)


@query(f"""WITH {CUR_SQL}
SELECT billing_period, count(*) AS n, cast(sum({COST}) AS double) AS cost
FROM cur WHERE billing_period >= '2000-04' GROUP BY billing_period""")
def retention_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _count_and_cost(L.retained(cur(spark, sf_dir), "2000-07-15"), "billing_period")


@query(f"""WITH {CUR_SQL}
SELECT billing_period, count(*) AS n, cast(sum({COST}) AS double) AS cost
FROM cur GROUP BY billing_period""")
def catalog_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table declared over the files, read by name."""
    name = "spendlake_declared_cur"  # one at a time: the rows are read by name when they are needed
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    location = _stored_cur(spark, sf_dir)
    create_table(spark, name, location, cur(spark, sf_dir).schema, ("billing_period",))
    return _count_and_cost(read_table(spark, name), "billing_period")


@query(f"""WITH {CUR_SQL}
SELECT line_item_line_item_type, count(*) AS n, cast(sum({COST}) AS double) AS cost
FROM cur GROUP BY line_item_line_item_type""")
def scan_excludes_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items between files of other kinds, and Parquet files of a status directory."""
    rows = cur(spark, sf_dir)
    root = scratch(spark, "mixed")
    write_typed(rows, f"{root}/data")
    write_typed(rows, f"{root}/cost_and_usage_data_status")
    with open_output(f"{root}/data/manifest.json") as out:
        out.write(b'{"files": []}')
    return _count_and_cost(read_table(spark, f"{root}/*", rows.schema), L.TYPE)


KEYS = ("source_account_id", "report_name", "billing_period")


@fixture
def _stored_by_position(spark: SparkSession, sf_dir: str) -> str:
    """The line items in directories that are named by the keys' values alone."""
    payer = F.col("bill_payer_account_id")
    rows = cur(spark, sf_dir).select(L.TYPE, COST, "billing_period", payer.alias(KEYS[0]))
    rows = rows.withColumn(KEYS[1], F.lit("daily costs"))
    root = scratch(spark, "positional")
    rows.repartition(*KEYS).write.partitionBy(*KEYS).parquet(root)
    store, path = file_store(root)
    _without_names(store, path, len(KEYS))
    return root


def _without_names(store, folder: str, depth: int) -> None:
    from pyarrow import fs

    for entry in store.get_file_info(fs.FileSelector(folder)) if depth else ():
        if "=" in entry.base_name:
            goal = f"{folder}/{entry.base_name.split('=', 1)[1].replace('%20', ' ')}"
            store.move(entry.path, goal)
            _without_names(store, goal, depth - 1)


POSITIONAL_SQL = f"""WITH {CUR_SQL}
SELECT bill_payer_account_id AS source_account_id, 'daily costs' AS report_name, billing_period,
  count(*) AS n, cast(sum({COST}) AS double) AS cost
FROM cur WHERE bill_payer_account_id <> '000000000003' AND billing_period >= '1997-01'
GROUP BY bill_payer_account_id, billing_period"""


@query(POSITIONAL_SQL)
def positional_table_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys are directories by position; accounts and months are pruned while they are listed."""
    root = _stored_by_position(spark, sf_dir)
    schema = cur(spark, sf_dir).select(L.TYPE, COST).schema
    months = ["source_account_id <> '000000000003'", "billing_period >= '1997-01'"]
    return _count_and_cost(read_table(spark, root, schema, months, positional=KEYS), *KEYS)


@query(POSITIONAL_SQL)
def positional_declared_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same directories declared as a table's partitions, pruned by the catalogue."""
    name = "spendlake_positional_cur"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    columns = cur(spark, sf_dir).select(L.TYPE, COST).schema
    schema = T.StructType([*columns.fields, *(T.StructField(k, T.StringType()) for k in KEYS)])
    create_table(spark, name, _stored_by_position(spark, sf_dir), schema, KEYS, positional=True)
    wanted = ["source_account_id <> '000000000003'", "billing_period >= '1997-01'"]
    return _count_and_cost(read_table(spark, name, predicate=wanted), *KEYS)


@query(POSITIONAL_SQL)
def positional_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same directories as a stream of new files."""
    root = _stored_by_position(spark, sf_dir)
    rows = cur(spark, sf_dir).select(L.TYPE, COST)
    target, progress = scratch(spark, "ingested"), scratch(spark, "progress")
    for _ in range(2):
        ingest_incremental(
            spark, root, target, progress, rows.schema, partition_by="billing_period", positional=KEYS,
            predicates=["source_account_id <> '000000000003'", "billing_period >= '1997-01'"],
        )
    schema = f"{L.TYPE} string, {COST} decimal(18,4), " + ", ".join(f"{k} string" for k in KEYS)
    return _count_and_cost(spark.read.schema(schema).parquet(target), *KEYS)


@query(f"""WITH {BILLABLE_SQL}
SELECT usage_period, count(*) AS n, cast(sum({COST}) AS double) AS cost
FROM billable GROUP BY usage_period""")
def ingest_then_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries, a month replaced on the same target, and a run without news."""
    rows = cur(spark, sf_dir).select(L.TYPE, L.START, COST, "billing_period")
    source, target, progress = (scratch(spark, n) for n in ("arrivals", "both", "progress"))
    shape = lambda new: L.billable_lines(new).select("usage_period", L.TYPE, COST)
    early = F.col("billing_period") < "1998-01"
    for arrived in (early, ~early):
        write_typed(rows.where(arrived), source, "append")
        ingest_incremental(spark, source, target, progress, rows.schema, shape)
    replace_period(shape(rows), target, PERIOD, rebalance=True, checkpoint=progress)
    ingest_incremental(spark, source, target, progress, rows.schema, shape)
    schema = f"{L.TYPE} string, {COST} decimal(18,4), usage_period string"
    return _count_and_cost(spark.read.schema(schema).parquet(target), "usage_period")


@query(f"""WITH {BILLABLE_SQL}
SELECT usage_period, line_item_line_item_type, count(*) AS n,
  cast(sum({COST}) AS double) AS cost
FROM billable GROUP BY usage_period, line_item_line_item_type""")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two deliveries and a run without news give the rows of one run over everything."""
    rows = cur(spark, sf_dir).select(L.TYPE, L.START, COST, "billing_period")
    source, target, progress = (scratch(spark, n) for n in ("arrivals", "ingested", "progress"))
    early = F.col("billing_period") < "1998-01"
    for arrived in (early, ~early, None):
        if arrived is not None:
            write_typed(rows.where(arrived), source, "append")
        ingest_incremental(
            spark,
            source,
            target,
            progress,
            rows.schema,
            lambda new: L.billable_lines(new).select("usage_period", L.TYPE, COST),
        )
    schema = "line_item_line_item_type string, line_item_unblended_cost decimal(18,4), usage_period string"
    return _count_and_cost(spark.read.schema(schema).parquet(target), "usage_period", L.TYPE)


@query(f"""WITH {CUR_SQL}
SELECT 'started' AS "column", count(*) FILTER (WHERE line_item_line_item_type = 'Usage') AS unparsable,
  count(*) AS present FROM cur
UNION ALL SELECT 'cost', count(*) FILTER (WHERE line_item_line_item_type = 'Credit'), count(*) FROM cur""")
def unparsable_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times and amounts in a notation that is not read are counted by column."""
    kind = F.col(L.TYPE)
    lines = cur(spark, sf_dir).select(
        F.when(kind == "Usage", F.lit("06/01/2025 00:00"))
        .otherwise(F.col(L.START).cast("string"))
        .alias("started"),
        F.when(kind == "Credit", F.lit("1,234.5")).otherwise(F.col(COST).cast("string")).alias("cost"),
    )
    return L.unparsable_counts(lines, ["started"], ["cost"])
