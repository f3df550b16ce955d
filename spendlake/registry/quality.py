"""Storage and quality profile, schemas, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators import profile as P
from spendlake.registry.catalog import query
from spendlake.registry.views import CUR_SQL, JSON_TEXTS_SQL, cur, json_texts, table
from spendlake.plans.profiling import null_counts
from spendlake.sinks.tables import write_typed
from spendlake.sources.files import file_sizes, list_files, scratch
from spendlake.sources.footers import read_footers
from spendlake.sources.schema import from_json_list, to_json_list
from spendlake.sources.tables import read_table, sample_rows
from spendlake.sources.tables import sample_by_hash as even_sample

# The check runs on this directory; the SQL functions over footers need the path itself.
CHECKED_DIR = "/root/testdata/sf0.01"

_CHUNKS_SQL = f"""chunks AS (
  SELECT replace(path_in_schema, ', ', '.') AS path_name, type,
    total_compressed_size AS c, total_uncompressed_size AS u, num_values
  FROM parquet_metadata('{CHECKED_DIR}/*.parquet'))"""


def _bytes_text(column: str) -> str:
    return f"""CASE WHEN {column} < 1024 THEN printf('%.2f B', cast({column} AS double))
    WHEN {column} < 1024 * 1024 THEN printf('%.2f KB', {column} / 1024.0)
    ELSE printf('%.2f MB', {column} / 1024.0 / 1024.0) END"""


@query(f"""WITH {_CHUNKS_SQL}
SELECT "column", physical_type, compressed, uncompressed, num_values,
  cast(uncompressed AS double) / cast(compressed AS double) AS ratio,
  {_bytes_text("compressed")} AS compressed_text,
  {_bytes_text("uncompressed")} AS uncompressed_text
FROM (SELECT path_name AS "column", min(type) AS physical_type,
    cast(sum(c) AS bigint) AS compressed, cast(sum(u) AS bigint) AS uncompressed,
    cast(sum(num_values) AS bigint) AS num_values
  FROM chunks GROUP BY path_name)""")
def storage_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.storage_profile(read_footers(spark, sf_dir))


@query(f"""WITH {_CHUNKS_SQL}, totals AS (
  SELECT count(DISTINCT path_name) AS n_columns, cast(sum(c) AS bigint) AS compressed,
    cast(sum(u) AS bigint) AS uncompressed,
    (SELECT cast(sum(num_rows) AS bigint) FROM parquet_file_metadata('{CHECKED_DIR}/*.parquet'))
      AS n_rows
  FROM chunks)
SELECT *, cast(uncompressed AS double) / cast(compressed AS double) AS ratio,
  {_bytes_text("compressed")} AS compressed_text,
  {_bytes_text("uncompressed")} AS uncompressed_text
FROM totals""")
def storage_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.storage_totals(read_footers(spark, sf_dir))


@query(f"""WITH {_CHUNKS_SQL}, details AS (
  SELECT path_name AS "column", min(type) AS type, cast(sum(c) AS bigint) AS c,
    cast(sum(u) AS bigint) AS u FROM chunks GROUP BY path_name),
rows AS (SELECT * FROM details UNION ALL
  SELECT 'TOTAL', '', cast(sum(c) AS bigint), cast(sum(u) AS bigint) FROM details)
SELECT "column", type, {_bytes_text("c")} AS compressed, {_bytes_text("u")} AS uncompressed,
  concat((u * 200 + c) // (c * 2) // 100, '.',
    lpad(cast((u * 200 + c) // (c * 2) % 100 AS varchar), 2, '0'), 'x') AS ratio
FROM rows""")
def storage_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.storage_report(read_footers(spark, sf_dir))


_EVENT_SIZES = """sizes AS (
  SELECT 'event_id' AS "column", 'bigint' AS type, count(event_id) AS n, 8 * count(event_id) AS b
  FROM events
  UNION ALL SELECT 'ts', 'timestamp_ntz', count(ts), 8 * count(ts) FROM events
  UNION ALL SELECT 'user_id', 'bigint', count(user_id), 8 * count(user_id) FROM events
  UNION ALL SELECT 'event_type', 'string', count(event_type),
    sum(octet_length(encode(event_type))) FROM events
  UNION ALL SELECT 'value', 'double', count(value), 8 * count(value) FROM events
  UNION ALL SELECT 'props', 'string', count(props), sum(octet_length(encode(props))) FROM events
  UNION ALL SELECT 'raw', 'string', count(raw), sum(octet_length(encode(raw))) FROM json_texts)"""


@query(f"""WITH {JSON_TEXTS_SQL}, {_EVENT_SIZES}, counted AS (
  SELECT *, (SELECT count(*) FROM events) AS n_rows, (SELECT count(*) FROM events) - n AS nulls,
    cast(b AS bigint) AS size FROM sizes)
SELECT "column", type, format('{{:,}}', n_rows) AS rows, format('{{:,}}', nulls) AS nulls,
  concat((nulls * 2000 + n_rows) // (n_rows * 2) // 10, '.',
    (nulls * 2000 + n_rows) // (n_rows * 2) % 10, '%') AS null_percent,
  {_bytes_text("size")} AS size
FROM counted""")
def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    events, texts = table(spark, sf_dir, "events"), json_texts(spark, sf_dir)
    return P.quality_report(events.join(texts, "event_id"))


@query("""WITH sizes AS (
  SELECT 'doc_id' AS "column", 'bigint' AS type, 8 * count(doc_id) AS value_bytes FROM documents
  UNION ALL SELECT 'text', 'string', sum(octet_length(encode(text))) FROM documents
  UNION ALL SELECT 'lang', 'string', sum(octet_length(encode(lang))) FROM documents
  UNION ALL SELECT 'source', 'string', sum(octet_length(encode(source))) FROM documents
  UNION ALL SELECT 'n_chars', 'bigint', 8 * count(n_chars) FROM documents)
SELECT "column", type, cast(value_bytes AS bigint) AS value_bytes,
  cast(value_bytes AS double) * 100.0 / cast(sum(value_bytes) OVER () AS double)
    AS share_percent
FROM sizes""")
def value_bytes_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.value_bytes(table(spark, sf_dir, "documents"))


_CUR_NULLS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS n_rows FROM cur"
    for c in (
        "line_item_usage_account_id", "bill_payer_account_id", "line_item_line_item_type",
        "line_item_usage_start_date", "line_item_usage_type", "line_item_usage_amount",
        "line_item_unblended_cost", "pricing_public_on_demand_cost", "reservation_effective_cost",
        "savings_plan_savings_plan_effective_cost", "savings_plan_savings_plan_a_r_n",
        "reservation_subscription_id", "reservation_reservation_a_r_n", "billing_period",
    )
)


@query(f"""WITH {CUR_SQL}, nulls AS ({_CUR_NULLS})
SELECT "column", nulls, n_rows, nulls * cast(100.0 AS double) / n_rows AS null_percent
FROM nulls ORDER BY nulls DESC, "column" LIMIT 10""")
def null_profile_top10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.null_profile(cur(spark, sf_dir))


@query(f"""WITH {CUR_SQL}, nulls AS ({_CUR_NULLS})
SELECT "column", nulls, n_rows, nulls * cast(100.0 AS double) / n_rows AS null_percent FROM nulls""")
def null_profile_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line items as a table whose footers count NULLs: no data is read."""
    target = scratch(spark, "cur")
    write_typed(cur(spark, sf_dir), target)
    return null_counts(spark, target)


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders
ORDER BY md5(concat_ws(chr(31), 'seed', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)) LIMIT 500""")
def sample_by_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    return even_sample(rows, 500, seed="seed")


@query("""SELECT type, count(*) AS n_columns, cast(0 AS bigint) AS nulls,
  cast(sum(value_bytes) AS bigint) AS value_bytes
FROM (
  SELECT 'bigint' AS type, 8 * count(l_orderkey) AS value_bytes FROM lineitem
  UNION ALL SELECT 'bigint', 8 * count(l_partkey) FROM lineitem
  UNION ALL SELECT 'bigint', 8 * count(l_suppkey) FROM lineitem
  UNION ALL SELECT 'int', 4 * count(l_linenumber) FROM lineitem
  UNION ALL SELECT 'double', 8 * count(l_quantity) FROM lineitem
  UNION ALL SELECT 'double', 8 * count(l_extendedprice) FROM lineitem
  UNION ALL SELECT 'double', 8 * count(l_discount) FROM lineitem
  UNION ALL SELECT 'double', 8 * count(l_tax) FROM lineitem
  UNION ALL SELECT 'string', sum(octet_length(encode(l_returnflag))) FROM lineitem
  UNION ALL SELECT 'string', sum(octet_length(encode(l_linestatus))) FROM lineitem
  UNION ALL SELECT 'timestamp_ntz', 8 * count(l_shipdate) FROM lineitem)
GROUP BY type""")
def type_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.type_histogram(table(spark, sf_dir, "lineitem"))


@query(f"""SELECT regexp_extract(m.file_name, '([^/]+)\\.parquet$', 1) AS table_name,
  cast(m.num_rows AS bigint) AS n_rows, cast(b.size AS bigint) AS n_bytes
FROM parquet_file_metadata('{CHECKED_DIR}/*.parquet') m
JOIN read_blob('{CHECKED_DIR}/*.parquet') b ON b.filename = m.file_name""")
def row_and_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        read_footers(spark, sf_dir)
        .where(F.col("ordinal") == 0)
        .groupBy("path")
        .agg(F.sum("num_rows").alias("n_rows"))
    )
    listing = list_files(spark, sf_dir, "*.parquet")
    return rows.join(listing, "path").select(
        F.regexp_extract("path", r"([^/]+)\.parquet$", 1).alias("table_name"),
        "n_rows",
        F.col("length").alias("n_bytes"),
    )


@query(f"""SELECT regexp_extract(filename, '([^/]+)/[^/]*$', 1) AS directory, count(*) AS n_files,
  cast(sum(size) AS bigint) AS n_bytes
FROM read_blob('{CHECKED_DIR}/*.parquet') GROUP BY ALL""")
def directory_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = file_sizes(list_files(spark, sf_dir, "*.parquet"))
    return sizes.withColumn("directory", F.element_at(F.split("directory", "/"), -1))


@query(f"""WITH {CUR_SQL} SELECT count(*) AS n_rows, cast(14 AS bigint) AS n_columns FROM cur""")
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.shape(cur(spark, sf_dir))


@query("""SELECT * FROM lineitem
ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity,
  l_discount, l_tax, l_returnflag, l_linestatus LIMIT 100""")
def sample_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = (
        "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
    )
    return sample_rows(table(spark, sf_dir, "lineitem"), 100, order)


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_shipdate) AS first_ship,
  cast(sum(cast(l_extendedprice AS decimal(18,4))) AS double) AS price
FROM lineitem GROUP BY l_returnflag, l_linestatus""")
def schema_from_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table read by a schema that was declared as a JSON list."""
    path = f"{sf_dir}/lineitem.parquet"
    schema, _ = from_json_list(to_json_list(spark.read.parquet(path).schema))
    return (
        read_table(spark, path, schema)
        .groupBy("l_returnflag", "l_linestatus")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("l_shipdate").alias("first_ship"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,4)")).cast("double").alias("price"),
        )
    )


# Written by hand, as a catalogue states it: keys last, under their own mark.
_DECLARED = """[
  {"Name": "line_item_line_item_type", "Type": "string"},
  {"Name": "line_item_usage_start_date", "Type": "timestamp"},
  {"Name": "resource_tags", "Type": "map<string,string>"},
  {"Name": "n", "Type": "bigint"},
  {"Name": "bill_payer_account_id", "Type": "string", "PartitionKey": "Partition (0)"},
  {"Name": "billing_period", "Type": "string", "PartitionKey": "Partition (1)"}
]"""


@query(f"""WITH {CUR_SQL}
SELECT bill_payer_account_id, billing_period, line_item_line_item_type, count(*) AS n,
  max(line_item_usage_start_date) AS last_start, cast(0 AS bigint) AS n_tagged
FROM cur GROUP BY ALL""")
def schema_with_partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A list of columns and keys declares a table: keys stay text, a column no file has is NULL."""
    schema, keys = from_json_list(_DECLARED)
    rows = cur(spark, sf_dir).select("line_item_line_item_type", "line_item_usage_start_date", *keys)
    target = scratch(spark, "declared")
    rows.repartition(*keys).write.partitionBy(*keys).parquet(target)
    return (
        read_table(spark, target, schema)
        .groupBy(*keys, "line_item_line_item_type")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("line_item_usage_start_date").alias("last_start"),
            F.count("resource_tags").alias("n_tagged"),
        )
    )
