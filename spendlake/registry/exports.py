"""CSV exports, typing, JSON maps, id lists, account collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.functions import maps, times
from spendlake.operators import savings as S
from spendlake.operators.columns import CANDIDATES, RI_COLUMNS, SP_COLUMNS
from spendlake.operators.lines import START, TYPE
from spendlake.operators.typed import to_typed
from spendlake.plans import billing, convert
from spendlake.plans import savings as savings_plan
from spendlake.registry.catalog import ORACLES, fixture, query
from spendlake.registry.savings import (
    RI_ARN,
    RI_OUT,
    SP_ARN,
    SP_OUT,
    RI_LIST,
    SP_LIST,
    any_of,
    ri_sql,
    sp_sql,
)
from spendlake.registry.views import (
    CUR_SQL,
    JSON_TEXTS_SQL,
    PERIOD,
    as_double,
    cur,
    json_texts,
    table,
    time_text,
)
from spendlake.sinks.reports import write_csv_report
from spendlake.sources.accounts import account_listing, collect_accounts, read_registry, without_keys
from spendlake.sources.exports import find_exports, read_exports, typed_lines
from spendlake.sources.files import list_files, open_input, open_output, scratch
from spendlake.sources.lists import read_ids

COST = "line_item_unblended_cost"


# Exports come in files of limited size.
ROWS_PER_FILE = 500_000
ROWS_PER_TEXT = 20_000


def _write_csv(rows: DataFrame, target: str, by: str | None = None) -> None:
    """Gzipped CSV, a file or more of each task that holds rows: a join has dealt them to many."""
    writer = (
        time_text(rows)
        .write.option("header", True)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", ROWS_PER_FILE)
        .option("escape", '"')
    )
    (writer.partitionBy(by) if by else writer).csv(target)


def _spread(rows: DataFrame) -> DataFrame:
    """A table as it lies, which may be one task, dealt to as many as the session shuffles to."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _respelled(rows: DataFrame, style: int) -> DataFrame:
    """The same rows under another of the header spellings, columns in another order."""
    renamed = [
        F.col(c).alias(CANDIDATES[c][style] if c in CANDIDATES else c) for c in sorted(rows.columns)
    ]
    return rows.select(*renamed)


@fixture
def _write_two_layouts(spark: SparkSession, sf_dir: str) -> str:
    """The line items as two deliveries whose headers share neither names nor order."""
    root = scratch(spark, "exports")
    rows = cur(spark, sf_dir).select(*RI_COLUMNS, "billing_period")
    early = F.col("billing_period") < "1998-01"
    _write_csv(rows.where(early), f"{root}/2025a")
    _write_csv(_respelled(rows.where(~early), 1), f"{root}/2025b")
    return root


@fixture
def _write_all_columns(spark: SparkSession, sf_dir: str) -> str:
    target = scratch(spark, "csv")
    _write_csv(cur(spark, sf_dir), target)
    return target


@fixture
def _write_by_payer(spark: SparkSession, sf_dir: str) -> str:
    """A directory of exports for each paying account."""
    bucket = scratch(spark, "bucket")
    payer = F.col("bill_payer_account_id").alias("account")
    _write_csv(cur(spark, sf_dir).select(TYPE, COST, payer), bucket, "account")
    return bucket


@query(f"""WITH {CUR_SQL}
SELECT line_item_usage_account_id, line_item_usage_type,
  coalesce(line_item_line_item_type, '') AS line_item_line_item_type,
  count(*) AS n, cast(sum(line_item_unblended_cost) AS double) AS cost,
  min(line_item_usage_start_date) AS first_start, max(line_item_usage_start_date) AS last_start,
  count(reservation_subscription_id) AS n_subscriptions
FROM cur
GROUP BY line_item_usage_account_id, line_item_usage_type,
  coalesce(line_item_line_item_type, '')""")
def csv_typed_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All line items to gzipped CSV, back as text, typed, to Parquet, and back again."""
    target = scratch(spark, "typed")
    convert.run(spark, _write_all_columns(spark, sf_dir), target, rebalance=True)
    grouped = (
        spark.read.parquet(target)
        .groupBy("line_item_usage_account_id", "line_item_usage_type", TYPE)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col(COST).cast("decimal(18,4)")).alias("cost"),
            F.min(START).alias("first_start"),
            F.max(START).alias("last_start"),
            F.count("reservation_subscription_id").alias("n_subscriptions"),
        )
    )
    return as_double(grouped, "cost")


@query(f"WITH {CUR_SQL}, {ri_sql()} SELECT {RI_OUT} FROM ri")
def csv_multi_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    listing = find_exports(spark, _write_two_layouts(spark, sf_dir), "2025")
    lines = typed_lines(read_exports(spark, listing, RI_COLUMNS).lines)
    return as_double(S.ri_savings(lines), *S.RI_MEASURES)


@query(f"""WITH {CUR_SQL}, {ri_sql(PERIOD, ids=any_of(RI_ARN, RI_LIST))}
SELECT {RI_OUT} FROM ri""")
def ri_from_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report job: exports of two layouts, an id file, one month."""
    root, ids = _write_two_layouts(spark, sf_dir), scratch(spark, "ri-id")
    _write_lines(spark, RI_LIST, ids)
    result = savings_plan.ri_from_exports(spark, root, PERIOD, "2025", ids)
    return as_double(result.details, *S.RI_MEASURES)


@query(f"""WITH {CUR_SQL}, {sp_sql(PERIOD, ids=any_of(SP_ARN, SP_LIST))}
SELECT {SP_OUT} FROM sp""")
def sp_from_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The savings plan job over exports of one layout, with an id file and a report."""
    root, ids = scratch(spark, "exports"), scratch(spark, "sp-id")
    _write_csv(_respelled(cur(spark, sf_dir).select(*SP_COLUMNS), 2), f"{root}/2025a")
    _write_lines(spark, SP_LIST, ids)
    report = scratch(spark, "sp-report")
    result = savings_plan.sp_from_exports(spark, root, PERIOD, ids, "2025", report)
    return as_double(result.details, *S.SP_MEASURES)


def _write_lines(spark: SparkSession, lines: tuple[str, ...], target: str) -> None:
    texts = F.array(*(F.lit(f" {line} ") for line in lines))
    spark.range(1).select(F.explode(texts).alias("value")).write.text(target)


@query(f"""WITH {CUR_SQL}
SELECT line_item_line_item_type, cast(count(*) AS bigint) AS n,
  cast(sum(line_item_unblended_cost) AS double) AS cost, cast(2 AS bigint) AS n_rejected
FROM cur GROUP BY line_item_line_item_type""")
def csv_bad_files_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gzip cut short and a file without the columns are left out whole, and listed."""
    root = scratch(spark, "exports")
    _write_csv(cur(spark, sf_dir).select(TYPE, COST), f"{root}/2025a")
    good = find_exports(spark, root).select("path").first()["path"]
    with open_input(good) as source, open_output(f"{root}/2025a/cut.csv.gz") as out:
        out.write(source.read(120))
    _write_csv(_spread(table(spark, sf_dir, "region")), f"{root}/2025b")
    exports = read_exports(spark, find_exports(spark, root), (TYPE, COST))
    rejected = exports.rejected.where(
        F.col("problem").contains("EOFError") | F.col("problem").startswith("Missing required")
    )
    # Files of the small table depend on how it was written; count the kinds of problem.
    kinds = rejected.agg(F.count_distinct(F.substring("problem", 1, 7)).alias("k")).scalar()
    grouped = (
        typed_lines(exports.lines)
        .groupBy(TYPE)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(COST).cast("decimal(18,4)")).alias("cost"))
    )
    return as_double(grouped, "cost").withColumn("n_rejected", kinds)


@query(f"WITH {CUR_SQL}, {ri_sql()} SELECT {RI_OUT} FROM ri")
def exports_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files staged by a first run are not opened by the second, which reads a later delivery."""
    root, store = scratch(spark, "exports"), scratch(spark, "store")
    rows = cur(spark, sf_dir).select(*RI_COLUMNS, "billing_period")
    early = F.col("billing_period") < "1998-01"
    _write_csv(rows.where(early), f"{root}/2025a")
    read_exports(spark, find_exports(spark, root), RI_COLUMNS, store=store)
    _write_csv(_respelled(rows.where(~early), 1), f"{root}/2025b")
    lines = read_exports(spark, find_exports(spark, root), RI_COLUMNS, store=store).lines
    return as_double(S.ri_savings(typed_lines(lines)), *S.RI_MEASURES)


@query(f"""WITH {CUR_SQL}
SELECT line_item_line_item_type, count(*) AS n, cast(sum({COST}) AS double) AS cost,
  (SELECT count(*) FILTER (line_item_line_item_type IS NULL) FROM cur) AS n_short
FROM cur GROUP BY line_item_line_item_type""")
def csv_single_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without their last cell are counted in the pass that reads them."""
    root = scratch(spark, "exports")
    rows = cur(spark, sf_dir).select(F.col(COST).cast("string").alias("c"), TYPE)
    line = F.concat_ws(",", "c", TYPE)  # no type, no comma
    files = F.pmod(F.xxhash64("c"), F.lit(max(8, rows.count() // ROWS_PER_TEXT)))
    texts = rows.groupBy(files.alias("f")).agg(F.array_join(F.collect_list(line), "\n").alias("t"))
    text = F.concat(F.lit("UnblendedCost,LineItemType\n"), "t")
    writer = texts.select(text.alias("value")).write.option("maxRecordsPerFile", 1)
    writer.option("compression", "gzip").text(f"{root}/2025")
    listing = find_exports(spark, root, glob="*.txt.gz")
    exports = read_exports(spark, listing, (TYPE, COST))
    grouped = (
        exports.lines.groupBy(TYPE)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(COST).cast("decimal(18,4)")).alias("cost"))
    )
    short = exports.files.agg(F.sum("n_short")).scalar()
    return as_double(grouped, "cost").withColumn("n_short", short)


@query("""SELECT lpad(cast(s_suppkey % 5 AS varchar), 12, '0') AS source_account_id, true AS found
FROM supplier GROUP BY s_suppkey % 5
UNION ALL SELECT concat('c', c_custkey), false FROM customer""")
def account_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which accounts of the registry have files: a directory for each payer, none for customers."""
    bucket = scratch(spark, "bucket")
    rows = table(spark, sf_dir, "supplier").select(
        "s_name", F.lpad((F.col("s_suppkey") % 5).cast("string"), 12, "0").alias("account")
    )
    _write_csv(_spread(rows), bucket, "account")
    customers = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("account"))
    registry = rows.select("account").distinct().unionByName(customers).select(
        F.col("account").alias("aws_id"),
        F.lit(bucket).alias("bucket"),
        F.concat(F.lit("/account="), "account").alias("daily_dir"),
    )
    return account_listing(registry, "daily").groupBy("source_account_id").agg(
        F.bool_or(F.col("path").isNotNull()).alias("found")
    )


@query(f"""WITH {CUR_SQL}
SELECT bill_payer_account_id AS source_account_id, line_item_line_item_type, count(*) AS n,
  cast(sum(line_item_unblended_cost) AS double) AS cost
FROM cur GROUP BY bill_payer_account_id, line_item_line_item_type""")
def account_collection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One export directory per paying account, found through the registry."""
    bucket = _write_by_payer(spark, sf_dir)
    payer = F.col("bill_payer_account_id")
    folder = F.concat(F.lit("account="), payer)
    registry = (
        cur(spark, sf_dir)
        .select("bill_payer_account_id")
        .distinct()
        .select(
            payer.alias("aws_id"),
            F.lit(bucket).alias("bucket"),
            folder.alias("monthly_dir"),
            F.lit("never loaded").alias("secret_access_key"),
        )
    )
    exports = collect_accounts(spark, without_keys(registry), "monthly", (TYPE, COST))
    grouped = (
        typed_lines(exports.lines)
        .groupBy("source_account_id", TYPE)
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(COST).cast("decimal(18,4)")).alias("cost"))
    )
    return as_double(grouped, "cost")


@query("""SELECT DISTINCT trim(c_name) AS id FROM customer WHERE c_custkey % 3 <> 0""")
def id_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids with blanks around them, blank lines and repeats."""
    target = scratch(spark, "ids")
    customers = table(spark, sf_dir, "customer")
    line = F.when(F.col("c_custkey") % 3 == 0, "   ").otherwise(
        F.concat(F.lit("  "), F.col("c_name"), F.lit("\t"))
    )
    lines = customers.select(line.alias("value"))
    lines.unionByName(lines).write.text(target)
    return read_ids(spark, target)


@query(f"""WITH {JSON_TEXTS_SQL}
SELECT event_id,
  CASE WHEN event_type = 'click' THEN concat('{{"a": "0.5", "id": "', event_id, '"}}')
       WHEN event_type = 'error'
         THEN concat('{{"n": "None", "t": "True", "w": "x', event_id, '"}}')
       WHEN event_type = 'purchase' THEN raw
       WHEN raw IS NULL OR raw = '' THEN '{{}}'
       ELSE concat('{{"k": "', json_extract_string(raw, '$.k'), '"}}') END AS normalised,
  CASE WHEN event_type = 'click' THEN 2 WHEN event_type = 'error' THEN 3
       WHEN event_type = 'purchase' THEN -1 WHEN raw IS NULL OR raw = '' THEN 0 ELSE 1
  END AS n_keys
FROM json_texts""")
def map_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = json_texts(spark, sf_dir).withColumn("product", F.col("raw"))
    return to_typed(rows).select(
        "event_id",
        F.col("product").alias("normalised"),
        F.coalesce(F.size(maps.string_map("raw")), F.lit(-1)).alias("n_keys"),
    )


@query(f"""WITH {JSON_TEXTS_SQL}
SELECT event_id,
  CASE WHEN event_type = 'click' THEN concat('{{"a": 0.5, "id": ', event_id, '.0}}')
       WHEN event_type = 'error'
         THEN concat('{{"n": "None", "t": "True", "w": "x', event_id, '"}}')
       WHEN event_type = 'purchase' THEN raw
       WHEN raw IS NULL OR raw = '' THEN '{{}}'
       ELSE concat('{{"k": ', json_extract_string(raw, '$.k'), '.0}}') END AS normalised,
  CASE WHEN event_type = 'click' THEN 0.5 + event_id
       WHEN raw LIKE '{{"k%' THEN cast(json_extract_string(raw, '$.k') AS double)
  END AS sum_of_values
FROM json_texts""")
def map_normalise_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = json_texts(spark, sf_dir).withColumn("discount", F.col("raw"))
    numbers = to_typed(rows.drop("raw"), maps_as="map").select(
        "event_id", F.map_values("discount").alias("numbers")
    )
    added = F.aggregate("numbers", F.lit(0.0), lambda a, v: a + v)
    sums = numbers.select(
        "event_id", F.when(F.size("numbers") > 0, added).alias("sum_of_values")
    )
    texts = to_typed(rows).select("event_id", F.col("discount").alias("normalised"))
    return texts.join(sums, "event_id")


@query(f"""WITH {JSON_TEXTS_SQL}
SELECT event_id,
  CASE WHEN event_type = 'click' THEN 'a,id' WHEN event_type = 'error' THEN 'n,t,w'
       WHEN event_type = 'purchase' THEN 'value'
       WHEN raw IS NULL OR raw = '' THEN '_empty' ELSE 'k' END AS keys,
  CASE WHEN event_type = 'click' THEN concat('0.5,', event_id)
       WHEN event_type = 'error' THEN concat('None,True,x', event_id)
       WHEN event_type = 'purchase' THEN raw
       WHEN raw IS NULL OR raw = '' THEN '' ELSE json_extract_string(raw, '$.k') END AS vals
FROM json_texts""")
def json_or_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = json_texts(spark, sf_dir).select(
        "event_id", maps.json_or_default("raw").alias("m")
    )
    return parsed.select(
        "event_id",
        F.array_join(F.map_keys("m"), ",").alias("keys"),
        F.array_join(F.map_values("m"), ",").alias("vals"),
    )


@query("""SELECT event_id, date_trunc('millisecond', ts) AS ts_millis,
  strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%g') AS iso,
  strftime(ts, '%Y-%m') AS usage_period
FROM events""")
def ts_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written times (with a zone mark) as millisecond timestamps, ISO text and month."""
    text = F.concat(F.replace(F.col("ts").cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
    rows = table(spark, sf_dir, "events").select("event_id", text.alias(START))
    return to_typed(rows).select(
        "event_id",
        F.col(START).alias("ts_millis"),
        times.iso_millis(F.col(START)).alias("iso"),
        times.period_of(F.col(START)).alias("usage_period"),
    )


@query(f"""WITH {CUR_SQL}, {ri_sql()}
SELECT count(*) + 1 AS n_lines, cast(sum(cast(round(on_demand_cost, 2) AS decimal(38,2))) AS double)
  AS on_demand_cost FROM ri""")
def ri_report_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report as a CSV file: its lines, and the sum of its amounts as written."""
    target = scratch(spark, "ri-report")
    write_csv_report(S.ri_report(S.ri_savings(cur(spark, sf_dir))), target)
    written = spark.read.option("header", True).csv(target)
    amount = F.regexp_replace("On-Demand Cost", "[$]", "").cast("decimal(38,2)")
    detail = F.col("Usage Account ID").isNotNull()
    summed = written.agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.when(detail, amount)).alias("on_demand_cost")
    )
    return as_double(summed, "on_demand_cost")


@query("""SELECT lang, source, count(*) AS n, cast(sum(n_chars) AS bigint) AS n_chars,
  cast(sum(length(text)) AS bigint) AS text_length
FROM documents GROUP BY lang, source""")
def csv_whole_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with quotes, commas and line breaks survive gzipped CSV whole."""
    source = scratch(spark, "texts")
    _write_csv(_spread(table(spark, sf_dir, "documents")), source)
    lines = read_exports(spark, list_files(spark, source, "*.csv.gz")).lines
    return lines.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("n_chars").cast("bigint")).alias("n_chars"),
        F.sum(F.length("text")).alias("text_length"),
    )


def _read_back(spark: SparkSession, report: DataFrame) -> DataFrame:
    """A report written as CSV, read row by row as it stands there, with the place of each row."""
    target = scratch(spark, "report")
    write_csv_report(report, target)
    return spark.read.option("header", True).option("emptyValue", "").option("nullValue", "\x00").csv(target)


_RI_REPORT, _SP_REPORT = ORACLES["ri_report"], ORACLES["sp_report"]


@query(f"""SELECT coalesce(reservation_reservation_a_r_n, '') AS reservation_reservation_a_r_n,
  coalesce("Usage Account ID", '') AS "Usage Account ID", "On-Demand Cost", "RI Effective Cost", "Savings"
FROM ({_RI_REPORT})""")
def ri_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_back(spark, S.ri_report(S.ri_savings(cur(spark, sf_dir)))).na.fill("")


@query(_SP_REPORT)
def sp_report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read_back(spark, S.sp_report(S.sp_savings(cur(spark, sf_dir), ids=SP_LIST))).na.fill("")


@query("""SELECT * FROM (VALUES ('2025a', 'Missing required columns: UsageAmount, UnblendedCost'), ('2025b', NULL))
  v(folder, problem)
WHERE (SELECT count(*) FROM supplier) > 0""")
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deliveries that lack columns are named with all that they lack."""
    root = scratch(spark, "exports")
    rows = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("LineItemType"), F.col("s_acctbal").alias("UnblendedCost"), F.lit(1).alias("UsageAmount")
    )
    _write_csv(_spread(rows.select("LineItemType")), f"{root}/2025a")
    _write_csv(_spread(rows), f"{root}/2025b")
    wanted = (TYPE, "line_item_usage_amount", COST)
    files = read_exports(spark, find_exports(spark, root), wanted).files
    folder = F.element_at(F.split("path", "/"), -2)
    return files.select(folder.alias("folder"), "problem").distinct()


@query(f"""WITH {CUR_SQL}
SELECT strftime(now() AT TIME ZONE 'UTC', '%Y-%m') AS usage_period, count(*) AS n
FROM cur WHERE line_item_line_item_type NOT IN ('Discount', 'Credit', 'Refund')
  AND line_item_line_item_type NOT LIKE '%Discount%'""")
def period_by_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job without a period replaces the current month (in UTC): all lines, moved to it."""
    now = F.date_trunc("month", F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()))
    lines = cur(spark, sf_dir).withColumn(START, now.cast("timestamp_ntz"))
    target = scratch(spark, "current")
    billing.run(spark, lines.select(TYPE, START), target)
    schema = f"{TYPE} string, {START} timestamp_ntz, usage_period string"
    rows = spark.read.schema(schema).parquet(target)
    return rows.groupBy("usage_period").agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT lpad(cast(c_custkey AS varchar), 12, '0') AS aws_id, c_name AS name,
  CASE WHEN c_nationkey % 2 = 0 THEN 'bucket' END AS bucket, concat('m/', c_custkey) AS monthly_dir
FROM customer""")
def account_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of the registry, from which keys are never loaded."""
    target = scratch(spark, "registry")
    customers = table(spark, sf_dir, "customer")
    customers.select(
        F.lpad(F.col("c_custkey").cast("string"), 12, "0").alias("aws_id"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_nationkey") % 2 == 0, "bucket").alias("bucket"),
        F.concat(F.lit("m/"), F.col("c_custkey").cast("string")).alias("monthly_dir"),
        F.lit("never").alias("access_key_id"),
        F.lit("never").alias("secret_access_key"),
    ).write.parquet(target)
    return read_registry(spark, target)
