"""Billing-shaped views of the test tables, in Spark and in SQL for the check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators.typed import TIME_COLUMNS

PERIOD = "2000-04"

PAYERS = 5
PLANS = 20
RESERVATIONS = 50
DOCUMENT_SIZE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cur(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items: ``lineitem`` with the account and billing month of its order."""
    return cur_columns(cur_parts(spark, sf_dir))


def cur_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the columns of line items are made of, and the billing month."""
    order_month = F.concat_ws(
        "-", F.year("o_orderdate").cast("string"), F.format_string("%02d", F.month("o_orderdate"))
    )
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    # Both sides grow with the data: join them as they have to be joined when large.
    return lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        "o_custkey", "l_suppkey", "l_partkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_shipdate",
        "l_quantity", "l_extendedprice", "l_discount", order_month.alias("billing_period"),
    )


def cur_columns(parts: DataFrame) -> DataFrame:
    """The columns of line items, row by row."""
    text = "string"
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    price = F.col("l_extendedprice")
    effective = (
        price.cast("decimal(18,2)") * (1 - F.col("l_discount").cast("decimal(4,2)"))
    ).cast("decimal(18,4)")
    line_type = (
        F.when((flag == "A") & (status == "F"), "Usage")
        .when((flag == "A") & (status == "O"), "DiscountedUsage")
        .when((flag == "N") & (status == "F"), "SavingsPlanCoveredUsage")
        .when((flag == "N") & (status == "O"), "Credit")
        .when((flag == "R") & (status == "F"), "EdpDiscount")
        .when((flag == "R") & (status == "O") & (F.col("l_linenumber") != 7), "Refund")
    )
    return parts.select(
        F.lpad(F.col("o_custkey").cast(text), 12, "0").alias("line_item_usage_account_id"),
        F.lpad((F.col("l_suppkey") % PAYERS).cast(text), 12, "0").alias("bill_payer_account_id"),
        line_type.alias("line_item_line_item_type"),
        F.col("l_shipdate").alias("line_item_usage_start_date"),
        F.concat(F.lit("BoxUsage:"), F.col("l_linenumber").cast(text)).alias("line_item_usage_type"),
        F.col("l_quantity").cast("decimal(18,4)").alias("line_item_usage_amount"),
        price.cast("decimal(18,4)").alias("line_item_unblended_cost"),
        price.cast("decimal(18,4)").alias("pricing_public_on_demand_cost"),
        effective.alias("reservation_effective_cost"),
        effective.alias("savings_plan_savings_plan_effective_cost"),
        F.concat(
            F.lit("arn:aws:savingsplans::x:savingsplan/sp-"),
            F.lpad((F.col("l_suppkey") % PLANS).cast(text), 3, "0"),
        ).alias("savings_plan_savings_plan_a_r_n"),
        F.when(
            F.col("l_linenumber") != 7, (F.col("l_partkey") % RESERVATIONS).cast(text)
        ).alias("reservation_subscription_id"),
        F.concat(
            F.lit("arn:aws:ec2:r:x:reserved-instances/ri-"),
            F.lpad((F.col("l_partkey") % RESERVATIONS).cast(text), 3, "0"),
        ).alias("reservation_reservation_a_r_n"),
        "billing_period",
    )


CUR_SQL = f"""cur AS (
  SELECT lpad(cast(o_custkey AS varchar), 12, '0') AS line_item_usage_account_id,
    lpad(cast(l_suppkey % {PAYERS} AS varchar), 12, '0') AS bill_payer_account_id,
    CASE WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'Usage'
         WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'DiscountedUsage'
         WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'SavingsPlanCoveredUsage'
         WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'Credit'
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'EdpDiscount'
         WHEN l_returnflag = 'R' AND l_linestatus = 'O' AND l_linenumber <> 7 THEN 'Refund'
    END AS line_item_line_item_type,
    l_shipdate AS line_item_usage_start_date,
    concat('BoxUsage:', cast(l_linenumber AS varchar)) AS line_item_usage_type,
    cast(l_quantity AS decimal(18,4)) AS line_item_usage_amount,
    cast(l_extendedprice AS decimal(18,4)) AS line_item_unblended_cost,
    cast(l_extendedprice AS decimal(18,4)) AS pricing_public_on_demand_cost,
    cast(cast(l_extendedprice AS decimal(18,2)) * (1 - cast(l_discount AS decimal(4,2)))
         AS decimal(18,4)) AS reservation_effective_cost,
    cast(cast(l_extendedprice AS decimal(18,2)) * (1 - cast(l_discount AS decimal(4,2)))
         AS decimal(18,4)) AS savings_plan_savings_plan_effective_cost,
    concat('arn:aws:savingsplans::x:savingsplan/sp-',
      lpad(cast(l_suppkey % {PLANS} AS varchar), 3, '0')) AS savings_plan_savings_plan_a_r_n,
    CASE WHEN l_linenumber <> 7 THEN cast(l_partkey % {RESERVATIONS} AS varchar)
    END AS reservation_subscription_id,
    concat('arn:aws:ec2:r:x:reserved-instances/ri-',
      lpad(cast(l_partkey % {RESERVATIONS} AS varchar), 3, '0')) AS reservation_reservation_a_r_n,
    strftime(o_orderdate, '%Y-%m') AS billing_period
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def plan_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Savings plans that suppliers of the lower half of nations buy."""
    suppliers = table(spark, sf_dir, "supplier").where(F.col("s_nationkey") < 12)
    number = F.lpad((F.col("s_suppkey") % PLANS).cast("string"), 3, "0")
    return suppliers.select(F.concat(F.lit("sp-"), number).alias("id")).distinct()


PLAN_IDS_SQL = f"""plan_ids AS (
  SELECT DISTINCT concat('sp-', lpad(cast(s_suppkey % {PLANS} AS varchar), 3, '0')) AS id
  FROM supplier WHERE s_nationkey < 12)"""


def reservation_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reservations named after parts of small size: ids of two lengths, some matching none."""
    parts = table(spark, sf_dir, "part").where(F.col("p_size") <= 10)
    number = (F.col("p_partkey") % (2 * RESERVATIONS)).cast("string")
    full = F.concat(F.lit("ri-"), F.lpad(number, 3, "0"))
    group = F.concat(F.lit("/ri-"), F.substring(F.lpad(number, 3, "0"), 1, 2))
    pick = F.when(F.col("p_partkey") % 9 == 0, group).otherwise(full)
    return parts.select(pick.alias("id")).distinct()


RESERVATION_IDS_SQL = f"""reservation_ids AS (
  SELECT DISTINCT CASE WHEN p_partkey % 9 = 0
    THEN concat('/ri-', substr(lpad(cast(p_partkey % {2 * RESERVATIONS} AS varchar), 3, '0'), 1, 2))
    ELSE concat('ri-', lpad(cast(p_partkey % {2 * RESERVATIONS} AS varchar), 3, '0')) END AS id
  FROM part WHERE p_size <= 10)"""


def resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resource inventory made of events."""
    k = F.get_json_object("props", "$.k").cast("int") % 5
    kind = F.col("event_type")
    region = (
        F.when(kind == "view", "ap-southeast-1")
        .when(kind == "click", "ap-northeast-1")
        .when(kind == "purchase", "ap-east-1")
        .otherwise("us-east-1")
    )
    owner = F.lpad(F.col("user_id").cast("string"), 12, "0")
    number = F.col("event_id").cast("string")
    bucket = F.when(F.col("event_id") % 7 == 0, "cf-templates-").otherwise("bucket-")
    arn = F.when(k == 1, F.concat(F.lit("arn:aws:s3:::"), bucket, number)).otherwise(
        F.concat(F.lit("arn:aws:ec2:"), region, F.lit(":"), owner, F.lit(":res/"), number)
    )
    rtype = (
        F.when(k == 0, "ec2:instance")
        .when(k == 1, "s3:bucket")
        .when(k == 2, "iam:role")
        .when(k == 3, "lambda:function")
        .otherwise("ec2:volume")
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        arn.alias("Arn"),
        region.alias("Region"),
        owner.alias("OwningAccountId"),
        rtype.alias("ResourceType"),
    )


RESOURCES_SQL = """res AS (
  SELECT event_id, region, owner, rtype,
    CASE WHEN k5 = 1 THEN concat('arn:aws:s3:::',
           CASE WHEN event_id % 7 = 0 THEN 'cf-templates-' ELSE 'bucket-' END, event_id)
         ELSE concat('arn:aws:ec2:', region, ':', owner, ':res/', event_id) END AS arn
  FROM (SELECT event_id, k5,
      CASE event_type WHEN 'view' THEN 'ap-southeast-1' WHEN 'click' THEN 'ap-northeast-1'
        WHEN 'purchase' THEN 'ap-east-1' ELSE 'us-east-1' END AS region,
      lpad(cast(user_id AS varchar), 12, '0') AS owner,
      CASE k5 WHEN 0 THEN 'ec2:instance' WHEN 1 THEN 's3:bucket' WHEN 2 THEN 'iam:role'
        WHEN 3 THEN 'lambda:function' ELSE 'ec2:volume' END AS rtype
    FROM (SELECT *, cast(json_extract_string(props, '$.k') AS int) % 5 AS k5 FROM events)))"""


def inventory_documents(spark: SparkSession, sf_dir: str, keep: str | None = None) -> DataFrame:
    """Inventory documents of at most ``DOCUMENT_SIZE`` resources each, as a service pages them."""
    item = F.struct("Arn", "Region", "OwningAccountId", "ResourceType")
    page = F.floor(F.col("event_id") / DOCUMENT_SIZE)
    return (
        resources(spark, sf_dir)
        .groupBy(page.alias("page"))
        .agg(F.collect_list(item).alias("Resources"))
        .select(F.to_json(F.struct("Resources")).alias("value"), *([keep] if keep else []))
    )


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account aliases: customers, some of whom have none."""
    customers = table(spark, sf_dir, "customer").where(F.col("c_custkey") % 10 != 0)
    account = F.lpad(F.col("c_custkey").cast("string"), 12, "0")
    return customers.select(account.alias("account_id"), F.col("c_name").alias("alias"))


EXCLUDED_ACCOUNT = "000000000007"

UNTAGGED_SQL = f"""untagged AS (
  SELECT r.label AS region_label,
    concat('HK-', coalesce(c.c_name, res.owner)) AS account, res.arn AS arn
  FROM res
  JOIN (VALUES ('ap-southeast-1', 'SG'), ('ap-northeast-1', 'JP'), ('ap-east-1', 'HK'))
    AS r(region, label) ON r.region = res.region
  LEFT JOIN (SELECT lpad(cast(c_custkey AS varchar), 12, '0') AS id, c_name
    FROM customer WHERE c_custkey % 10 <> 0) c ON c.id = res.owner
  WHERE split_part(res.arn, ':', 5) <> '{EXCLUDED_ACCOUNT}' AND res.owner <> '{EXCLUDED_ACCOUNT}'
    AND res.rtype IN ('ec2:instance', 's3:bucket', 'lambda:function', 'ec2:volume')
    AND NOT contains(res.arn, 'cf-templates')
    AND NOT contains(res.arn, 'aws-tagging-automation'))"""


def json_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map texts of every kind: objects with numbers or words, empty, and no object at all."""
    kind, number = F.col("event_type"), F.col("event_id").cast("string")
    text = (
        F.when(kind == "click", F.concat(F.lit('{"a": "0.5", "id": '), number, F.lit("}")))
        .when(kind == "error", F.concat(F.lit('{"n": null, "t": true, "w": "x'), number, F.lit('"}')))
        .when(kind == "purchase", F.concat(F.lit("plain "), number))
        .when(F.col("event_id") % 2 == 0, F.col("props"))
        .when(F.col("event_id") % 3 == 0, "")
    )
    return table(spark, sf_dir, "events").select("event_id", text.alias("raw"))


JSON_TEXTS_SQL = """json_texts AS (
  SELECT event_id, event_type,
    CASE WHEN event_type = 'click' THEN concat('{"a": "0.5", "id": ', event_id, '}')
         WHEN event_type = 'error'
           THEN concat('{"n": null, "t": true, "w": "x', event_id, '"}')
         WHEN event_type = 'purchase' THEN concat('plain ', event_id)
         WHEN event_id % 2 = 0 THEN props
         WHEN event_id % 3 = 0 THEN '' END AS raw
  FROM events)"""


def as_double(rows: DataFrame, *columns: str) -> DataFrame:
    """Decimal results as doubles, the type the check compares."""
    return rows.withColumns({c: F.col(c).cast("double") for c in columns})


def time_text(rows: DataFrame) -> DataFrame:
    """Times in the form that exports write them."""
    iso = {
        c: F.concat(F.replace(F.col(c).cast("string"), F.lit(" "), F.lit("T")), F.lit("Z"))
        for c in rows.columns
        if c in TIME_COLUMNS
    }
    return rows.withColumns(iso) if iso else rows
