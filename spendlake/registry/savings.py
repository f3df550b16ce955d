"""Savings of reserved instances and savings plans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators import savings as S
from spendlake.operators.ids import matches_any_id
from spendlake.plans import savings as plan
from spendlake.registry.catalog import query
from spendlake.registry.views import (
    CUR_SQL,
    PERIOD,
    PLAN_IDS_SQL,
    RESERVATION_IDS_SQL,
    as_double,
    cur,
    plan_ids,
    reservation_ids,
)

RI_LIST = ("ri-00", "ri-001", "ri-04", "zz")
SP_LIST = ("sp-001", "sp-007", "sp-012")


def ri_sql(period: str | None = None, ids: str = "", by_period: bool = False) -> str:
    month = "strftime(line_item_usage_start_date, '%Y-%m')"
    key = f"{month} AS usage_period, " if by_period else ""
    only = f"AND {month} = '{period}'" if period else ""
    keys = "reservation_subscription_id, reservation_reservation_a_r_n, line_item_usage_account_id"
    return f"""ri AS (
  SELECT {key}{keys},
    sum(pricing_public_on_demand_cost) AS on_demand_cost,
    sum(reservation_effective_cost) AS effective_cost,
    sum(pricing_public_on_demand_cost) - sum(reservation_effective_cost) AS savings
  FROM cur
  WHERE line_item_line_item_type = 'DiscountedUsage'
    AND reservation_subscription_id IS NOT NULL {only} {ids}
  GROUP BY {"usage_period, " if by_period else ""}{keys})"""


def sp_sql(period: str | None = None, ids: str = "", by_period: bool = False) -> str:
    month = "strftime(line_item_usage_start_date, '%Y-%m')"
    key = f"{month} AS usage_period, " if by_period else ""
    only = f"AND {month} = '{period}'" if period else ""
    keys = """line_item_usage_account_id, savings_plan_savings_plan_a_r_n, bill_payer_account_id,
    line_item_usage_type"""
    return f"""sp AS (
  SELECT {key}{keys},
    sum(line_item_usage_amount) AS usage_amount,
    sum(line_item_unblended_cost) AS on_demand_cost,
    sum(savings_plan_savings_plan_effective_cost) AS effective_cost,
    sum(line_item_unblended_cost) - sum(savings_plan_savings_plan_effective_cost) AS savings
  FROM cur
  WHERE line_item_line_item_type = 'SavingsPlanCoveredUsage' {only} {ids}
  GROUP BY {"usage_period, " if by_period else ""}{keys})"""


def any_of(column: str, ids: tuple[str, ...]) -> str:
    return "AND (" + " OR ".join(f"contains({column}, '{i}')" for i in ids) + ")"


def any_in(column: str, table: str) -> str:
    return f"AND EXISTS (SELECT 1 FROM {table} i WHERE contains({column}, i.id))"


RI_ARN, SP_ARN = S.RI_KEYS[1], S.SP_KEYS[1]
RI_OUT = """reservation_subscription_id, reservation_reservation_a_r_n,
  line_item_usage_account_id, cast(on_demand_cost AS double) AS on_demand_cost,
  cast(effective_cost AS double) AS effective_cost, cast(savings AS double) AS savings"""
_SP_MEASURES = """cast(usage_amount AS double) AS usage_amount,
  cast(on_demand_cost AS double) AS on_demand_cost,
  cast(effective_cost AS double) AS effective_cost, cast(savings AS double) AS savings"""
SP_OUT = f"""line_item_usage_account_id, savings_plan_savings_plan_a_r_n,
  bill_payer_account_id, line_item_usage_type, {_SP_MEASURES}"""


def _money(column: str) -> str:
    return f"concat('$', cast(cast(round({column}, 2) AS decimal(38,2)) AS varchar))"


def _number(column: str) -> str:
    return f"cast(cast(round({column}, 2) AS decimal(38,2)) AS varchar)"


@query(f"WITH {CUR_SQL}, {ri_sql(PERIOD)} SELECT {RI_OUT} FROM ri")
def ri_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(S.ri_savings(cur(spark, sf_dir), PERIOD), *S.RI_MEASURES)


@query(f"WITH {CUR_SQL}, {ri_sql(by_period=True)} SELECT usage_period, {RI_OUT} FROM ri")
def ri_savings_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(S.ri_savings(cur(spark, sf_dir), by_period=True), *S.RI_MEASURES)


@query(f"WITH {CUR_SQL}, {ri_sql(ids=any_of(RI_ARN, RI_LIST))} SELECT {RI_OUT} FROM ri")
def ri_savings_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(S.ri_savings(cur(spark, sf_dir), ids=RI_LIST), *S.RI_MEASURES)


@query(f"""WITH {CUR_SQL}, {RESERVATION_IDS_SQL},
{ri_sql(ids=any_in(RI_ARN, 'reservation_ids'))} SELECT {RI_OUT} FROM ri""")
def ri_savings_by_id_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = reservation_ids(spark, sf_dir)
    return as_double(S.ri_savings(cur(spark, sf_dir), ids=ids), *S.RI_MEASURES)


@query(f"""WITH {CUR_SQL}, {RESERVATION_IDS_SQL}
SELECT reservation_reservation_a_r_n, line_item_line_item_type, count(*) AS n,
  cast(sum(line_item_unblended_cost) AS double) AS cost
FROM cur WHERE true {any_in(RI_ARN, 'reservation_ids')}
GROUP BY reservation_reservation_a_r_n, line_item_line_item_type""")
def lines_matching_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = matches_any_id(
        cur(spark, sf_dir),
        RI_ARN,
        reservation_ids(spark, sf_dir),
        salt_by=("line_item_usage_account_id", "line_item_usage_start_date"),
    )
    grouped = kept.groupBy(RI_ARN, "line_item_line_item_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("line_item_unblended_cost").alias("cost")
    )
    return as_double(grouped, "cost")


@query(f"""WITH {CUR_SQL}, {ri_sql()}
SELECT CASE WHEN total THEN '' ELSE reservation_reservation_a_r_n END
    AS reservation_reservation_a_r_n,
  CASE WHEN total THEN '' ELSE line_item_usage_account_id END AS "Usage Account ID",
  {_money("on_demand_cost")} AS "On-Demand Cost",
  {_money("effective_cost")} AS "RI Effective Cost", {_money("savings")} AS "Savings"
FROM (
  SELECT false AS total, * FROM ri
  UNION ALL
  SELECT true, NULL, NULL, NULL, sum(on_demand_cost), sum(effective_cost), sum(savings) FROM ri)""")
def ri_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.ri_report(S.ri_savings(cur(spark, sf_dir)))


@query(f"""WITH {CUR_SQL}, {ri_sql()}
SELECT count(*) AS n_rows, cast(sum(on_demand_cost) AS double) AS on_demand_cost,
  cast(sum(effective_cost) AS double) AS effective_cost, cast(sum(savings) AS double) AS savings
FROM ri""")
def ri_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = S.ri_savings(cur(spark, sf_dir))
    return as_double(S.overall_totals(details, S.RI_MEASURES), *S.RI_MEASURES)


@query(f"""WITH {CUR_SQL}
SELECT 'pricing_public_on_demand_cost' AS checked_column,
  cast(sum(pricing_public_on_demand_cost) AS double) AS total,
  sum(pricing_public_on_demand_cost) = 0 AS all_zero FROM cur""")
def ri_cost_all_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(S.cost_all_zero(cur(spark, sf_dir)), "total")


@query(f"WITH {CUR_SQL}, {sp_sql(PERIOD)} SELECT {SP_OUT} FROM sp")
def sp_savings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(S.sp_savings(cur(spark, sf_dir), PERIOD), *S.SP_MEASURES)


@query(f"""WITH {CUR_SQL}, {PLAN_IDS_SQL},
{sp_sql(ids=any_in(SP_ARN, 'plan_ids'), by_period=True)}
SELECT usage_period, {SP_OUT} FROM sp""")
def sp_savings_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = S.sp_savings(cur(spark, sf_dir), ids=plan_ids(spark, sf_dir), by_period=True)
    return as_double(details, *S.SP_MEASURES)


@query(f"""WITH {CUR_SQL}, {sp_sql(ids=any_of(SP_ARN, SP_LIST))}
SELECT CASE WHEN total THEN 'GRAND TOTAL' ELSE line_item_usage_account_id END AS "Account ID",
  CASE WHEN total THEN '' ELSE savings_plan_savings_plan_a_r_n END AS "Savings Plan ID",
  CASE WHEN total THEN '' ELSE bill_payer_account_id END AS "Purchaser Account ID",
  CASE WHEN total THEN '' ELSE line_item_usage_type END AS "Usage Type",
  {_number("usage_amount")} AS "Usage Amount", {_money("on_demand_cost")} AS "On-Demand Cost",
  {_money("effective_cost")} AS "Effective Cost", {_money("savings")} AS "Savings"
FROM (
  SELECT false AS total, * FROM sp
  UNION ALL
  SELECT true, NULL, NULL, NULL, NULL, sum(usage_amount), sum(on_demand_cost),
    sum(effective_cost), sum(savings) FROM sp)""")
def sp_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sp_report(S.sp_savings(cur(spark, sf_dir), ids=SP_LIST))


@query(f"""WITH {CUR_SQL}, {sp_sql()}
SELECT line_item_usage_account_id, bill_payer_account_id, count(*) AS n_details,
  cast(sum(usage_amount) AS double) AS usage_amount,
  cast(sum(on_demand_cost) AS double) AS on_demand_cost,
  cast(sum(effective_cost) AS double) AS effective_cost, cast(sum(savings) AS double) AS savings
FROM sp GROUP BY line_item_usage_account_id, bill_payer_account_id""")
def sp_account_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = S.sp_savings(cur(spark, sf_dir))
    return as_double(S.account_summary(details), *S.SP_MEASURES)


_ACCOUNT_MEASURES = tuple(f"account_{m}" for m in S.SP_MEASURES)
_ACCOUNT_WINDOWS = ", ".join(
    f"cast(sum({m}) OVER (PARTITION BY line_item_usage_account_id, bill_payer_account_id)"
    f" AS double) AS account_{m}"
    for m in S.SP_MEASURES
)


@query(f"WITH {CUR_SQL}, {sp_sql()} SELECT {SP_OUT}, {_ACCOUNT_WINDOWS} FROM sp")
def sp_account_plan_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.account_plan_detail(S.sp_savings(cur(spark, sf_dir)))
    return as_double(rows, *S.SP_MEASURES, *_ACCOUNT_MEASURES)


@query(f"""WITH {CUR_SQL}, {sp_sql()}
SELECT count(DISTINCT (line_item_usage_account_id, bill_payer_account_id)) AS n_accounts,
  cast(sum(usage_amount) AS double) AS usage_amount,
  cast(sum(on_demand_cost) AS double) AS on_demand_cost,
  cast(sum(effective_cost) AS double) AS effective_cost, cast(sum(savings) AS double) AS savings
FROM sp""")
def sp_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_double(S.sp_totals(S.sp_savings(cur(spark, sf_dir))), *S.SP_MEASURES)


@query(f"WITH {CUR_SQL}, {sp_sql()} SELECT {SP_OUT} FROM sp")
def sp_partial_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Results of three separate parts, merged, are the result of the whole."""
    lines = cur(spark, sf_dir)
    bounds = ("0000-00", "1997-01", "1999-01", "9999-99")
    month = F.col("billing_period")
    parts = [
        S.sp_savings(lines.where((month >= low) & (month < high)))
        for low, high in zip(bounds, bounds[1:])
    ]
    return as_double(S.merge_savings(parts, S.SP_KEYS), *S.SP_MEASURES)


@query(f"""WITH {CUR_SQL}, {sp_sql()}, details AS (SELECT {SP_OUT}, {_ACCOUNT_WINDOWS} FROM sp)
SELECT * FROM details
WHERE line_item_usage_account_id = '000000000007' AND bill_payer_account_id = '000000000003'""")
def sp_detail_of_one_account(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.account_plan_detail(S.sp_savings(cur(spark, sf_dir)), "000000000007", "000000000003")
    return as_double(rows, *S.SP_MEASURES, *_ACCOUNT_MEASURES)


@query(f"""WITH {CUR_SQL}, {ri_sql(PERIOD)}
SELECT line_item_usage_account_id, count(*) AS n_details, cast(sum(on_demand_cost) AS double) AS on_demand_cost,
  cast(sum(effective_cost) AS double) AS effective_cost, cast(sum(savings) AS double) AS savings,
  (SELECT cast(sum(savings) AS double) FROM ri) AS total_savings, (SELECT count(*) FROM ri) AS n_rows,
  (SELECT count(*) FROM cur) AS n_lines,
  (SELECT cast(sum(pricing_public_on_demand_cost) AS double) FROM cur) AS on_demand_total, false AS all_zero
FROM ri GROUP BY line_item_usage_account_id""")
def ri_job_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's table of accounts, its totals, and what it saw of all lines in the same pass."""
    result = plan.ri_from_lines(cur(spark, sf_dir), no_files(spark), PERIOD)
    totals = result.totals.first()
    return as_double(result.accounts, *S.RI_MEASURES).withColumns(
        {
            "total_savings": F.lit(float(totals["savings"])),
            "n_rows": F.lit(totals["n_rows"]).cast("bigint"),
            "n_lines": F.lit(result.n_lines).cast("bigint"),
            "on_demand_total": F.lit(float(result.on_demand_total)),
            "all_zero": F.lit(result.on_demand_all_zero),
        }
    )


@query(f"""WITH {CUR_SQL}, {PLAN_IDS_SQL}, {sp_sql(PERIOD, ids=any_in(SP_ARN, 'plan_ids'))}
SELECT {SP_OUT}, {_ACCOUNT_WINDOWS},
  (SELECT count(DISTINCT (line_item_usage_account_id, bill_payer_account_id)) FROM sp) AS n_accounts,
  (SELECT cast(sum(savings) AS double) FROM sp) AS total_savings,
  count(*) OVER (PARTITION BY line_item_usage_account_id, bill_payer_account_id) AS n_details
FROM sp""")
def sp_job_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job's plans beside the totals of their accounts, its table of accounts and its totals."""
    result = plan.sp_from_lines(cur(spark, sf_dir), no_files(spark), PERIOD, plan_ids(spark, sf_dir))
    totals = result.totals.first()
    accounts = result.accounts.select(*S.ACCOUNT_KEYS, "n_details")
    rows = result.plans.join(accounts, list(S.ACCOUNT_KEYS)).withColumns(
        {
            "n_accounts": F.lit(totals["n_accounts"]).cast("bigint"),
            "total_savings": F.lit(float(totals["savings"])),
        }
    )
    return as_double(rows, *S.SP_MEASURES, *_ACCOUNT_MEASURES)


def no_files(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "path string, length long, problem string")
