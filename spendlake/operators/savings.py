"""What reserved instances and savings plans saved."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from spendlake.functions import amounts
from spendlake.operators.columns import (
    RI_COLUMNS,
    SP_COLUMNS,
    canonical,
    missing_columns,
    missing_message,
    spelling,
)
from spendlake.operators.ids import (
    INLINE_IDS,
    ids_frame,
    matches_any_id,
    matching_values,
    usable_ids,
)
from spendlake.operators.lines import TYPE, in_period, with_usage_period
from spendlake.operators.skew import salted_join

RI_KEYS = (
    "reservation_subscription_id",
    "reservation_reservation_a_r_n",
    "line_item_usage_account_id",
)
RI_MEASURES = ("on_demand_cost", "effective_cost", "savings")

SP_KEYS = (
    "line_item_usage_account_id",
    "savings_plan_savings_plan_a_r_n",
    "bill_payer_account_id",
    "line_item_usage_type",
)
SP_MEASURES = ("usage_amount", "on_demand_cost", "effective_cost", "savings")

ACCOUNT_KEYS = ("line_item_usage_account_id", "bill_payer_account_id")

GRAND_TOTAL = "GRAND TOTAL"

Ids = Sequence[str] | DataFrame


def ri_savings(
    lines: DataFrame,
    period: str | None = None,
    ids: Ids | None = None,
    by_period: bool = False,
) -> DataFrame:
    """Public on-demand cost against effective cost of reserved usage.

    One row per subscription, reservation and account; also per usage month with
    ``by_period``. No ``ids`` means every reservation, an empty list means none.
    """
    rows = canonical(lines, RI_COLUMNS).where(
        (F.col(TYPE) == "DiscountedUsage") & F.col(RI_KEYS[0]).isNotNull()
    )
    sums = {
        "on_demand_cost": "pricing_public_on_demand_cost",
        "effective_cost": "reservation_effective_cost",
    }
    return _savings(rows, period, ids, RI_KEYS[1], RI_KEYS, sums, by_period)


def sp_savings(
    lines: DataFrame,
    period: str | None = None,
    ids: Ids | None = None,
    by_period: bool = False,
) -> DataFrame:
    """Unblended (on-demand) cost against effective cost of usage under savings plans.

    One row per account, plan, payer and usage type; also per usage month with
    ``by_period``. A list of plan ids has to name at least one.
    """
    if ids is not None and not isinstance(ids, DataFrame) and not ids:
        raise ValueError("Give at least one savings plan id")
    rows = canonical(lines, SP_COLUMNS).where(F.col(TYPE) == "SavingsPlanCoveredUsage")
    sums = {
        "usage_amount": "line_item_usage_amount",
        "on_demand_cost": "line_item_unblended_cost",
        "effective_cost": "savings_plan_savings_plan_effective_cost",
    }
    return _savings(rows, period, ids, SP_KEYS[1], SP_KEYS, sums, by_period)


def _savings(rows, period, ids, id_column, keys, sums, by_period) -> DataFrame:
    rows = in_period(rows, period)
    if by_period:
        rows = with_usage_period(rows)
        keys = ("usage_period", *keys)
    late_ids = None
    if ids is not None:
        if not isinstance(ids, DataFrame):
            ids = usable_ids(ids)
            if len(ids) > INLINE_IDS:
                ids = ids_frame(rows.sparkSession, ids)
        if isinstance(ids, DataFrame):
            late_ids = ids
        else:
            rows = matches_any_id(rows, id_column, ids)
    for key in keys:  # a line without one of its keys belongs to no group
        rows = rows.where(F.col(key).isNotNull())
    grouped = (
        rows.groupBy(*keys)
        .agg(
            *(
                amounts.total(F.col(source), rows.schema[source].dataType).alias(name)
                for name, source in sums.items()
            )
        )
        .withColumn("savings", F.col("on_demand_cost") - F.col("effective_cost"))
    )
    if late_ids is None:
        return grouped
    # Ids are looked up in the groups' distinct values: both uses share the groups' shuffle, so the
    # lines are read once.
    hits = matching_values(grouped, id_column, late_ids)
    kept = salted_join(grouped, hits, [id_column], "left_semi", keys)
    return kept.select(*grouped.columns)


def merge_savings(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One result from results of separate runs (files, periods, accounts)."""
    together = reduce(DataFrame.unionByName, parts)
    measures = [c for c in together.columns if c not in keys]
    return together.groupBy(*keys).agg(*(F.sum(m).alias(m) for m in measures))


def account_summary(details: DataFrame) -> DataFrame:
    """Measures per account and payer, and the number of detail rows behind them."""
    return details.groupBy(*ACCOUNT_KEYS).agg(
        F.count(F.lit(1)).alias("n_details"), *(F.sum(m).alias(m) for m in SP_MEASURES)
    )


def ri_account_summary(details: DataFrame) -> DataFrame:
    """Measures per account, and the number of reservations' rows behind them."""
    return details.groupBy(RI_KEYS[2]).agg(
        F.count(F.lit(1)).alias("n_details"), *(F.sum(m).alias(m) for m in RI_MEASURES)
    )


def account_plan_detail(
    details: DataFrame,
    account: str | None = None,
    payer: str | None = None,
    slices: int = 16,
) -> DataFrame:
    """Every detail row next to the totals of its account.

    A join with the summary and not a window: a window would sort all rows of a hot account
    in one task. ``account`` and ``payer`` narrow it to one of them.
    """
    for column, value in zip(ACCOUNT_KEYS, (account, payer)):
        if value is not None:
            details = details.where(F.col(column) == value)
    totals = account_summary(details).select(
        *ACCOUNT_KEYS, *(F.col(m).alias(f"account_{m}") for m in SP_MEASURES)
    )
    return salted_join(details, totals, ACCOUNT_KEYS, "inner", SP_KEYS, slices)


def with_grand_total(
    details: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """Details and one row over all of them (zeros when there are none), by ``is_total``.

    Both sides read the same aggregate, which the planner shuffles once.
    """
    labels = [
        F.lit(GRAND_TOTAL if i == 0 else "").alias(key) for i, key in enumerate(keys)
    ]
    total = overall_totals(details, measures).select(F.lit(1).alias("is_total"), *labels, *measures)
    return details.select(F.lit(0).alias("is_total"), *keys, *measures).unionByName(total)


def overall_totals(details: DataFrame, measures: Sequence[str]) -> DataFrame:
    """One row: how many rows, and the sum of each measure over all of them."""
    return details.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures),
    )


def sp_totals(details: DataFrame) -> DataFrame:
    """One row: the number of (account, payer) pairs and the sum of each measure."""
    return account_summary(details).agg(
        F.count(F.lit(1)).alias("n_accounts"),
        *(F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in SP_MEASURES),
    )


ON_DEMAND = "pricing_public_on_demand_cost"


def _spelled(lines: DataFrame, column: str) -> str:
    found = spelling(lines.columns, column)
    if found is None:
        raise ValueError(missing_message(missing_columns(lines.columns, [column])))
    return found


def cost_all_zero(lines: DataFrame, column: str = ON_DEMAND) -> DataFrame:
    """Quality check over all lines, before any filter: is the cost column all zero?

    The column may go by any of its spellings.
    """
    found = _spelled(lines, column)
    total = amounts.total(F.col(f"`{found}`"), lines.schema[found].dataType)
    return lines.agg(total.alias("total")).select(
        F.lit(column).alias("checked_column"), "total", (F.col("total") == 0).alias("all_zero")
    )


def observed_cost(lines: DataFrame, seen: Observation, column: str = ON_DEMAND) -> DataFrame:
    """The lines; their number and the sum of a cost are known to ``seen`` once they are read.

    This is ``cost_all_zero`` without a pass of its own. (A task that runs twice may count twice,
    which makes no sum zero that is not, nor the other way round, as long as costs have one sign.)
    """
    found = _spelled(lines, column)
    total = amounts.total(F.col(f"`{found}`"), lines.schema[found].dataType)
    return lines.observe(seen, F.count(F.lit(1)).alias("n_lines"), total.alias("total"))


def ri_report(details: DataFrame) -> DataFrame:
    """The report table, in order, total last; the subscription is used to sort, not shown."""
    rows = with_grand_total(details, RI_KEYS, RI_MEASURES).orderBy("is_total", *RI_KEYS)
    return rows.select(
        F.col("reservation_reservation_a_r_n"),
        F.col("line_item_usage_account_id").alias("Usage Account ID"),
        amounts.money_text(F.col("on_demand_cost")).alias("On-Demand Cost"),
        amounts.money_text(F.col("effective_cost")).alias("RI Effective Cost"),
        amounts.money_text(F.col("savings")).alias("Savings"),
    )


def sp_report(details: DataFrame) -> DataFrame:
    """The report table: by account, payer, plan and usage type, total last."""
    rows = with_grand_total(details, SP_KEYS, SP_MEASURES).orderBy(
        "is_total",
        "line_item_usage_account_id",
        "bill_payer_account_id",
        "savings_plan_savings_plan_a_r_n",
        "line_item_usage_type",
    )
    return rows.select(
        F.col("line_item_usage_account_id").alias("Account ID"),
        F.col("savings_plan_savings_plan_a_r_n").alias("Savings Plan ID"),
        F.col("bill_payer_account_id").alias("Purchaser Account ID"),
        F.col("line_item_usage_type").alias("Usage Type"),
        amounts.fixed_text(F.col("usage_amount")).alias("Usage Amount"),
        amounts.money_text(F.col("on_demand_cost")).alias("On-Demand Cost"),
        amounts.money_text(F.col("effective_cost")).alias("Effective Cost"),
        amounts.money_text(F.col("savings")).alias("Savings"),
    )
