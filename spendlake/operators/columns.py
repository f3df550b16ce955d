"""Logical billing columns under the header spellings that exports use."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The header spellings of each logical column, first match wins.
CANDIDATES: dict[str, tuple[str, ...]] = {
    "line_item_line_item_type": (
        "line_item_line_item_type", "lineItem/LineItemType", "LineItemType", "lineItemType"),
    "line_item_usage_start_date": (
        "line_item_usage_start_date", "lineItem/UsageStartDate", "UsageStartDate", "usageStartDate"),
    "line_item_usage_account_id": (
        "line_item_usage_account_id", "lineItem/UsageAccountId", "UsageAccountId", "usageAccountId"),
    "bill_payer_account_id": (
        "bill_payer_account_id", "bill/PayerAccountId", "PayerAccountId", "payerAccountId"),
    "line_item_usage_type": (
        "line_item_usage_type", "lineItem/UsageType", "UsageType", "usageType"),
    "line_item_usage_amount": (
        "line_item_usage_amount", "lineItem/UsageAmount", "UsageAmount", "usageAmount"),
    "line_item_unblended_cost": (
        "line_item_unblended_cost", "lineItem/UnblendedCost", "UnblendedCost", "unblendedCost"),
    "pricing_public_on_demand_cost": (
        "pricing_public_on_demand_cost", "pricing/PublicOnDemandCost", "PublicOnDemandCost",
        "publicOnDemandCost"),
    "reservation_effective_cost": (
        "reservation_effective_cost", "reservation/EffectiveCost", "EffectiveCost", "effectiveCost"),
    "reservation_subscription_id": (
        "reservation_subscription_id", "reservation/SubscriptionId", "SubscriptionId",
        "subscriptionId"),
    "reservation_reservation_a_r_n": (
        "reservation_reservation_a_r_n", "reservation/ReservationARN", "ReservationARN",
        "reservationArn"),
    "reservation_recurring_fee_for_usage": (
        "reservation_recurring_fee_for_usage", "line_item_unblended_cost", "lineItem/UnblendedCost",
        "UnblendedCost", "unblendedCost"),
    "savings_plan_savings_plan_effective_cost": (
        "savings_plan_savings_plan_effective_cost", "savingsPlan/SavingsPlanEffectiveCost",
        "SavingsPlanEffectiveCost", "savingsPlanEffectiveCost"),
    "savings_plan_savings_plan_a_r_n": (
        "savings_plan_savings_plan_a_r_n", "lineItem/SavingsPlanId", "SavingsPlanId",
        "savingsPlanId"),
}

# How an error names a missing column.
LABELS: dict[str, str] = {
    "line_item_line_item_type": "LineItemType",
    "line_item_usage_start_date": "UsageStartDate",
    "line_item_usage_account_id": "UsageAccountId",
    "bill_payer_account_id": "PayerAccountId",
    "line_item_usage_type": "UsageType",
    "line_item_usage_amount": "UsageAmount",
    "line_item_unblended_cost": "UnblendedCost",
    "pricing_public_on_demand_cost": "PublicOnDemandCost",
    "reservation_effective_cost": "EffectiveCost",
    "reservation_subscription_id": "SubscriptionId",
    "reservation_reservation_a_r_n": "ReservationARN",
    "reservation_recurring_fee_for_usage": "RIFeeCost",
    "savings_plan_savings_plan_effective_cost": "SavingsPlanEffectiveCost",
    "savings_plan_savings_plan_a_r_n": "SavingsPlanId",
}

RI_COLUMNS = (
    "line_item_line_item_type",
    "reservation_subscription_id",
    "reservation_reservation_a_r_n",
    "line_item_usage_account_id",
    "pricing_public_on_demand_cost",
    "reservation_effective_cost",
    "line_item_usage_start_date",
)

SP_COLUMNS = (
    "line_item_line_item_type",
    "line_item_usage_account_id",
    "line_item_usage_amount",
    "line_item_unblended_cost",
    "savings_plan_savings_plan_effective_cost",
    "savings_plan_savings_plan_a_r_n",
    "line_item_usage_start_date",
    "bill_payer_account_id",
    "line_item_usage_type",
)


def spelling(header: Sequence[str], logical: str) -> str | None:
    """The spelling of a logical column that the header uses."""
    present = set(header)
    return next((c for c in CANDIDATES.get(logical, (logical,)) if c in present), None)


def missing_columns(header: Sequence[str], wanted: Iterable[str]) -> list[str]:
    """Names, as errors show them, of the logical columns that the header lacks."""
    return [LABELS.get(c, c) for c in wanted if spelling(header, c) is None]


def missing_message(missing: Sequence[str]) -> str:
    return f"Missing required columns: {', '.join(missing)}"


def canonical(lines: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """The logical columns, under their canonical names; all missing ones in one error."""
    missing = missing_columns(lines.columns, wanted)
    if missing:
        raise ValueError(missing_message(missing))
    return lines.select(*(F.col(f"`{spelling(lines.columns, c)}`").alias(c) for c in wanted))
