"""Line items: usage period, billable filter, month range, retention."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendlake.functions import times

START = "line_item_usage_start_date"
TYPE = "line_item_line_item_type"

# Line types that are no charge.
NOT_BILLABLE = ("Discount", "Credit", "Refund")


def with_usage_period(lines: DataFrame, name: str = "usage_period") -> DataFrame:
    """Adds ``usage_date``, ``year``, ``month`` and the usage month under ``name``.

    The name differs from the ``billing_period`` of the table on purpose: column names are
    matched without case, so a ``BILLING_PERIOD`` would replace the month that was billed.
    """
    day = F.to_date(times.utc_clock(F.col(START), lines.schema[START].dataType))
    return lines.withColumn("usage_date", day).withColumns(
        {
            "year": F.year("usage_date"),
            "month": F.month("usage_date"),
            name: times.period_of(F.col("usage_date")),
        }
    )


def unparsable_counts(
    lines: DataFrame, times_: Sequence[str] = (START,), amounts_: Sequence[str] = ()
) -> DataFrame:
    """One row per text column: how many cells hold something that is no time or no amount.

    Such cells become NULL in typed tables and leave month ranges, so a load can be refused or
    reported by these counts; one pass, one aggregate.
    """
    def bad(name: str, parsed) -> Column:
        held = F.trim(F.col(name).cast("string")) != ""
        return F.struct(
            F.lit(name).alias("column"),
            F.coalesce(F.count_if(held & parsed.isNull()), F.lit(0)).alias("unparsable"),
            F.count_if(held).alias("present"),
        )

    counts = [bad(c, times.utc_clock(F.col(c), lines.schema[c].dataType)) for c in times_]
    counts += [bad(c, F.col(c).cast("string").try_cast("decimal(38,12)")) for c in amounts_]
    return lines.agg(F.array(*counts).alias("found")).select(F.inline("found"))


def in_period(lines: DataFrame, period: str | None) -> DataFrame:
    """Usage that starts within one month; no period keeps every row.

    A range on the stored column, not a test on the derived month, so that the scan can
    skip row groups by their statistics.
    """
    if period is None:
        return lines
    return lines.where(times.in_month(F.col(START), lines.schema[START].dataType, period))


def near_billing_period(
    lines: DataFrame, period: str, slack_months: int, column: str = "billing_period"
) -> DataFrame:
    """Prunes to the partitions around a usage month.

    Opt-in: late usage and fees are billed in other months than they are used, so the
    slack has to cover them.
    """
    return lines.where(
        F.col(column).between(
            times.add_months(period, -slack_months), times.add_months(period, slack_months)
        )
    )


def billable(lines: DataFrame, keep_types: Sequence[str] = ()) -> DataFrame:
    """Drops discounts, credits, refunds and every type naming a discount.

    ``DiscountedUsage`` names one as well and goes too, unless listed in ``keep_types``. A
    NULL type is dropped.
    """
    line_type = F.col(TYPE)
    wanted = ~line_type.isin(*NOT_BILLABLE) & ~line_type.contains("Discount")
    if keep_types:
        wanted = wanted | line_type.isin(*keep_types)
    return lines.where(wanted)


def billable_lines(
    lines: DataFrame,
    period: str | None = None,
    keep_types: Sequence[str] = (),
    name: str = "usage_period",
) -> DataFrame:
    """The billing ETL up to its write: scan, filter, project; no shuffle."""
    return with_usage_period(billable(in_period(lines, period), keep_types), name)


def retained(
    lines: DataFrame, as_of: str | None = None, months: int = 3, column: str = "billing_period"
) -> DataFrame:
    """Partitions not older than ``months`` before the day ``as_of`` (default: today, UTC)."""
    current = as_of[:7] if as_of else times.current_period()
    return lines.where(F.col(column) >= times.add_months(current, -months))
