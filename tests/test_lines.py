from datetime import datetime

import pytest

from spendlake.operators import lines as L

JUNE, JULY = datetime(2025, 6, 3), datetime(2025, 7, 1)


def frame(spark, rows):
    return spark.createDataFrame(
        rows,
        "line_item_line_item_type string, line_item_usage_start_date timestamp_ntz, billing_period string",
    )


def test_billable_types(spark):
    types = ["DiscountedUsage", "EdpDiscount", "BundledDiscount", None, "Usage", "Credit", "Refund", "Discount", "Tax"]
    lines = frame(spark, [(t, JUNE, "2025-06") for t in types])
    kept = {r[0] for r in L.billable(lines).collect()}
    assert kept == {"Usage", "Tax"}
    kept = {r[0] for r in L.billable(lines, ("DiscountedUsage",)).collect()}
    assert kept == {"Usage", "Tax", "DiscountedUsage"}


def test_usage_period_keeps_the_billed_one(spark):
    lines = frame(spark, [("Usage", JUNE, "2025-07"), ("Usage", JULY, "2025-07")])
    rows = L.billable_lines(lines, "2025-06").collect()
    assert [(r.usage_period, r.billing_period, r.year, r.month) for r in rows] == [
        ("2025-06", "2025-07", 2025, 6)
    ]


def test_no_start_date_is_in_no_month(spark):
    lines = frame(spark, [("Usage", None, "2025-06")])
    assert L.billable_lines(lines, "2025-06").count() == 0
    assert L.billable_lines(lines).count() == 1


def test_etl_and_rest_make_up_the_period(spark):
    types = ["Usage", "Credit", "EdpDiscount", None, "Tax", "DiscountedUsage"]
    lines = frame(spark, [(t, d, "x") for t in types for d in (JUNE, JULY) for _ in range(3)])
    kept = L.billable_lines(lines, "2025-06").count()
    whole = L.in_period(lines, "2025-06")
    dropped = whole.count() - whole.where(
        "line_item_line_item_type in ('Usage', 'Tax')"
    ).count()
    assert (kept, dropped) == (6, 12)


def test_retention(spark):
    months = ["2025-03", "2025-04", "2025-05", "2025-06", "2025-07"]
    lines = frame(spark, [("Usage", JUNE, m) for m in months])
    kept = sorted(r.billing_period for r in L.retained(lines, "2025-07-15").collect())
    assert kept == ["2025-04", "2025-05", "2025-06", "2025-07"]


def test_bad_period(spark):
    with pytest.raises(ValueError, match="YYYY-MM"):
        L.in_period(frame(spark, []), "June")
