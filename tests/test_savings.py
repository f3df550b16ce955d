import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendlake.operators import savings as S
from spendlake.operators.ids import contains_any, ids_frame, matches_any_id, matching_values

JUNE = datetime(2025, 6, 3)
RI_DDL = (
    "line_item_line_item_type string, reservation_subscription_id string, "
    "reservation_reservation_a_r_n string, line_item_usage_account_id string, "
    "pricing_public_on_demand_cost double, reservation_effective_cost double, "
    "line_item_usage_start_date timestamp_ntz"
)
SP_DDL = (
    "line_item_line_item_type string, line_item_usage_account_id string, "
    "line_item_usage_amount double, line_item_unblended_cost double, "
    "savings_plan_savings_plan_effective_cost double, savings_plan_savings_plan_a_r_n string, "
    "line_item_usage_start_date timestamp_ntz, bill_payer_account_id string, "
    "line_item_usage_type string"
)


def ri_lines(spark, rows):
    return spark.createDataFrame([("DiscountedUsage", *r, JUNE) for r in rows], RI_DDL)


def sp_lines(spark, n=400, seed=1):
    r = random.Random(seed)
    rows = [
        (
            r.choice(["SavingsPlanCoveredUsage"] * 4 + ["Usage"]),
            r.choice(["000000000001", "000000000002", None]),
            r.choice([1.5, 2.25, None]),
            round(r.uniform(0, 100), 4),
            round(r.uniform(0, 50), 4),
            f"arn:sp-{r.randrange(12)}",
            r.choice([JUNE, datetime(2025, 7, 1)]),
            r.choice(["payer1", "payer2"]),
            r.choice(["box", "disk"]),
        )
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, SP_DDL)


def test_null_keys_and_null_amounts(spark):
    lines = ri_lines(
        spark,
        [
            ("s", "arn:ri-1", "a", None, None),
            ("s", "arn:ri-1", None, 1.0, 1.0),
            (None, "arn:ri-1", "a", 1.0, 1.0),
            ("s", None, "a", 1.0, 1.0),
        ],
    )
    rows = S.ri_savings(lines, "2025-06").collect()
    assert [tuple(r) for r in rows] == [("s", "arn:ri-1", "a", 0, 0, 0)]


def test_substring_ids(spark):
    lines = ri_lines(spark, [("s", f"arn:ri-{i}", "a", 2.0, 1.0) for i in (1, 10, 2, 3)])
    found = S.ri_savings(lines, "2025-06", ["ri-1", "0"])
    assert sorted(r[1] for r in found.collect()) == ["arn:ri-1", "arn:ri-10"]


def test_no_list_and_empty_list(spark):
    lines = ri_lines(spark, [("s", "arn:ri-1", "a", 2.0, 1.0)])
    assert S.ri_savings(lines, ids=None).count() == 1
    assert S.ri_savings(lines, ids=[]).count() == 0
    assert S.ri_savings(lines, ids=ids_frame(spark, [])).count() == 0
    with pytest.raises(ValueError, match="at least one"):
        S.sp_savings(sp_lines(spark, 5), ids=[])


def test_missing_columns_in_one_error(spark):
    lines = ri_lines(spark, []).drop("reservation_effective_cost", "line_item_line_item_type")
    with pytest.raises(ValueError, match="Missing required columns: LineItemType, EffectiveCost"):
        S.ri_savings(lines)


def test_header_spellings(spark):
    lines = ri_lines(spark, [("s", "arn:ri-1", "a", 2.0, 0.5)])
    camel = lines.withColumnsRenamed(
        {
            "line_item_line_item_type": "lineItem/LineItemType",
            "reservation_effective_cost": "effectiveCost",
            "reservation_reservation_a_r_n": "ReservationARN",
        }
    )
    assert S.ri_savings(camel).collect() == S.ri_savings(lines).collect()


def brute_force(texts, ids):
    return sorted(t for t in texts if t is not None and any(i in t for i in ids))


@pytest.mark.parametrize("seed", range(4))
def test_any_id_by_every_way(spark, seed):
    r = random.Random(seed)
    texts = ["".join(r.choice("ab-") for _ in range(r.randrange(12))) for _ in range(200)] + [None]
    ids = ["".join(r.choice("ab-") for _ in range(r.randrange(1, 6))) for _ in range(6)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, arn string")
    expected = brute_force(texts, ids)
    table = ids_frame(spark, ids)

    def arns(df):
        return sorted(x.arn for x in df.collect())

    assert arns(rows.where(contains_any(F.col("arn"), ids))) == expected
    assert arns(matches_any_id(rows, "arn", ids)) == expected
    assert arns(matches_any_id(rows, "arn", table)) == expected
    assert arns(matches_any_id(rows, "arn", [*ids, *(f"zz{i}" for i in range(99))])) == expected
    assert arns(matching_values(rows, "arn", table)) == sorted(set(expected))


def test_id_table_equals_id_list(spark):
    lines = sp_lines(spark)
    ids = ["sp-1", "sp-7"]
    by_list = S.sp_savings(lines, "2025-06", ids)
    by_table = S.sp_savings(lines, "2025-06", ids_frame(spark, ids))
    many = S.sp_savings(lines, "2025-06", [*ids, *(f"none-{i}" for i in range(60))])
    assert sorted(by_list.collect()) == sorted(by_table.collect()) == sorted(many.collect())
    assert by_list.count() > 0


def test_totals_agree(spark):
    details = S.sp_savings(sp_lines(spark), "2025-06")
    summary = S.account_summary(details)
    total = S.with_grand_total(details, S.SP_KEYS, S.SP_MEASURES).where("is_total = 1").first()
    for m in S.SP_MEASURES:
        by_hand = sum(r[m] for r in details.collect())
        assert total[m] == by_hand == sum(r[m] for r in summary.collect())
        assert S.sp_totals(details).first()[m] == by_hand
    assert S.overall_totals(details, S.SP_MEASURES).first()["n_rows"] == details.count()


def test_total_of_nothing_is_one_zero_row(spark):
    details = S.ri_savings(ri_lines(spark, []))
    report = S.ri_report(details).collect()
    assert [tuple(r) for r in report] == [("", "", "$0.00", "$0.00", "$0.00")]


def test_split_and_order_do_not_matter(spark):
    lines = sp_lines(spark)
    whole = sorted(S.sp_savings(lines).collect())
    assert sorted(S.sp_savings(lines.repartition(13).orderBy(F.rand(3))).collect()) == whole
    parts = [S.sp_savings(lines.where(F.col("line_item_usage_amount").isNull()))]
    parts.append(S.sp_savings(lines.where(F.col("line_item_usage_amount").isNotNull())))
    assert sorted(S.merge_savings(parts, S.SP_KEYS).collect()) == whole


def test_every_period_at_once(spark):
    lines = sp_lines(spark)
    both = S.sp_savings(lines, by_period=True)
    for month in ("2025-06", "2025-07"):
        alone = S.sp_savings(lines, month)
        assert sorted(both.where(F.col("usage_period") == month).drop("usage_period").collect()) == sorted(alone.collect())


def test_report_order_total_last(spark):
    report = [tuple(r) for r in S.sp_report(S.sp_savings(sp_lines(spark))).collect()]
    keys = [(r[0], r[2], r[1], r[3]) for r in report[:-1]]
    assert keys == sorted(keys)
    assert report[-1][:4] == ("GRAND TOTAL", "", "", "")
    assert all(r[5].startswith("$") for r in report)


def test_account_detail(spark):
    details = S.sp_savings(sp_lines(spark))
    rows = S.account_plan_detail(details).collect()
    totals = {}
    for r in rows:
        key = (r.line_item_usage_account_id, r.bill_payer_account_id)
        totals[key] = totals.get(key, Decimal(0)) + r.savings
    assert len(rows) == details.count()
    for r in rows:
        assert r.account_savings == totals[(r.line_item_usage_account_id, r.bill_payer_account_id)]
    one = S.account_plan_detail(details, "000000000001", "payer2").collect()
    assert {(r.line_item_usage_account_id, r.bill_payer_account_id) for r in one} == {
        ("000000000001", "payer2")
    }


def test_cost_all_zero(spark):
    zero = ri_lines(spark, [("s", "arn", "a", 0.0, 1.0), ("s", "arn", "a", None, 1.0)])
    assert S.cost_all_zero(zero).first()["all_zero"]
    assert not S.cost_all_zero(ri_lines(spark, [("s", "arn", "a", 0.1, 1.0)])).first()["all_zero"]
