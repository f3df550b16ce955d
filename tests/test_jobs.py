"""Results of whole jobs, even samples, NULLs counted by footers."""

import warnings

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spendlake.operators import savings as S
from spendlake.plans import profiling
from spendlake.plans import savings as jobs
from spendlake.sources.tables import sample_by_hash

RI = (
    "`lineItem/LineItemType` string, `reservation/SubscriptionId` string, `reservation/ReservationARN` string, "
    "`lineItem/UsageAccountId` string, `pricing/PublicOnDemandCost` string, `reservation/EffectiveCost` string, "
    "`lineItem/UsageStartDate` string"
)
NONE = "path string, length long, problem string"


def ri_lines(spark, *costs):
    rows = [("DiscountedUsage", "9", "arn", str(i % 2), c, "1", "2025-06-01T00:00:00Z") for i, c in enumerate(costs)]
    return spark.createDataFrame([*rows, ("Usage", None, None, "7", "0", "1", "2024-01-01T00:00:00Z")], RI)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_zero_costs_are_a_warning(spark):
    nothing = spark.createDataFrame([], NONE)
    with pytest.warns(UserWarning, match="pricing_public_on_demand_cost is zero in all 4 lines"):
        result = jobs.ri_from_lines(ri_lines(spark, "0", "0.0", None), nothing, "2025-06")
    assert result.on_demand_all_zero and result.n_lines == 4
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        # What is not zero lies outside the month: the check is before any filter.
        lines = ri_lines(spark, "0", "0").unionByName(ri_lines(spark, "5").replace("2025-06-01T00:00:00Z", "2025-07-01"))
        result = jobs.ri_from_lines(lines, nothing, "2025-06")
    assert not result.on_demand_all_zero and float(result.on_demand_total) == 5.0 and result.n_lines == 5
    assert {r.line_item_usage_account_id: (r.n_details, float(r.effective_cost)) for r in result.accounts.collect()} == {
        "0": (1, 1.0), "1": (1, 1.0),
    }
    assert result.plans is None and result.totals.first().n_rows == 2


def test_zero_check_knows_all_spellings(spark):
    row = S.cost_all_zero(ri_lines(spark, "2", "3")).first()
    assert (row.checked_column, float(row.total), row.all_zero) == ("pricing_public_on_demand_cost", 5.0, False)
    with pytest.raises(ValueError, match="Missing required columns: PublicOnDemandCost"):
        S.cost_all_zero(spark.range(1))


def test_even_sample_is_the_same_however_rows_lie(spark):
    rows = spark.range(5000).select("id", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).alias("t"),
                                    F.create_map(F.lit("k"), "id").alias("m"))
    found = [
        sorted(r.id for r in sample_by_hash(x, 700).collect())
        for x in (rows.coalesce(1), rows.repartition(13), rows.orderBy(F.desc("id")))
    ]
    assert found[0] == found[1] == found[2] and len(set(found[0])) == 700
    assert abs(sum(found[0]) / 700 - 2500) < 250  # not the first ones
    assert set(r.id for r in sample_by_hash(rows, 100).collect()) < set(found[0])
    assert sorted(r.id for r in sample_by_hash(rows, 700, seed="b").collect()) != found[0]
    assert "TakeOrderedAndProject" in plan(sample_by_hash(rows, 700))
    assert sample_by_hash(rows, 9000).count() == 5000
    same = spark.createDataFrame([("a", None), ("a", "")] * 3, "x string, y string")
    assert sample_by_hash(same, 6).count() == 6 and sample_by_hash(same.where("false"), 5).count() == 0


def nulls(found):
    return {r.column: (r.nulls, r.n_rows) for r in found.collect()}


def test_footers_count_nulls_without_data(spark, tmp_path):
    rows = spark.range(100).select(
        "id", F.when(F.col("id") % 4 == 0, "x").alias("a.b"), F.lit(None).cast("double").alias("none")
    )
    rows.repartition(3).write.parquet(f"{tmp_path}/t")
    rows.select("id").write.mode("append").parquet(f"{tmp_path}/t")  # lacks two columns
    found = profiling.null_counts(spark, f"{tmp_path}/t")
    assert nulls(found) == {"id": (0, 200), "a.b": (175, 200), "none": (200, 200)}
    assert f"{tmp_path}/t" not in plan(found)
    assert {r.column: r.null_percent for r in found.collect()}["a.b"] == 87.5


def test_data_is_read_only_where_footers_are_silent(spark, tmp_path):
    table = pa.table({"id": [1, None, 3], "s": ["a", None, None], "f": [float("nan"), None, 1.0]})
    for k in (1, 2):
        (tmp_path / "t" / f"k={k}").mkdir(parents=True)
        pq.write_table(table, tmp_path / "t" / f"k={k}" / "with.parquet")
    pq.write_table(table.drop(["s"]), tmp_path / "t" / "k=1" / "without.parquet", write_statistics=False)
    found = profiling.null_counts(spark, f"{tmp_path}/t")
    assert nulls(found) == {"id": (3, 9), "s": (7, 9), "f": (3, 9), "k": (0, 9)}
    scans = plan(found)
    assert "without.parquet" in scans and "with.parquet" not in scans
    rows = [(1, {"a": 1}, [1], None), (2, None, None, (None,)), (3, {}, [None], (1,))]
    nested = spark.createDataFrame(rows, "i int, m map<string,int>, l array<int>, s struct<i: int>")
    nested.write.parquet(f"{tmp_path}/n")
    assert nulls(profiling.null_counts(spark, f"{tmp_path}/n")) == {"i": (0, 3), "m": (1, 3), "l": (1, 3), "s": (1, 3)}


def test_profile_of_an_even_sample(spark, tmp_path):
    spark.range(500).write.parquet(f"{tmp_path}/t")
    assert profiling.run(spark, f"{tmp_path}/t", 40, even=True).shape.first().n_rows == 40
