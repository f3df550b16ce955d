"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from spendlake.registry import QUERIES  # noqa: E402

HEADLINE = (
    "etl_billable_by_type",
    "etl_billable_all_periods",
    "etl_replace_period",
    "incremental_ingest",
    "ri_savings",
    "ri_savings_by_period",
    "ri_savings_by_id_table",
    "ri_report",
    "sp_savings_by_period",
    "sp_report",
    "sp_account_plan_detail",
    "csv_typed_roundtrip",
    "csv_multi_layout",
    "account_collection",
    "map_normalise",
    "storage_profile",
    "value_bytes_share",
    "null_profile_top10",
    "untagged_resources",
)


def plan_facts(frame) -> dict:
    """Shuffles and broadcasts as planned, and the filters that reach the scans."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    pushed = {f for f in re.findall(r"PushedFilters: \[([^]]*)\]", plan) if f}
    return {
        "shuffles": len(re.findall(r"(?<!Broadcast)(?<!Reused)Exchange ", plan)),
        "broadcasts": plan.count("BroadcastExchange "),
        "pushed": sorted(pushed),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold, warm, plans = {}, {}, {}
    for name in names:
        for times in (cold, warm):
            start = time.perf_counter()
            frame = QUERIES[name](spark, sf_dir)
            frame.write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
        plans[name] = plan_facts(frame)
    version = spark.version
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of warm headline query times",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "plans": plans,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "spark": version,
            }
        )
    )


if __name__ == "__main__":
    main()
