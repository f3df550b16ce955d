"""Reports as files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.operators.inventory import REPORT_HEADER, report_line


def write_csv_report(report: DataFrame, target: str) -> None:
    """Ordered CSV with a header.

    Parts are in report order: an ordered DataFrame is range partitioned, and a small
    report ends up in one part by itself. No part is forced on a large one.
    """
    report.write.mode("overwrite").option("header", True).option("emptyValue", "").csv(target)


def text_report(untagged: DataFrame) -> DataFrame:
    """Header line and one line per resource, sorted, as one text column."""
    spark = untagged.sparkSession
    head = spark.range(1).select(F.lit(0).alias("part"), F.lit(REPORT_HEADER).alias("value"))
    body = untagged.select(F.lit(1).alias("part"), report_line().alias("value"))
    return head.unionByName(body).orderBy("part", "value").select("value")


def write_text_report(untagged: DataFrame, target: str) -> None:
    """Replaces the text report of untagged resources."""
    text_report(untagged).write.mode("overwrite").text(target)
