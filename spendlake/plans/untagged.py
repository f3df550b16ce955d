"""Untagged resources: inventory files to a text report and an alert flag."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from spendlake.operators.inventory import (
    REGION_LABELS,
    flatten_resources,
    should_alert,
    untagged_resources,
)
from spendlake.sinks.reports import write_text_report
from spendlake.sources.files import stored
from spendlake.sources.lists import read_inventory


def run(
    spark: SparkSession,
    inventory: str,
    report: str,
    aliases: DataFrame,
    regions: Sequence[tuple[str, str]] | DataFrame = REGION_LABELS,
    suffix: str = ".notag",
    **filters,
) -> DataFrame:
    """Writes the report; returns one row that says whether it is worth sending.

    ``filters`` are those of ``untagged_resources``.
    """
    resources = flatten_resources(read_inventory(spark, inventory, suffix))
    untagged = stored(untagged_resources(resources, regions, aliases, **filters), "untagged")
    write_text_report(untagged, report)
    return should_alert(untagged)
