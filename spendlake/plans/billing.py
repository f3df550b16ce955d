"""Billing ETL: the billable lines of one usage month replace that month in the target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from spendlake.functions import times
from spendlake.operators.lines import billable_lines, near_billing_period
from spendlake.sinks.tables import replace_period
from spendlake.sources.schema import cur_schema
from spendlake.sources.tables import read_table
from spendlake.streaming.ingest import ingest_incremental


def run(
    spark: SparkSession,
    source: str | DataFrame,
    target: str,
    period: str | None = None,
    keep_types: Sequence[str] = (),
    slack_months: int | None = None,
    column: str = "usage_period",
    rebalance: bool = False,
    checkpoint: str | None = None,
) -> int:
    """Returns the number of rows written; the month defaults to the current one (UTC).

    ``slack_months`` prunes the source to billing months around the usage month. ``checkpoint`` is
    that of an incremental job with the same target; run that job to its end before this one, as
    lines that it has not seen yet would come in again with it.
    """
    period = period or times.current_period()
    lines = source if isinstance(source, DataFrame) else read_table(spark, source)
    if slack_months is not None:
        lines = near_billing_period(lines, period, slack_months)
    rows = billable_lines(lines, period, keep_types, column)
    return replace_period(rows, target, period, column, rebalance, checkpoint)


def run_incremental(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    keep_types: Sequence[str] = (),
    column: str = "usage_period",
    base_path: str | None = None,
    positional: Sequence[str] | None = None,
    predicates: Sequence[str] = (),
) -> None:
    """The same filter over the files that are new since the last run, all months.

    ``positional`` and ``predicates``: see ``read_table`` and ``ingest_incremental``.
    """
    ingest_incremental(
        spark,
        source,
        target,
        checkpoint,
        cur_schema(partitions=True),
        lambda lines: billable_lines(lines, None, keep_types, column),
        column,
        base_path=base_path,
        positional=positional,
        predicates=predicates,
    )
