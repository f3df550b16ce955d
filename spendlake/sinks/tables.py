"""Partitioned Parquet: append, replace one period."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from spendlake.sinks.batches import BatchLedger


def append_periods(
    lines: DataFrame,
    target: str,
    column: str = "usage_period",
    rebalance: bool = False,
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Appends, one directory per period.

    Without ``rebalance`` there is no shuffle, and every task writes a file for each period
    it meets. With it, rows are first brought together by period, and a large period is
    split into several files of even size at run time.

    ``shape`` gives the rows their columns, row by row and the period as it is. Rows are brought
    together and put in order of their periods before it, so that what it adds is neither moved
    nor sorted.
    """
    if rebalance:
        lines = lines.hint("rebalance", column)
    if shape is not None:
        lines = shape(lines.sortWithinPartitions(column))
    lines.write.mode("append").partitionBy(column).parquet(target)


def replace_period(
    lines: DataFrame,
    target: str,
    period: str,
    column: str = "usage_period",
    rebalance: bool = False,
    checkpoint: str | None = None,
) -> int:
    """Replaces one period of ``target`` by ``lines``; returns how many rows were seen.

    (A task that ran twice is counted twice, so the number is exact unless one did. Zero is
    always zero.)

    The new files are complete before the old ones go (dynamic overwrite), so a failed run
    leaves the period as it was. When nothing was written, which dynamic overwrite would
    take for nothing to do, the period is emptied. ``rebalance`` adds a shuffle that evens
    out file sizes, for sources that scatter a period over many files.

    A target that is also ingested into needs the ``checkpoint`` of that job: a batch that was
    stopped half-way is finished first, as its rows would otherwise arrive after the replacement.
    """
    if checkpoint is not None:
        BatchLedger(lines.sparkSession, checkpoint, target).finish()
    rows = lines.where(F.col(column) == period)
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    if rebalance:
        counted = counted.hint("rebalance")
    counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        column
    ).parquet(target)
    written = seen.get["n"]
    if written == 0:
        empty = rows.drop(column).limit(0)
        empty.write.mode("overwrite").parquet(f"{target.rstrip('/')}/{column}={period}")
    return written


def write_typed(rows: DataFrame, target: str, mode: str = "errorifexists") -> None:
    """Parquet, snappy, with statistics (both are what Spark writes by default)."""
    rows.write.mode(mode).option("compression", "snappy").parquet(target)
