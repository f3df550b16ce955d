"""Gzipped CSV exports to typed Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spendlake.operators.typed import to_typed
from spendlake.sinks.tables import write_typed
from spendlake.sources.exports import read_exports
from spendlake.sources.files import list_files


def run(
    spark: SparkSession,
    paths: str | list[str],
    target: str,
    maps_as: str = "text",
    glob: str = "*.csv.gz",
    mode: str = "errorifexists",
    rebalance: bool = False,
) -> DataFrame:
    """Converts all good files at once; returns the files that were left out.

    A gzip file is read by one task. With ``rebalance`` its rows are spread after reading, so
    that one large file neither types nor writes all its rows in that task: they are staged in
    pieces that many tasks read, and not shuffled.
    """
    exports = read_exports(spark, list_files(spark, paths, glob), spread_rows=rebalance)
    write_typed(to_typed(exports.lines, maps_as), target, mode)
    return exports.rejected
