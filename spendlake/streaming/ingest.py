"""Rows of new files only: a file stream that stops when it has caught up."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.sinks.batches import BatchLedger
from spendlake.sources.positional import (
    folder_pattern,
    partition_folders,
    position_keys,
    without_keys,
)
from spendlake.sources.tables import EXCLUDED_PARTS, without_excluded

# The source would otherwise pass over files a week older than the newest one it has seen.
ANY_AGE = "36500d"


def ingest_incremental(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame] = lambda lines: lines,
    partition_by: str | None = "usage_period",
    files_per_batch: int | None = None,
    base_path: str | None = None,
    excluded_parts: Sequence[str] = EXCLUDED_PARTS,
    positional: Sequence[str] | None = None,
    predicates: Sequence[str] = (),
) -> None:
    """Appends what is new in ``source`` since the last run to ``target``.

    Progress lives in ``checkpoint`` (on shared storage). Each batch is written once, by a ledger
    beside the progress: see ``BatchLedger``. So a lost executor, or a run that is repeated, adds no
    row twice, and ``target`` is a plain table that other jobs may read, append to and replace
    periods of. ``transform`` has to be stateless, as the billing ETL is. For a partitioned source
    ``base_path`` is its root when ``source`` is a pattern for its partition directories. Files count
    as new whatever their modification time; paths with ``excluded_parts`` hold no line items, as
    in batch reads.

    With ``positional`` the directories below ``source`` are keys by position, added to the rows.
    Each run lists them anew, pruned by ``predicates``; what the predicates rule out now is new to
    a later run without them.
    """
    ledger = BatchLedger(spark, checkpoint, target)
    ledger.finish()
    reader = spark.readStream.option("pathGlobFilter", "*.parquet").option("maxFileAge", ANY_AGE)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    if positional is None:
        rows = reader.schema(schema).parquet(source)
    else:
        folders = partition_folders(spark, source, positional, predicates, excluded_parts)
        pattern = folder_pattern(folders, source, len(positional))
        if pattern is None:
            return
        rows = reader.schema(without_keys(schema, positional)).parquet(pattern)
        rows = rows.select("*", *position_keys(source, positional), "_metadata")
    rows = without_excluded(rows, excluded_parts)
    for predicate in predicates:
        rows = rows.where(predicate)
    if positional is not None:
        rows = rows.drop("_metadata")
    query = (
        transform(rows)
        .writeStream.foreachBatch(lambda batch, number: ledger.write(batch, number, partition_by))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
