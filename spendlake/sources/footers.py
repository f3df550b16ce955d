"""Parquet footers: stored sizes without reading data."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from spendlake.sources.files import list_files, open_input

CHUNKS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("row_group", T.IntegerType()),
        T.StructField("ordinal", T.IntegerType()),
        T.StructField("column", T.StringType()),
        T.StructField("physical_type", T.StringType()),
        T.StructField("compressed", T.LongType()),
        T.StructField("uncompressed", T.LongType()),
        T.StructField("num_values", T.LongType()),
        T.StructField("num_rows", T.LongType()),
        T.StructField("flat", T.BooleanType()),
        T.StructField("null_count", T.LongType()),
    ]
)


FILES_PER_TASK = 64  # beyond what a few partitions per core would hold


def read_footers(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str = "*.parquet",
    recursive: bool = True,
) -> DataFrame:
    """One row per file, row group and column chunk.

    ``null_count`` is NULL where the writer left no statistics, or none of NULLs.

    A listing has as many partitions as the files have bytes for, but a footer costs the
    same for any file, so partitions are merged (without a shuffle) to a few per core, or
    to some dozens of files each where there are more: executors may come later.
    """
    listing = list_files(spark, paths, glob, recursive).select("path")
    partitions = max(8 * spark.sparkContext.defaultParallelism, listing.count() // FILES_PER_TASK)
    return listing.coalesce(partitions).mapInPandas(_chunks, CHUNKS)


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import pyarrow.parquet as pq

    for batch in batches:
        for path in batch["path"]:
            with open_input(path) as source:
                footer = pq.ParquetFile(source).metadata
            columns = [footer.schema.column(c) for c in range(footer.num_columns)]
            # A column of its own: not a part of a list, map or struct.
            flat = [c.path == c.name and c.max_repetition_level == 0 for c in columns]
            for g in range(footer.num_row_groups):
                group = footer.row_group(g)
                chunks = [group.column(c) for c in range(group.num_columns)]
                yield pd.DataFrame(
                    {
                        "path": path,
                        "row_group": g,
                        "ordinal": range(len(chunks)),
                        "column": [c.path_in_schema for c in chunks],
                        "physical_type": [c.physical_type for c in chunks],
                        "compressed": [c.total_compressed_size for c in chunks],
                        "uncompressed": [c.total_uncompressed_size for c in chunks],
                        "num_values": [c.num_values for c in chunks],
                        "num_rows": group.num_rows,
                        "flat": flat,
                        "null_count": pd.array([_null_count(c) for c in chunks], dtype="Int64"),
                    }
                )


def _null_count(chunk) -> int | None:
    found = chunk.statistics if chunk.is_stats_set else None
    return found.null_count if found is not None and found.has_null_count else None
