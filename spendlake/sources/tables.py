"""The billing table, by name or by path."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.sources.listing import first_files, list_folders, shown, spread
from spendlake.sources.positional import declare_partitions, partition_folders, read_positional
from spendlake.sources.schema import PARTITION_ALIASES, PARTITION_KEYS, cur_schema

CRAWLED_KEYS = dict(zip(PARTITION_ALIASES, PARTITION_KEYS))

# Parts of a path that hold no line items.
EXCLUDED_PARTS = ("/cost_and_usage_data_status/", "/aws-programmatic-access-test-object")


def read_table(
    spark: SparkSession,
    source: str,
    schema: T.StructType | None = None,
    predicate: str | Sequence[str] | None = None,
    excluded_parts: Sequence[str] = EXCLUDED_PARTS,
    renamed: Mapping[str, str] | None = None,
    positional: Sequence[str] | None = None,
) -> DataFrame:
    """Line items of a catalogue table (a name) or of Parquet files (a path).

    Only Parquet files are read, whatever else lies between them. Parquet files that lie beside
    partition directories, in none of them, are an error: they would not be read. ``predicate`` on
    partition keys prunes directories. ``renamed`` gives columns their usual names, for instance
    ``CRAWLED_KEYS`` when a crawler named the partition keys.

    ``positional`` names keys, for instance ``PARTITION_KEYS``, whose values are the directories
    below the path in that order. Give ``predicate`` then as a list of conditions over keys: each
    prunes the listing from the first level on that knows its keys.
    """
    if positional is not None:
        if renamed:
            raise ValueError("positional keys have the names that are given")
        predicates = [predicate] if isinstance(predicate, str) else list(predicate or ())
        declared = schema or cur_schema(partitions=False)
        return read_positional(spark, source, declared, positional, predicates, excluded_parts)
    if predicate is not None and not isinstance(predicate, str):
        predicate = " AND ".join(f"({p})" for p in predicate) or None
    if "/" not in source:
        rows = spark.table(source)
    else:
        rows = _read_files(spark, source, schema or cur_schema(partitions=True), excluded_parts)
        rows = without_excluded(rows, excluded_parts)
    if renamed:
        rows = rows.withColumnsRenamed(dict(renamed))
    return rows.where(predicate) if predicate else rows


def without_excluded(rows: DataFrame, excluded_parts: Sequence[str]) -> DataFrame:
    """Rows of files whose path has none of the parts."""
    for part in excluded_parts:
        rows = rows.where(~F.col("_metadata.file_path").contains(part))
    return rows


def _beside_partitions(spark: SparkSession, root: str, excluded: Sequence[str]) -> list[str]:
    """Parquet files directly under ``root`` or in what lies there and is no partition directory."""
    top = list_folders(spark.createDataFrame([(root.rstrip("/"),)], "path string"))
    path, name, is_folder = (F.col(f"entry.{c}") for c in ("path", "name", "is_folder"))
    there = shown(top).where(~(is_folder & name.contains("=")))
    for part in excluded:
        there = there.where(~F.contains(F.concat(path, F.lit("/")), F.lit(part)))
    entries = there.select("entry.path", "entry.is_folder").collect()  # what lies at the top
    files = [r["path"] for r in entries if not r["is_folder"] and r["path"].endswith(".parquet")]
    folders = [(r["path"],) for r in entries if r["is_folder"]]
    if folders and not files:
        found = first_files(spread(spark.createDataFrame(folders, "path string")), ".parquet")
        files = [r["path"] for r in found.limit(5).collect()]
    return files


def _read_files(
    spark: SparkSession, root: str, schema: T.StructType, excluded: Sequence[str]
) -> DataFrame:
    def reader() -> DataFrameReader:
        return spark.read.schema(schema).option("pathGlobFilter", "*.parquet")

    if "*" not in root:
        # Partition directories only: others beside them would make the layout ambiguous.
        try:
            rows = reader().option("basePath", root).parquet(f"{root.rstrip('/')}/*=*")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
        else:
            if beside := _beside_partitions(spark, root, excluded):
                raise ValueError(f"Parquet files beside the partitions of {root}: {beside[:5]}")
            return rows
    return reader().parquet(root)


def create_table(
    spark: SparkSession,
    name: str,
    location: str,
    schema: T.StructType | None = None,
    keys: Sequence[str] = PARTITION_KEYS,
    positional: bool = False,
) -> None:
    """Declares an external Parquet table over files that exist, with their partitions.

    With ``positional`` the keys are directories by position, whatever their names.
    """
    schema = schema or cur_schema(partitions=True)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    root, location = location, location.replace("\\", "\\\\").replace("'", "\\'")
    by = ", ".join(f"`{k}`" for k in keys)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY ({by}) LOCATION '{location}'"
    )
    if positional:
        folders = partition_folders(spark, root, keys, excluded_parts=EXCLUDED_PARTS)
        declare_partitions(spark, name, folders, keys)
    else:
        spark.catalog.recoverPartitions(name)


def sample_rows(rows: DataFrame, n: int, order_by: Sequence[str] = ()) -> DataFrame:
    """First ``n`` rows: of the given order, or any when there is none."""
    return (rows.orderBy(*order_by) if order_by else rows).limit(n)


def sample_by_hash(
    rows: DataFrame, n: int, columns: Sequence[str] | None = None, seed: str = ""
) -> DataFrame:
    """The ``n`` rows with the lowest hash of their ``columns`` (all): an even sample.

    The same rows whatever files and partitions they come in, and of a smaller ``n`` a part of those
    of a larger one. Each partition keeps its ``n`` lowest rows and no more, so there is no sort of
    the table; ``n`` rows of each partition reach the last task. Rows that are equal in ``columns``
    share a hash: of several such, any may be taken where not all are.
    """
    texts = [F.col(f"`{c}`").cast("string") for c in (columns or rows.columns)]
    whole = F.concat_ws("\x1f", F.lit(seed), *(F.coalesce(t, F.lit("\x00")) for t in texts))
    return (
        rows.withColumn("__hash", F.md5(whole)).withColumn("__text", whole)
        .orderBy("__hash", "__text")
        .limit(n)
        .drop("__hash", "__text")
    )
