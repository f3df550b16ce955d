"""Storage and quality profile of Parquet files."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators import profile
from spendlake.sources.files import list_files, literal, stored
from spendlake.sources.footers import read_footers
from spendlake.sources.tables import sample_by_hash, sample_rows


@dataclass(frozen=True)
class Profile:
    files: DataFrame
    storage: DataFrame
    storage_totals: DataFrame
    storage_report: DataFrame
    columns: DataFrame
    shape: DataFrame
    value_bytes: DataFrame
    types: DataFrame
    nulls: DataFrame
    report: DataFrame


def null_counts(spark: SparkSession, path: str) -> DataFrame:
    """``column``, ``nulls``, ``n_rows``, ``null_percent`` of a table, from footers where they say.

    Data is read only for what footers do not count: lists, maps, structs and partition keys, and
    files that a writer left without statistics; nothing is if there are none. NaN is a value here.
    """
    footers = stored(read_footers(spark, path), "footers")
    known = stored(profile.footer_nulls(footers), "nulls")
    table = spark.read.option("mergeSchema", True).parquet(path)
    plain = {r["column"] for r in known.select("column").collect()}  # a line for each column
    counts = known.where(F.col("column").isin([c for c in table.columns if c in plain]))
    silent = [literal(r["path"]) for r in profile.files_without_counts(footers).collect()]
    if silent:
        read = spark.read.schema(table.schema).option("recursiveFileLookup", True).parquet(*silent)
        counts = counts.unionByName(_counted(read, [c for c in table.columns if c in plain]))
    summed = counts.groupBy("column").agg(F.sum("nulls").alias("nulls"), F.sum("n_rows").alias("n_rows"))
    rest = [c for c in table.columns if c not in plain]
    if rest:
        summed = summed.unionByName(_counted(table, rest))
    return summed.withColumn("null_percent", profile.percent(F.col("nulls"), F.col("n_rows")))


def _counted(table: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs of the columns in one pass."""
    missing = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(columns)]
    counted = table.agg(F.count(F.lit(1)).alias("n_rows"), *missing)
    return counted.select(F.explode(F.array(*rows)).alias("c"), "n_rows").select("c.column", "c.nulls", "n_rows")


def run(
    spark: SparkSession, path: str, sample: int | None = None, even: bool = False
) -> Profile:
    """All parts. ``sample`` limits the data part (not footers) to that many rows: to the first
    ones, or with ``even`` to an even sample of all.

    Data and footers are read once; every part is made of their stored, small results.
    """
    footers = stored(read_footers(spark, path), "footers")
    table = spark.read.parquet(path)
    if sample is not None:
        table = sample_by_hash(table, sample) if even else sample_rows(table, sample)
    columns = stored(profile.column_profile(table), "profile")
    return Profile(
        list_files(spark, path, "*.parquet", recursive=True),
        profile.storage_profile(footers),
        profile.storage_totals(footers),
        profile.storage_report(footers),
        columns,
        columns.agg(F.max("n_rows").alias("n_rows"), F.count("column").alias("n_columns")),
        profile.by_size(columns),
        profile.by_type(columns),
        profile.top_nulls(columns),
        profile.profile_report(columns),
    )
