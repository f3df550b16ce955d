"""Id lists and resource inventories."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Ids, one per line, trimmed, blanks dropped; a missing or empty list is an error."""
    ids = read_optional_ids(spark, path)
    if ids is None:
        raise FileNotFoundError(f"There is no id list at {path}")
    if ids.isEmpty():
        raise ValueError(f"The id list at {path} names no id")
    return ids


def read_optional_ids(spark: SparkSession, path: str) -> DataFrame | None:
    """Distinct ids of a file; ``None`` (no filter) when it is missing.

    A list that exists but is empty gives an empty DataFrame, which lets nothing pass.
    """
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    # Any white space at either end, as carriage returns come with some files.
    trimmed = F.regexp_replace("value", r"^\s+|\s+$", "")
    return lines.select(trimmed.alias("id")).where(F.col("id") != "").distinct()


def read_inventory(
    spark: SparkSession, path: str, suffix: str = ".notag", whole_files: bool = True
) -> DataFrame:
    """Inventory documents of the files with a suffix: one per file, or one per line."""
    reader = spark.read.option("pathGlobFilter", f"*{suffix}")
    return reader.text(path, wholetext=whole_files)
