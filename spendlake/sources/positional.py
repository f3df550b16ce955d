"""Tables whose partition keys are directory names by position: ``root/1234/report/data/2025-06``."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.sources.files import literal, stored
from spendlake.sources.listing import NO_VALUE, list_folders, shown, spread
from spendlake.sources.schema import PARTITION_KEYS

FOLDER = "__folder"
STORE = r"^[^:/]+:(//[^/]*)?"  # what a path has before its first directory


def _decoded(text: Column) -> Column:
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def _value(name: Column) -> Column:
    """The key that a directory stands for: ``2025-06`` and ``BILLING_PERIOD=2025-06`` alike."""
    text = _decoded(F.regexp_replace(name, "^[^=]*=", ""))
    return F.when(text != NO_VALUE, text)


def position_keys(root: str, keys: Sequence[str]) -> list[Column]:
    """The keys of a row by the directories that its file lies in, below ``root``."""
    plain = F.regexp_replace(_decoded(F.col("_metadata.file_path")), STORE, "")
    below = F.substring(plain, len(re.sub(STORE, "", root).rstrip("/")) + 2, 1 << 30)
    names = F.split(below, "/")
    return [_value(F.get(names, F.lit(i))).alias(key) for i, key in enumerate(keys)]


def _known(rows: DataFrame, predicates: list[str]) -> tuple[DataFrame, list[str]]:
    """Applies those predicates whose columns are there, and returns the others."""
    left = []
    for predicate in predicates:
        try:
            kept = rows.where(predicate)
            kept.schema  # noqa: B018  (resolves it)
        except AnalysisException as e:
            if not (e.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
                raise
            left.append(predicate)
        else:
            rows = kept
    return rows, left


def partition_folders(
    spark: SparkSession,
    root: str,
    keys: Sequence[str] = PARTITION_KEYS,
    predicates: Sequence[str] = (),
    excluded_parts: Sequence[str] = (),
    counter=None,
) -> DataFrame:
    """FOLDER and keys of the folders at the depth of the last key.

    Levels are listed one after the other, by tasks. Each of ``predicates`` is SQL over keys and is
    applied at the first level that knows its keys, so that what it rules out is never listed:
    give conditions that are joined by AND one by one. Parquet files above the last level belong
    to no partition and are an error. ``counter`` counts the folders that are asked for.
    """
    left = list(predicates)
    level = spark.createDataFrame([(root.rstrip("/"),)], f"{FOLDER} string")
    path, is_folder = F.col("entry.path"), F.col("entry.is_folder")
    for i, key in enumerate(keys):
        listed = shown(list_folders(spread(level) if i else level, FOLDER, counter=counter))
        for part in excluded_parts:
            listed = listed.where(~F.contains(F.concat(path, F.lit("/")), F.lit(part)))
        found = stored(listed, "folders")
        beside = found.where(~is_folder & path.endswith(".parquet")).select(path.alias("p")).limit(5).collect()
        if beside:
            raise ValueError(f"Parquet files beside the partitions of {root}: {[r.p for r in beside]}")
        known = (F.col(f"`{k}`") for k in keys[:i])
        level = found.where(is_folder).select(
            path.alias(FOLDER), *known, _value(F.col("entry.name")).alias(key)
        )
        level, left = _known(level, left)
    if left:
        raise ValueError(f"predicates name other columns than the keys {tuple(keys)}: {left}")
    return level


def without_keys(schema: T.StructType, keys: Sequence[str]) -> T.StructType:
    return T.StructType([f for f in schema.fields if f.name not in keys])


def read_positional(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    keys: Sequence[str] = PARTITION_KEYS,
    predicates: Sequence[str] = (),
    excluded_parts: Sequence[str] = (),
) -> DataFrame:
    """Rows of the partitions that meet all predicates, keys last; see ``partition_folders``.

    Only their folders are read. Keys come from the path of a row's file, so there is no join, and
    the driver holds a line for each folder that is read, as for any partitioned table.
    """
    folders = partition_folders(spark, root, keys, predicates, excluded_parts)
    paths = [literal(r[FOLDER]) for r in folders.select(FOLDER).collect()]
    data = without_keys(schema, keys)
    if not paths:
        none = T.StructType([*data.fields, *(T.StructField(k, T.StringType()) for k in keys)])
        return spark.createDataFrame([], none)
    reader = spark.read.schema(data).option("pathGlobFilter", "*.parquet")
    rows = reader.option("recursiveFileLookup", True).parquet(*paths)
    return rows.select("*", *position_keys(root, keys))


def folder_pattern(folders: DataFrame, root: str, depth: int) -> str | None:
    """A path pattern over all the folders: at each level the names that occur there.

    It may match more than the folders, where not all names go together. None without folders.
    """
    below = F.substring(FOLDER, len(root.rstrip("/")) + 2, 1 << 30)
    names = F.split(below, "/")
    levels = folders.agg(*(F.sort_array(F.collect_set(F.get(names, F.lit(i)))) for i in range(depth)))
    found = levels.first()
    if not found[0]:
        return None
    escaped = [[literal(n).replace(",", "\\,") for n in level] for level in found]
    return "/".join([literal(root.rstrip("/")), *("{" + ",".join(level) + "}" for level in escaped)])


def declare_partitions(spark: SparkSession, name: str, folders: DataFrame, keys: Sequence[str]) -> None:
    """Adds folders of any name to a declared table, under the keys that they stand for."""
    quoted = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    specs = [
        "PARTITION ("
        + ", ".join(f"`{k}` = {'NULL' if r[k] is None else quoted(r[k])}" for k in keys)
        + f") LOCATION {quoted(r[FOLDER])}"
        for r in folders.collect()
    ]
    for i in range(0, len(specs), 500):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs[i : i + 500])}")
