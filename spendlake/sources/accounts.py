"""The account registry, and collecting the exports of all its accounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.sources.exports import Exports, read_exports
from spendlake.sources.files import stored
from spendlake.sources.listing import found_files, list_folders, spread

# Registry columns that may be loaded. Its two key columns never are.
REGISTRY_COLUMNS = (
    "created_at", "update_at", "id", "aws_id", "name", "bucket", "monthly_dir", "daily_dir",
    "hourly_dir", "region_name",
)

GRANULARITIES = ("monthly", "daily", "hourly")


def read_registry(
    spark: SparkSession, path: str | None = None, jdbc: dict[str, str] | None = None
) -> DataFrame:
    """The registry from a Parquet copy or over JDBC (options ``url``, ``dbtable``, ...)."""
    if (path is None) == (jdbc is None):
        raise ValueError("give either a path or JDBC options")
    table = spark.read.parquet(path) if path else spark.read.format("jdbc").options(**jdbc).load()
    return without_keys(table)


def without_keys(registry: DataFrame) -> DataFrame:
    """Known registry columns only, so that credentials are not even scanned."""
    return registry.select(*(c for c in REGISTRY_COLUMNS if c in registry.columns))


def account_folders(registry: DataFrame, granularity: str = "monthly", scheme: str = "s3a://") -> DataFrame:
    """``source_account_id`` and ``folder`` of each account; a bare bucket name gets the ``scheme``.

    An account without a bucket or directory has no folder.
    """
    if granularity not in GRANULARITIES:
        raise ValueError(f"granularity must be one of {GRANULARITIES}, got {granularity!r}")
    bucket = F.when(F.col("bucket").rlike("[/:]"), F.col("bucket")).otherwise(F.concat(F.lit(scheme), "bucket"))
    below = F.regexp_replace(f"{granularity}_dir", "^/+|/+$", "")
    return registry.select(
        F.col("aws_id").alias("source_account_id"),
        F.concat_ws("/", F.regexp_replace(bucket, "/+$", ""), below).alias("folder"),
        (F.col("bucket").isNull() | F.col(f"{granularity}_dir").isNull()).alias("none"),
    ).select("source_account_id", F.when(~F.col("none"), F.col("folder")).alias("folder"))


def account_listing(
    registry: DataFrame, granularity: str = "monthly", glob: str = "*.csv.gz", scheme: str = "s3a://"
) -> DataFrame:
    """``source_account_id``, ``folder``, ``path``, ``length``, ``modified`` of all accounts' files.

    Folders are rows: tasks list them, some dozens each, so neither the driver nor a plan holds one
    for an account. A folder that does not exist, and an account without one, is a row without
    ``path``. A file below the folders of several accounts belongs to the longest one.
    """
    folders = account_folders(registry, granularity, scheme).distinct()
    shared = (
        folders.where("folder IS NOT NULL")
        .groupBy("folder")
        .agg(F.count("*").alias("n"), F.min("source_account_id").alias("a"), F.max("source_account_id").alias("b"))
        .where("n > 1")
        .first()
    )
    if shared is not None:
        raise ValueError(f"{shared['folder']} belongs to accounts {shared['a']} and {shared['b']}")
    given = folders.where("folder IS NOT NULL").withColumn("__folder", F.col("folder"))
    entries = stored(list_folders(spread(given), "__folder", recursive=True), "accounts")
    found = (
        found_files(entries, glob)
        .select("source_account_id", "folder", "entry.path", "entry.length", "entry.modified")
        .groupBy("path")
        .agg(F.max_by(F.struct("source_account_id", "folder", "length", "modified"), F.length("folder")).alias("f"))
        .select("f.source_account_id", "f.folder", "path", "f.length", "f.modified")
    )
    nothing = [F.lit(None).cast(k).alias(c) for c, k in (("path", "string"), ("length", "long"), ("modified", "long"))]
    missing = entries.where("entry.name IS NULL").select("source_account_id", "folder", *nothing)
    none = folders.where("folder IS NULL").select("source_account_id", "folder", *nothing)
    return found.unionByName(missing).unionByName(none)


def collect_accounts(
    spark: SparkSession,
    registry: DataFrame,
    granularity: str = "monthly",
    wanted: Sequence[str] | None = None,
    optional: Sequence[str] = (),
    verify: bool = True,
    glob: str = "*.csv.gz",
    scheme: str = "s3a://",
    store: str | None = None,
) -> Exports:
    """Exports of all registered accounts as one table with ``source_account_id``.

    See ``account_listing`` and ``read_exports``. The directory of an account that does not exist is
    listed in ``rejected``, and so is an account without one; one that two accounts share is an error.
    """
    if registry.isEmpty():
        raise ValueError("The account registry is empty")
    listing = stored(account_listing(registry, granularity, glob, scheme), "listing")
    files = listing.where("path IS NOT NULL")
    if files.isEmpty():
        raise FileNotFoundError(f"No files match {glob} in the directories of any account")
    tags = None
    if not verify:  # a read by Spark knows files by their path only
        rows = files.select("folder", "source_account_id").distinct().collect()
        tags = {r["folder"]: r["source_account_id"] for r in rows}
    exports = read_exports(
        spark, files.drop("folder"), wanted, optional, verify, tags, "source_account_id", store
    )
    given = F.col("folder").isNotNull()
    missing = listing.where("path IS NULL").select(
        F.coalesce("folder", F.concat(F.lit("account "), "source_account_id")).alias("path"),
        F.lit(0).cast("long").alias("length"),
        F.when(given, "no such directory").otherwise("no directory in the registry").alias("problem"),
    )
    return Exports(exports.lines, exports.rejected.unionByName(missing), exports.files)
