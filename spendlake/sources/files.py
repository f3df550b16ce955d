"""Listing files, and opening them from tasks."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Sequence
from urllib.parse import quote
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str | None = None,
    recursive: bool = False,
    times: bool = False,
) -> DataFrame:
    """``(path, length)`` of the files under paths or path patterns, without reading them.

    With ``times`` also ``modified``, in milliseconds since 1970. Raises ``FileNotFoundError`` when there are none.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    wanted = [paths] if isinstance(paths, str) else list(paths)
    try:
        modified = [F.unix_millis("modificationTime").alias("modified")] if times else []
        listing = reader.load(wanted).select("path", "length", *modified)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"No files match {wanted}") from e
        raise
    if listing.isEmpty():
        raise FileNotFoundError(f"No files match {wanted}" + (f" and {glob}" if glob else ""))
    return listing


def file_sizes(listing: DataFrame) -> DataFrame:
    """Files and bytes per directory of a listing."""
    return listing.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("directory")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes")
    )


def open_input(uri: str):
    """Seekable input of a file that Spark listed, on any store that Arrow knows."""
    store, path = file_store(uri)
    return store.open_input_file(path)


def open_stream(uri: str):
    """The bytes of a file from first to last, fetched in large pieces."""
    store, path = file_store(uri)
    return store.open_input_stream(path, compression=None, buffer_size=8 << 20)


def open_output(uri: str):
    """Output to a file, on any store that Arrow knows."""
    store, path = file_store(uri)
    return store.open_output_stream(path, compression=None)


def file_store(path: str):
    """The store that a path is in, and the path there."""
    from pyarrow import fs

    # A listed path is plain text and not an encoded URI: # and % are part of names.
    if path.startswith("file:"):
        path = local_path(path)
    if path.startswith("/"):
        return fs.LocalFileSystem(), path
    # Hadoop names the same object store s3a.
    return fs.FileSystem.from_uri(quote(path.replace("s3a://", "s3://", 1), safe=":/@+=&,"))


def folder_exists(path: str) -> bool:
    from pyarrow import fs

    store, plain = file_store(path)
    return store.get_file_info(plain).type == fs.FileType.Directory


def local_path(path: str) -> str:
    """A ``file:`` path without its scheme; any other path as it is."""
    return "/" + path.removeprefix("file:").lstrip("/") if path.startswith("file:") else path


def literal(path: str) -> str:
    """A path for a reader that would take some of its characters for a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", path)


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, computed once: written to a scratch table and read from it."""
    spark = rows.sparkSession
    target = scratch(spark, name)
    rows.write.parquet(target)
    return spark.read.schema(rows.schema).parquet(target)


_local: list[tempfile.TemporaryDirectory] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables, inside the shared folder the cluster names.

    Only a local session without such a folder gets a temporary one, gone when it ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local:
            _local.append(tempfile.TemporaryDirectory(prefix="spendlake-"))
        shared = _local[0].name
    return f"{shared.rstrip('/')}/{name}-{uuid4().hex}"
