"""What the operators share: words, scratch tables, connected components, registration."""

from __future__ import annotations

import re
import tempfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

BLANK = "[\\x20\\x09-\\x0D]"
NO_BLANK = "[^\\x20\\x09-\\x0D]"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its name; ``sql`` states the same result."""

    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text in order: runs of anything but space, tab and line ends; NULL has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"{BLANK}+"), "")


_local: list[tempfile.TemporaryDirectory] = []


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder inside the shared folder that the cluster names."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local:
            _local.append(tempfile.TemporaryDirectory(prefix="corpus-"))
        shared = _local[0].name
    return f"{shared.rstrip('/')}/{name}-{uuid4().hex}"


def stored(rows: DataFrame, name: str) -> DataFrame:
    """The rows, computed once: written to a scratch table, which cuts the lineage."""
    target = scratch(rows.sparkSession, name)
    rows.write.parquet(target)
    return rows.sparkSession.read.schema(rows.schema).parquet(target)


@contextmanager
def lean(spark: SparkSession, batch: int = 10_000) -> Iterator[None]:
    """Jobs within send ``batch`` rows at once to Python, and their shuffles' files go with them.

    For rows that are large; what is built within and run later is not concerned.
    """
    held = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(batch),
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    before = {k: spark.conf.get(k, None) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def dropped(rows: DataFrame) -> None:
    """Removes a scratch table made by ``stored`` that no later step reads."""
    spark = rows.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in rows.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


HUBS = 1_000  # a hub has more than this part of all links, so there are at most twice as many


def _with_lowest(links: DataFrame, lowest: DataFrame, edges: int) -> DataFrame:
    """``links`` (u, ...) next to m of their u in ``lowest`` (u, m, n: how many links u has).

    Links of hubs, which would all go to one task, find their m in a broadcast table; the number of
    hubs is bounded by what makes one. The other links are joined.
    """
    most = edges // HUBS
    hubs = lowest.where(F.col("n") > most).select("u", F.col("m").alias("of_hub"))
    marked = links.join(F.broadcast(hubs), "u", "left")
    of_hubs = marked.where("of_hub IS NOT NULL").withColumnRenamed("of_hub", "m")
    others = marked.where("of_hub IS NULL").drop("of_hub")
    return of_hubs.unionByName(others.join(lowest.where(F.col("n") <= most).select("u", "m"), "u"))


def components(edges: DataFrame) -> DataFrame:
    """Smallest reachable id of every id that occurs in ``edges`` (a, b: long).

    Large-star and small-star steps in turn, each an aggregate and a join; see ``_with_lowest`` for
    an id with very many neighbours. The rounds grow with the logarithm of the longest path. Returns
    id, component_id; ids without an edge to another one are not in it.
    """
    here = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v")
        .distinct(),
        "edges",
    )
    state, size = None, here.count()
    while True:
        both = here.unionByName(here.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("v").alias("n"))
        # Larger neighbours of u move to the smallest of u and its neighbours.
        larger = here.select(F.col("v").alias("u"), F.col("u").alias("w"))
        large = stored(
            _with_lowest(larger, least, size)
            .select(F.col("w").alias("u"), F.least("m", "u").alias("v"))
            .where("u <> v")
            .distinct(),
            "edges",
        )
        # Smaller neighbours of u, and u, move to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("v").alias("n"))
        rest = _with_lowest(large, low, size).select(F.col("v").alias("u"), F.col("m").alias("v"))
        then = stored(
            low.select("u", F.col("m").alias("v")).unionByName(rest).where("u <> v").distinct(),
            "edges",
        )
        found = then.agg(
            F.count("*").alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
        dropped(here)
        dropped(large)
        here, size = then, found["n"]
        if (found["n"], found["h"]) == state:
            break
        state = (found["n"], found["h"])
    return here.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(
        here.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    )
