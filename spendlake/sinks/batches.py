"""Batches that are appended to a table once, however often they are run."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from spendlake.sources.files import file_store, folder_exists, list_files
from spendlake.sources.listing import spread

LEDGER = "batch long, state string"
STAGED, PUBLISHED = "staged", "published"


class BatchLedger:
    """What a stream's batches have done to ``target``, kept in ``<checkpoint>/batches``.

    A batch is written to a folder of its own and noted as staged, then its files are moved to the
    target, then it is noted as published. Whatever stops it, the next run goes on from the last
    note: files of a batch that is not staged are written again from the start; of one that is staged
    those are moved that have not been; one that is published is not written at all. The target
    holds plain files and no list of the valid ones, so its periods can be replaced. (Call ``finish``
    before that: ``replace_period`` does when it is given the checkpoint.)

    Readers of the target see the files of a batch appear one by one, as with any append.
    """

    def __init__(self, spark: SparkSession, checkpoint: str, target: str):
        self.spark, self.target = spark, target.rstrip("/")
        self.folder = f"{checkpoint.rstrip('/')}/batches"

    def states(self) -> dict[int, set[str]]:
        """The notes about each batch."""
        if not folder_exists(f"{self.folder}/ledger"):
            return {}
        rows = self.spark.read.schema(LEDGER).parquet(f"{self.folder}/ledger").collect()
        found: dict[int, set[str]] = {}
        for r in rows:
            found.setdefault(r["batch"], set()).add(r["state"])
        return found

    def write(self, batch: DataFrame, number: int, partition_by: str | None) -> None:
        """Appends a batch, unless it was appended before."""
        done = self.states().get(number, set())
        if PUBLISHED in done:
            return
        if STAGED not in done:
            writer = batch.write.mode("overwrite")
            if partition_by is not None:
                writer = writer.partitionBy(partition_by)
            writer.parquet(self._stage(number))
            self._note(number, STAGED)
        self._publish(number)

    def finish(self) -> None:
        """Publishes what is staged; creates the target where there is none."""
        if folder_exists(f"{self.target}/_spark_metadata"):
            raise ValueError(
                f"{self.target} was written by a streaming file sink, whose list hides other files: "
                "remove its _spark_metadata first"
            )
        store, path = file_store(self.target)
        store.create_dir(path, recursive=True)
        for number, done in sorted(self.states().items()):
            if PUBLISHED not in done:
                self._publish(number)

    def _stage(self, number: int) -> str:
        return f"{self.folder}/stage/{number}"

    def _note(self, number: int, state: str) -> None:
        row = self.spark.createDataFrame([(number, state)], LEDGER).coalesce(1)
        row.write.mode("append").parquet(f"{self.folder}/ledger")

    def _publish(self, number: int) -> None:
        stage = self._stage(number)
        try:
            staged = list_files(self.spark, stage, "*.parquet", recursive=True).select("path")
        except FileNotFoundError:  # nothing to move, or all of it moved
            pass
        else:
            spread(staged).mapInArrow(_moved(stage, self.target), "path string").count()
        self._note(number, PUBLISHED)
        store, path = file_store(stage)
        if folder_exists(stage):
            store.delete_dir(path)


def _moved(stage: str, target: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, source = file_store(path)
                below = source[len(file_store(stage)[1].rstrip("/")) :]
                _, goal = file_store(target)
                goal = goal.rstrip("/") + below
                store.create_dir(goal.rsplit("/", 1)[0], recursive=True)
                try:
                    store.move(source, goal)
                except FileNotFoundError:  # a lost task had moved it
                    if store.get_file_info(goal).type.name != "File":
                        raise
            yield batch

    return run
