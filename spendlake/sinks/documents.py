"""Texts as files, one each."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from spendlake.sources.files import file_store


def write_documents(documents: DataFrame, target: str, suffix: str = ".txt") -> int:
    """One file per row of a text column ``value``, ended by a line break; returns how many files.

    Tasks write the files where they stay: nothing is moved file by file when the job ends. A file
    is named after its task's partition and its place there, so a task that runs again writes the
    same files again.
    """
    store, folder = file_store(target)
    store.create_dir(folder, recursive=True)  # there even if no row is

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, folder = file_store(target)
        store.create_dir(folder, recursive=True)
        part, n = TaskContext.get().partitionId(), 0
        for batch in batches:
            for value in batch.column(0):
                with store.open_output_stream(f"{folder}/part-{part:06d}-{n:09d}{suffix}", compression=None) as out:
                    out.write((value.as_py() or "").encode() + b"\n")
                n += 1
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    return documents.select("value").mapInArrow(write, "n long").agg({"n": "sum"}).first()[0] or 0
