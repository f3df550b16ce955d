"""What lies in many folders, listed by tasks."""

from __future__ import annotations

from collections.abc import Iterator
from fnmatch import translate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.sources.files import file_store

ENTRY = "entry struct<name: string, path: string, is_folder: boolean, length: bigint, modified: bigint>"
FOLDERS_PER_TASK = 32

# Fixed value: the directory name that stands for a key without value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def spread(rows: DataFrame, per_task: int = FOLDERS_PER_TASK) -> DataFrame:
    """Few bytes that stand for much work, dealt to many tasks (which no plan merges again)."""
    return rows.repartition(max(1, min(10_000, -(-rows.count() // per_task))))


def list_folders(folders: DataFrame, column: str = "path", recursive: bool = False, counter=None) -> DataFrame:
    """The entries of each row's folder: the row's other columns and ENTRY.

    Folders are asked for by the tasks that hold their rows, one request each. One that does not
    exist gives a single entry without a name, and so does one whose path is a file; an empty one
    gives an entry with an empty name. ``recursive`` lists files at any depth and no folders.
    ``counter``, an accumulator, counts the requests.
    """
    kept = [f for f in folders.schema.fields if f.name != column]
    fields = [*(f"`{f.name}` {f.dataType.simpleString()}" for f in kept), ENTRY]
    return folders.select(f"`{column}`", *(f"`{f.name}`" for f in kept)).mapInArrow(
        _listed(recursive, counter), ", ".join(fields)
    )


def _listed(recursive: bool, counter):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            at, names, paths, folder, lengths, times = [], [], [], [], [], []
            for i, root in enumerate(batch.column(0).to_pylist()):
                if counter is not None:
                    counter.add(1)
                found = _entries(fs, root, recursive)
                at += [i] * len(found)
                for name, path, is_folder, length, modified in found:
                    names.append(name)
                    paths.append(path)
                    folder.append(is_folder)
                    lengths.append(length)
                    times.append(modified)
            entry = pa.StructArray.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array(paths, pa.string()),
                    pa.array(folder, pa.bool_()),
                    pa.array(lengths, pa.int64()),
                    pa.array(times, pa.int64()),
                ],
                ["name", "path", "is_folder", "length", "modified"],
            )
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(c.take(rows) for c in batch.columns[1:]), entry], [*batch.schema.names[1:], "entry"]
            )

    return run


def _entries(fs, root: str, recursive: bool) -> list[tuple]:
    store, plain = file_store(root)
    try:
        if store.get_file_info(plain).type != fs.FileType.Directory:
            raise FileNotFoundError(root)
        found = store.get_file_info(fs.FileSelector(plain, recursive=recursive))
    except FileNotFoundError:
        return [(None, root, None, None, None)]
    base, cut = root.rstrip("/"), len(plain.rstrip("/"))
    rows = [
        (
            f.path[cut + 1 :],
            base + f.path[cut:],
            f.type == fs.FileType.Directory,
            f.size,
            None if f.mtime_ns is None else f.mtime_ns // 1_000_000,
        )
        for f in found
        if not (recursive and f.type == fs.FileType.Directory)
    ]
    return sorted(rows) or [("", root, None, None, None)]


def first_files(folders: DataFrame, suffix: str, column: str = "path") -> DataFrame:
    """``path`` of one file with the suffix below each folder that has one; stops there in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            found = []
            for root in batch.column(0).to_pylist():
                left = [root]
                while left:
                    entries = [e for e in _entries(fs, left.pop(), False) if e[0]]
                    here = next((path for name, path, is_folder, *_ in entries if not is_folder and name.endswith(suffix)), None)
                    if here is not None:
                        found.append(here)
                        break
                    left += [path for _, path, is_folder, *_ in entries if is_folder]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["path"])

    return folders.select(f"`{column}`").mapInArrow(run, "path string")


def found_files(entries: DataFrame, glob: str) -> DataFrame:
    """Entries of a recursive listing that are files of that name, none of them hidden."""
    name = F.element_at(F.split("entry.name", "/"), -1)
    hidden = F.col("entry.name").rlike(r"(^|/)(\.|_(?![^/]*=))")
    return entries.where((F.col("entry.name") != "") & name.rlike(f"^{translate(glob)}") & ~hidden)


def shown(entries: DataFrame) -> DataFrame:
    """Entries that are there, without what starts with a dot or, unless it is a key, an underscore."""
    last = F.element_at(F.split("entry.name", "/"), -1)
    key = last.contains("=") | (last == NO_VALUE)
    return entries.where(
        (F.col("entry.name") != "") & ~last.startswith(".") & (~last.startswith("_") | key)
    )
