"""Gzipped CSV exports: headers that differ from file to file, files that are broken.

A file is opened once: its rows are staged while they are checked, each file by its own header,
and those of a broken file are left out as a whole. What was staged can be kept, so that a later
run opens new and changed files only.
"""

from __future__ import annotations

import csv
import gzip
import hashlib
import io
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from uuid import uuid4

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions import times
from spendlake.operators.columns import missing_columns, missing_message, spelling
from spendlake.operators.typed import TIME_COLUMNS, present_text
from spendlake.sources.files import folder_exists, list_files, literal, local_path, open_stream, scratch
from spendlake.sources.listing import spread

HEADERS = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("length", T.LongType()),
        T.StructField("header", T.ArrayType(T.StringType())),
        T.StructField("problem", T.StringType()),
    ]
)

# A list of directories up to this size may be sent to every task.
BROADCAST_BYTES = 32 * 1024 * 1024


@dataclass(frozen=True)
class Exports:
    """``lines`` of the good files, and ``rejected`` files as ``(path, length, problem)``.

    ``files`` has what is known of each file that was read to its end: FILES.
    """

    lines: DataFrame
    rejected: DataFrame
    files: DataFrame | None = None


def find_exports(
    spark: SparkSession, root: str, prefix: str = "", glob: str = "*.csv.gz"
) -> DataFrame:
    """Export files in the directories under ``root`` whose name starts with ``prefix``."""
    return list_files(spark, f"{root.rstrip('/')}/{prefix}*/{glob}", times=True)


def scan_headers(listing: DataFrame) -> DataFrame:
    """Header of every listed file, from its first lines alone."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_first_row(path) for path in batch["path"]]
            yield batch.assign(header=[f[0] for f in found], problem=[f[1] for f in found])

    return listing.select("path", "length").mapInPandas(scan, HEADERS)


def _first_row(path: str) -> tuple[list[str] | None, str | None]:
    try:
        with open_stream(path) as raw:
            header = next((row for row in _rows(_unzipped(raw, path), csv.QUOTE_MINIMAL) if row), None)
            return header, None if header else "no header"
    except Exception as e:  # whatever is wrong with one file must not stop the others
        return None, f"{type(e).__name__}: {e}"


def _unzipped(raw, path: str):
    return gzip.GzipFile(fileobj=raw) if path.endswith(".gz") else raw


class _Counted(io.RawIOBase):
    """Bytes of a file as they are read, and how many there were: a position costs a call for each row."""

    def __init__(self, data):
        self.data, self.n = data, 0

    def readable(self) -> bool:
        return True

    def readinto(self, buffer) -> int:
        n = self.data.readinto(buffer)
        self.n += n
        return n


def _rows(data, quoting: int) -> csv.reader:
    text = io.TextIOWrapper(io.BufferedReader(data, 1 << 20), encoding="utf-8-sig", newline="")
    csv.field_size_limit(1 << 30)
    return csv.reader(text, strict=True, quoting=quoting)


# An empty cell is NULL and a quoted empty one is empty text, where Python tells them apart.
EMPTY_IS_NULL = getattr(csv, "QUOTE_NOTNULL", csv.QUOTE_MINIMAL)

STAGED_ROWS = 20_000  # rows of a batch, fewer when they come from more bytes than
STAGED_BYTES = 8_000_000

SPREAD_BYTES = 8 << 20  # of a row group that one task reads alone

FILES = (
    "path string, length long, modified long, header array<string>, problem string, "
    "n_rows long, n_short long"
)


class _Layout:
    """Where the columns that are staged stand in one file's rows."""

    def __init__(self, header: list[str], wanted: Sequence[str] | None, optional: Sequence[str]):
        self.width = len(header)
        self.key = hashlib.sha256(json.dumps(header).encode()).hexdigest()
        self.places: list[int | None] | None = None
        self.problem = None
        if wanted is not None:
            missing = missing_columns(header, wanted)
            self.problem = missing_message(missing) if missing else None
            position = {name: i for i, name in reversed(list(enumerate(header)))}
            found = [spelling(header, c) for c in (*wanted, *optional)]
            self.places = [None if f is None else position[f] for f in found]

    def columns(self, rows: list[list[str | None]]) -> list[pa.Array]:
        if self.places is None:
            return [pa.array(rows, pa.list_(pa.string()))]
        none = [None] * len(rows)
        cells = list(zip(*rows, strict=True))
        return [pa.array(none if p is None else cells[p], pa.string()) for p in self.places]


def _staged(carried: list[str], wanted: Sequence[str] | None, optional: Sequence[str]):
    """Reads each file of a batch once; see ``scan_exports``."""
    names = ["cells"] if wanted is None else [*wanted, *optional]
    kinds = [pa.list_(pa.string())] if wanted is None else [pa.string()] * len(names)
    state = pa.struct(
        [("header", pa.list_(pa.string())), ("problem", pa.string()), ("n_rows", pa.int64()), ("n_short", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield from staged_file(batch.slice(i, 1))

    def out(file: pa.RecordBatch, n: int, layout, found: dict | None, columns) -> pa.RecordBatch:
        repeat = pa.repeat(pa.scalar(0, pa.int64()), n)
        return pa.RecordBatch.from_arrays(
            [
                *(c.take(repeat) for c in file.columns),
                pa.repeat(pa.scalar(layout, pa.string()), n),
                pa.nulls(n, state) if found is None else pa.array([found] * n, state),
                *columns,
            ],
            [*(f"__{c}" for c in carried), "__layout", "__state", *names],
        )

    def staged_file(file: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        header, problem, n_rows, n_short, path = None, None, 0, 0, file.column(0)[0].as_py()
        try:
            with open_stream(path) as raw:
                data = _Counted(_unzipped(raw, path))
                rows = _rows(data, EMPTY_IS_NULL)
                first = next((row for row in rows if row), None)
                if first is None:
                    problem = "no header"
                else:
                    header = ["" if c is None else c for c in first]
                    layout = _Layout(header, wanted, optional)
                    problem = layout.problem
                    held, begun = [], data.n
                    for row in rows if problem is None else ():
                        if not row:
                            continue
                        if len(row) != layout.width:
                            if len(row) > layout.width:
                                problem = f"row {rows.line_num} has more cells than the header"
                                break
                            n_short += 1
                            row += [None] * (layout.width - len(row))
                        held.append(row)
                        n_rows += 1
                        if len(held) >= STAGED_ROWS or data.n - begun >= STAGED_BYTES:
                            yield out(file, len(held), layout.key, None, layout.columns(held))
                            held, begun = [], data.n
                    if held and problem is None:
                        yield out(file, len(held), layout.key, None, layout.columns(held))
        except Exception as e:  # whatever is wrong with one file must not stop the others
            problem = f"{type(e).__name__}: {e}"
        found = {"header": header, "problem": problem, "n_rows": n_rows, "n_short": n_short}
        yield out(file, 1, None, found, [pa.nulls(1, k) for k in kinds])

    return run


def scan_exports(
    listing: DataFrame, wanted: Sequence[str] | None = None, optional: Sequence[str] = ()
) -> DataFrame:
    """Rows of all listed files, read once, and behind the rows of each file what became of it.

    Rows have the columns of the listing (their names after two underscores), ``__layout`` (a hash
    of the file's header) and the wanted columns, or without these ``cells``. The last row of a file
    has a ``__state`` and nothing else: header, problem, n_rows, n_short (rows with fewer cells than
    the header, whose other cells are NULL). A gzip that is cut short, text that is not UTF-8, a
    quote left open, a row with more cells than the header and a missing wanted column are problems,
    found while the rows pass; those that passed before are still here and not to be used.
    """
    carried = ["path", *(c for c in listing.columns if c != "path")]
    kinds = {f.name: f.dataType.simpleString() for f in listing.schema.fields}
    cells = ["cells array<string>"] if wanted is None else [f"`{c}` string" for c in (*wanted, *optional)]
    fields = [
        *(f"`__{c}` {kinds[c]}" for c in carried),
        "__layout string",
        "__state struct<header: array<string>, problem: string, n_rows: bigint, n_short: bigint>",
        *cells,
    ]
    return listing.select(*carried).mapInArrow(_staged(carried, wanted, optional), ", ".join(fields))


def read_exports(
    spark: SparkSession,
    listing: DataFrame,
    wanted: Sequence[str] | None = None,
    optional: Sequence[str] = (),
    verify: bool = True,
    tags: dict[str, str] | None = None,
    tag_name: str = "source_account_id",
    store: str | None = None,
    spread_rows: bool = False,
) -> Exports:
    """Rows of all good files, as text.

    ``wanted`` selects logical columns under their canonical names (a file that lacks one is
    rejected, ``optional`` ones become NULL); without it all columns keep the names of their
    header and a column that a file lacks is NULL. ``tags`` maps directory prefixes to a
    value for the column ``tag_name``; a listing with a column of that name has the tags itself.

    Files are staged in one pass (``scan_exports``) in a folder: a scratch one, or ``store``. A
    ``store`` keeps them: files that it holds with the same path, length and time are not opened
    again, good or not, and of files that changed or are no longer listed nothing is used.

    ``spread_rows`` stages in row groups of SPREAD_BYTES, so that the rows of one large file are read
    by many tasks, and none is moved for it.

    ``verify=False`` reads headers alone and leaves the rest to Spark's reader, as fits when only a
    few columns of files that are known to be whole are needed: a broken file then fails the read.
    The driver sees one line per file only then; otherwise one per header layout.
    """
    if not verify:
        if store is not None:
            raise ValueError("a store keeps verified files")
        return _read_by_layout(spark, listing, wanted, optional, tags, tag_name)
    names = [c for c in ("path", "length", "modified", tag_name) if c in listing.columns]
    listed = listing.select(*names)
    folder = scratch(spark, "exports") if store is None else _store_of(store, wanted, optional)
    known = _ExportStore(spark, folder, listed.schema, wanted, optional, spread_rows)
    known.stage(listed, fresh=store is None)
    files = known.files(listed)
    counted = files.agg(
        F.count_if(F.col("problem").isNull()).alias("good"),
        F.min_by("problem", "path").alias("first"),
        F.collect_set(F.when(F.col("problem").isNull(), F.col("run"))).alias("runs"),
    ).first()
    if not counted["good"]:
        raise ValueError(f"Every file was rejected, the first one for: {counted['first']}")
    lines = known.lines(files, sorted(counted["runs"]))
    if wanted is None:
        layouts = files.where("problem IS NULL").select("header").distinct().collect()
        columns = _columns_of_cells([tuple(r["header"]) for r in layouts])
    else:
        columns = [F.col(f"`{c}`") for c in (*wanted, *optional)]
    if tags is not None:
        columns.append(F.regexp_replace("__path", "/[^/]*$", "").alias("__folder"))
    if tag_name in names:
        columns.append(F.col(f"`__{tag_name}`").alias(tag_name))
    lines = lines.select(*columns)
    if tags is not None:
        folders = files.select(F.regexp_replace("path", "/[^/]*$", "").alias("f")).distinct().collect()
        lines = _tagged(spark, lines, [f"{r['f']}/" for r in folders], tags, tag_name)
    rejected = files.where("problem IS NOT NULL").select("path", "length", "problem")
    return Exports(lines, rejected, files.select(*(f.split()[0] for f in FILES.split(", "))))


def _store_of(store: str, wanted: Sequence[str] | None, optional: Sequence[str]) -> str:
    """Files are staged for the columns that are wanted of them."""
    columns = json.dumps([wanted if wanted is None else list(wanted), list(optional)])
    return f"{store.rstrip('/')}/{hashlib.sha256(columns.encode()).hexdigest()[:16]}"


class _ExportStore:
    """Staged files: rows in ``rows/<run>``, and a manifest of the files of all finished runs.

    The manifest gets a run's files when all its rows are written, so a run that fails is as if it
    had not been.
    """

    def __init__(self, spark, folder, listed: T.StructType, wanted, optional, spread_rows: bool = False):
        self.spark, self.folder, self.wanted, self.optional = spark, folder, wanted, optional
        self.options = {"parquet.block.size": str(SPREAD_BYTES)} if spread_rows else {}
        self.tags = [f for f in listed.fields if f.name not in ("path", "length", "modified")]
        fields = T.StructType.fromDDL(f"run string, {FILES}").fields
        self.schema = T.StructType([*fields, *self.tags])

    def manifest(self) -> DataFrame:
        path = f"{self.folder}/manifest"
        if not folder_exists(path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(path)

    def stage(self, listed: DataFrame, fresh: bool) -> None:
        """Reads the listed files that the manifest does not have."""
        if not fresh:
            if "modified" not in listed.columns:
                raise ValueError("a store needs a listing with the files' times")
            same = ["path", "length", "modified"]
            listed = listed.join(self.manifest().select(*same), same, "left_anti")
        run = uuid4().hex
        rows = f"{self.folder}/rows/{run}"
        if listed.isEmpty():
            return
        spread_out = spread(listed, per_task=1)
        scan_exports(spread_out, self.wanted, self.optional).write.options(**self.options).parquet(rows)
        found = self.spark.read.parquet(rows).where("__state IS NOT NULL")
        columns = [
            F.lit(run).alias("run"),
            *(
                F.col(f"`__{c}`").alias(c) if f"__{c}" in found.columns else F.lit(None).cast(k).alias(c)
                for c, k in (("path", "string"), ("length", "long"), ("modified", "long"))
            ),
            "__state.*",
            *(F.col(f"`__{f.name}`").alias(f.name) for f in self.tags),
        ]
        found.select(*columns).write.mode("append").parquet(f"{self.folder}/manifest")

    def files(self, listed: DataFrame) -> DataFrame:
        """The manifest's lines of the listed files, as these are now."""
        manifest = self.manifest()
        if "modified" not in listed.columns:
            return manifest
        return manifest.join(listed.select("path", "length", "modified"), ["path", "length", "modified"], "left_semi")

    def lines(self, files: DataFrame, runs: Sequence[str]) -> DataFrame:
        """Staged rows of good files. Only if a run has others, too, are rows told apart by file."""
        paths = [f"{self.folder}/rows/{r}" for r in runs]
        rows = self.spark.read.parquet(*paths).where("__state IS NULL")
        good = files.where("problem IS NULL").select("run", "path")
        others = (
            self.manifest()
            .where(F.col("run").isin(list(runs)) & (F.col("n_rows") > 0))
            .select("run", "path")
            .join(good, ["run", "path"], "left_anti")
        )
        if others.isEmpty():
            return rows
        run = F.element_at(F.split("_metadata.file_path", "/"), -2)
        marked = rows.withColumn("__run", run)
        others = others.select(F.col("run").alias("__run"), F.col("path").alias("__path"))
        return marked.join(others, ["__run", "__path"], "left_anti")


def _columns_of_cells(layouts: list[tuple[str, ...]]) -> list[Column]:
    """All columns of all layouts, each taken from where a row's layout has it."""
    places: dict[str, dict[int, list[str]]] = {}
    spelled: dict[str, str] = {}
    for header in sorted(layouts):
        key = hashlib.sha256(json.dumps(header).encode()).hexdigest()
        for i, name in enumerate(_unique(header)):
            # Columns of several layouts are one without regard to case, as Spark resolves names.
            name = spelled.setdefault(name.lower(), name)
            places.setdefault(name, {}).setdefault(i, []).append(key)
    columns = []
    for name, by_place in places.items():
        cell = F.lit(None).cast("string")
        if len(by_place) == 1 and len(next(iter(by_place.values()))) == len(layouts):
            cell = F.get("cells", F.lit(next(iter(by_place))))
        else:
            for i, keys in by_place.items():
                cell = F.when(F.col("__layout").isin(keys), F.get("cells", F.lit(i))).otherwise(cell)
        columns.append(cell.alias(name))
    return columns


def _read_by_layout(
    spark: SparkSession,
    listing: DataFrame,
    wanted: Sequence[str] | None,
    optional: Sequence[str],
    tags: dict[str, str] | None,
    tag_name: str,
) -> Exports:
    """Spark applies one schema by position to all CSV files of a read: one read per header."""
    rejected, layouts = _layouts(scan_headers(listing), wanted)
    if not layouts:
        raise ValueError(f"Every file was rejected, the first one for: {rejected[0][2]}")

    # Position names while reading: headers may repeat a name or differ in case only.
    parts = []
    for header, paths in sorted(layouts.items()):
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
        rows = (
            spark.read.schema(schema)
            .option("header", True)
            .option("multiLine", True)
            .option("quote", '"')
            .option("escape", '"')
            .csv([literal(p) for p in paths])
        )
        columns = _layout_columns(header, wanted, optional)
        if tags is not None:
            columns.append(_folder().alias("__folder"))
        parts.append(rows.select(*columns))
    lines = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if tags is not None:
        paths = [p for ps in layouts.values() for p in ps]
        lines = _tagged(spark, lines, paths, tags, tag_name)
    return Exports(lines, spark.createDataFrame(rejected, "path string, length long, problem string"))


def _layouts(
    scanned: DataFrame, wanted: Sequence[str] | None
) -> tuple[list[tuple[str, int, str]], dict[tuple[str, ...], list[str]]]:
    """Rejected files, and the paths of the others by their header."""
    rejected, layouts = [], {}
    for path, length, header, problem in scanned.collect():
        if problem is None and wanted is not None:
            missing = missing_columns(header, wanted)
            problem = missing_message(missing) if missing else None
        if problem is None:
            layouts.setdefault(tuple(header), []).append(path)
        else:
            rejected.append((path, length, problem))
    return rejected, layouts


def _layout_columns(
    header: Sequence[str], wanted: Sequence[str] | None, optional: Sequence[str]
) -> list[Column]:
    position = {name: i for i, name in reversed(list(enumerate(header)))}
    if wanted is None:
        names = _unique(header)
        return [F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
    columns = []
    for logical in (*wanted, *optional):
        found = spelling(header, logical)
        cell = F.lit(None).cast("string") if found is None else F.col(f"c{position[found]}")
        columns.append(cell.alias(logical))
    return columns


def _unique(header: Sequence[str]) -> list[str]:
    """Names that differ even without case: a repeated one gets ``.1``, ``.2`` and so on."""
    seen: set[str] = set()
    names = []
    for name in header:
        unique, n = name, 0
        while unique.lower() in seen:
            n += 1
            unique = f"{name}.{n}"
        seen.add(unique.lower())
        names.append(unique)
    return names


def _without_store(path: str) -> str:
    """``/dir`` of ``hdfs://host/dir``."""
    return "/" + path.split("://", 1)[1].partition("/")[2] if "://" in path else path


def _folder() -> Column:
    """Directory of a row's file, as listings spell it (the metadata has it encoded)."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return F.regexp_replace(F.url_decode(encoded), "/[^/]*$", "")


def _parents(folder: str) -> list[str]:
    """The folder and all that it lies in."""
    parts = folder.split("/")
    return ["/".join(parts[:n]) for n in range(len(parts), 0, -1)]


def _tagged(
    spark: SparkSession, lines: DataFrame, paths: Sequence[str], tags: dict[str, str], name: str
) -> DataFrame:
    """Adds the tag of the longest prefix that each directory starts with."""
    by_prefix = {local_path(prefix.rstrip("/")): tag for prefix, tag in tags.items()}
    folders = {p.rsplit("/", 1)[0] for p in paths}
    rows = []
    for folder in sorted(folders):
        # A prefix may leave out the file system that the listing names.
        spellings = (folder, local_path(folder), _without_store(folder))
        found = [p for s in spellings for p in _parents(s) if p in by_prefix]
        if not found:
            raise ValueError(f"{folder} is in none of the given directories")
        rows.append((folder, by_prefix[max(found, key=len)]))
    table = spark.createDataFrame(rows, f"__folder string, {name} string")
    if sum(len(folder) + 64 for folder, _ in rows) <= BROADCAST_BYTES:
        table = F.broadcast(table)
    return lines.join(table, "__folder", "left").drop("__folder")


def typed_lines(lines: DataFrame) -> DataFrame:
    """Canonical columns read as text, ready for the savings operators.

    Times become timestamps; amounts stay text, from which sums take exact decimals.
    """
    return lines.select(
        *(
            times.utc_clock(F.expr(present_text(c)), T.StringType()).alias(c)
            if c in TIME_COLUMNS
            else F.expr(present_text(c)).alias(c)
            for c in lines.columns
        )
    )
