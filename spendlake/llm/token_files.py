"""Token ids as Parquet list columns: ordered, encoded by dictionary or delta, paged for search."""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from spendlake.llm.chunks import Lists, TextCoder, slices_of
from spendlake.llm.common import query, scratch, table

VOCABULARY = "byte_bpe_50k.json"
END_ID = 2
FEW_PARTS = 1_000_000  # parts whose offsets may be broadcast

# Row groups of 32 MB and pages of at most 64 KB or 500 documents: a search by doc_id reads the
# column index and then a page. Ids are a dictionary of the vocabulary; ascending numbers are deltas.
FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "PARQUET_2_0",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(64 << 10),
    "parquet.page.row.count.limit": "500",
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",
    "parquet.enable.dictionary#first": "false",
    "parquet.enable.dictionary#n_tokens": "false",
}

AT_ONCE = 2_000  # parts that are given to the library as one text
BATCH = 16_000_000  # characters of texts whose parts are looked up together


class LibraryCoder(TextCoder):
    """Ids by the tokenizers library."""

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # What has its only space in front begins where a token has the space.
        self.begins = np.zeros(max(self.tokenizer.get_vocab(True).values()) + 1, bool)
        self.begins[[i for t, i in self.tokenizer.get_vocab(False).items() if t.startswith("\u0120")]] = True

    def each(self, texts: list[str]) -> list[Lists]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = [np.array(e.ids, np.uint32) for e in found]
        return [(np.concatenate([np.empty(0, np.uint32), *ids]), np.array([len(x) for x in ids], np.int64))]

    def spaced(self, parts: pa.Array, words: bool) -> list[Lists]:
        """Many parts are one text for the library, which cuts it before each space."""
        n = len(parts)
        cuts = pa.array([*range(0, n, AT_ONCE), n], pa.int32())
        blocks = [" " + x for x in pc.binary_join(pa.ListArray.from_arrays(cuts, parts), " ").to_pylist()]
        ids, sizes = [np.empty(0, np.uint32)], [np.empty(0, np.int64)]
        found = self.tokenizer.encode_batch_fast(blocks if n else [], add_special_tokens=False)
        for i, e in enumerate(found):
            part = parts.slice(i * AT_ONCE, AT_ONCE)
            x = np.array(e.ids, np.uint32)
            at = np.flatnonzero(self.begins[x])
            if len(at) == len(part):
                ids.append(x)
                sizes.append(np.diff(np.append(at, len(x))))
            else:  # a tokenizer that cuts otherwise, or a special token
                ((x, k),) = self.each([" " + p for p in part.to_pylist()])
                ids.append(x)
                sizes.append(k)
        return [(np.concatenate(ids), np.concatenate(sizes))]


_coders: dict[str, LibraryCoder] = {}


def coder(path: str) -> LibraryCoder:
    """One for each Python worker, with the words that earlier tasks have taught it."""
    if path not in _coders:
        _coders[path] = LibraryCoder(path)
    return _coders[path]


def _encode(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, first = TaskContext.get().partitionId(), 0
        for batch in batches:
            for i, j in slices_of(batch.column(1), BATCH):
                rows = batch.slice(i, j - i)
                ((ids, sizes),) = coder(path).texts(rows.column(1))
                ids = np.insert(ids, np.cumsum(sizes), np.uint32(end_id))
                starts = np.concatenate([[0], np.cumsum(sizes + 1)])
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column(0).cast(pa.int64()),
                        pa.array(np.full(j - i, part, np.int32)),
                        pa.array(first + starts[:-1]),
                        pa.array(sizes + 1),
                        pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids.view(np.int32))),
                    ],
                    ["doc_id", "part", "first", "n_tokens", "token_ids"],
                )
                first += int(starts[-1])

    return run


def write_tokens(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> None:
    """Writes doc_id, part, first, n_tokens and token_ids of every document, by ascending doc_id.

    The texts are shuffled by ranges of doc_id (NULL first, repeated ids by text) and encoded in
    that order while they are written, so there is one shuffle and a lost task is just run again.
    ``first`` counts the ids before a document in its part; the parts are in order of doc_id.
    """
    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(
            _encode(public_tokenizers.path(vocabulary), end_id),
            "doc_id long, part int, first long, n_tokens long, token_ids array<int>",
        )
        .write.options(**FORMAT)
        .parquet(folder)
    )


def _located(spark: SparkSession, folder: str, *more) -> DataFrame:
    files = spark.read.parquet(folder)
    parts = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    if parts.count() <= FEW_PARTS:  # 16 MB at most; beyond, the planner decides
        offsets = F.broadcast(offsets)
    start = (F.col("before") + F.col("first")).alias("start")
    return files.join(offsets, "part").select("doc_id", start, *more)


def token_offsets(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens: reads no ids."""
    return _located(spark, folder, "n_tokens")


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens (the length of the list), token_ids."""
    return _located(
        spark, folder, F.size("token_ids").cast("long").alias("n_tokens"), "token_ids"
    )


def _crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        lists = batch.column(3)
        flat = memoryview(np.ascontiguousarray(lists.values.to_numpy(), dtype="<u4")).cast("B")
        at = lists.offsets.to_numpy()
        crc = [zlib.crc32(flat[4 * i : 4 * j]) for i, j in zip(at, at[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(crc, pa.int64())],
            ["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def token_files(docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> DataFrame:
    """Writes the token files and returns what is read back from them: see ``read_tokens``.

    ``docs`` has doc_id and text; other columns are ignored. NULL and empty texts have the end id
    alone; rows without id come first; repeated rows are separate documents one after the other; an
    empty table gives a folder without rows and an empty result.
    """
    write_tokens(docs, folder, vocabulary, end_id)
    return read_tokens(docs.sparkSession, folder)


@query()
def op8_token_files(spark, sf_dir):
    found = token_files(table(spark, sf_dir, "documents"), scratch(spark, "tokens"))
    return found.mapInArrow(_crc, "doc_id long, start long, n_tokens long, ids_crc32 long")
