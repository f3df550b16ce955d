"""Byte-level BPE in recursive SQL: token rows join the merge table until nothing merges."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.chunks import Lists, TextCoder, grouped, ordered, slices_of
from spendlake.llm.common import query, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PIECES = 40_000  # pieces of one recursion

SHORT = 48  # bytes of pieces that merge one pair in a round

# Ordered aggregation of the tokens that are left, and of their bytes.
DECODE = """
SELECT w, list(id ORDER BY pos) AS ids, string_agg(hex, '' ORDER BY pos) AS decoded
FROM step JOIN vocabulary USING (id) WHERE ended GROUP BY w
"""

# One round of the recursion merges, in each piece, the leftmost pair of the lowest merge that any
# pair allows; positions are unique over all pieces. Pieces without a merge leave the recursion.
ENCODE = f"""
WITH RECURSIVE step(w, pos, id, ended) AS (
  SELECT w, pos, id, FALSE FROM begin
  UNION ALL (
    WITH pair AS (
      SELECT p.w, p.pos, p.id, p.next, m.merged * 4294967296 + p.pos AS place
      FROM (
        SELECT w, pos, id, lead(pos) OVER (ORDER BY pos) AS next,
          CASE WHEN lead(w) OVER (ORDER BY pos) = w THEN lead(id) OVER (ORDER BY pos) END AS follows
        FROM step WHERE NOT ended
      ) p LEFT JOIN merges m ON m.a = p.id AND m.b = p.follows
    ),
    best AS (SELECT w, min(place) AS low, arg_min(next, place) AS eaten FROM pair GROUP BY w)
    SELECT w, pos, CASE WHEN place = low THEN low >> 32 ELSE id END, low IS NULL
    FROM pair JOIN best USING (w) WHERE pos IS DISTINCT FROM eaten
  )
)
{DECODE}"""

# For long pieces, a round merges the leftmost pair, and the pairs of the same merge that follow and
# don't overlap where that is proven to be what one pair at a time would give: where no lower merge
# can have the new token as a part (NOT alone).
ENCODE_LONG = f"""
WITH RECURSIVE step(w, pos, id, ended) AS (
  SELECT w, pos, id, FALSE FROM begin
  UNION ALL
  SELECT w, pos, CASE WHEN taken THEN merged ELSE id END, low IS NULL FROM (
    SELECT *, lag(taken) OVER (PARTITION BY w ORDER BY pos) AS eaten FROM (
      SELECT *, coalesce(merged = low AND (
        pos = min(CASE WHEN merged = low THEN pos END) OVER (PARTITION BY w)
        OR NOT alone AND (id <> follows OR (rn - coalesce(max(CASE WHEN merged IS DISTINCT FROM low
          THEN rn END) OVER (PARTITION BY w ORDER BY pos), 0)) % 2 = 1)), FALSE) AS taken
      FROM (
        SELECT p.*, m.merged, m.alone, min(m.merged) OVER (PARTITION BY p.w) AS low
        FROM (
          SELECT w, pos, id, lead(id) OVER (PARTITION BY w ORDER BY pos) AS follows,
            row_number() OVER (PARTITION BY w ORDER BY pos) AS rn
          FROM step WHERE NOT ended
        ) p LEFT JOIN merges m ON m.a = p.id AND m.b = p.follows
      )
    )
  ) WHERE NOT coalesce(eaten, FALSE)
)
{DECODE}"""


class SqlBpe:
    """Encodes and decodes pieces with the ranks of a vocabulary file, in an in-process database."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        ranks = self.ranks
        merges = [
            (ranks[t[:i]], ranks[t[i:]], r)
            for t, r in ranks.items()
            for i in range(1, len(t))
            if t[:i] in ranks and t[i:] in ranks
        ]
        alone = {x for a, b, r in merges for x in (a, b) if r < x}
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "300MB"})
        self._put("merges", a=[m[0] for m in merges], b=[m[1] for m in merges],
                  merged=[m[2] for m in merges], alone=[m[2] in alone for m in merges])
        self._put("vocabulary", id=list(ranks.values()), hex=[t.hex() for t in ranks])

    def _put(self, name: str, **columns) -> None:
        rows = pa.table(columns)  # noqa: F841
        self.db.register("arrived", rows)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM arrived")
        self.db.unregister("arrived")

    def code(self, pieces: list[str]) -> list[Lists]:
        """The ids of each piece, and the bytes that they decode to."""
        raw = [p.encode() for p in pieces]
        size = np.array([len(p) for p in raw], np.int64)
        out = [[(np.empty(0, kind), np.empty(0, np.int64))] for kind in (np.uint32, np.uint8)]
        order = []
        for sql, group in ((ENCODE, np.flatnonzero(size <= SHORT)), (ENCODE_LONG, np.flatnonzero(size > SHORT))):
            for low in range(0, len(group), PIECES):
                at = group[low : low + PIECES]
                for lists, found in zip(out, self._merged(sql, [raw[i] for i in at.tolist()]), strict=True):
                    lists.append(found)
                order.append(at)
        place = np.argsort(np.concatenate([np.empty(0, np.int64), *order]))
        return [ordered(tuple(np.concatenate(x) for x in zip(*lists, strict=True)), place) for lists in out]

    def _merged(self, sql: str, part: list[bytes]) -> list[Lists]:
        sizes = np.array([len(p) for p in part])
        w = np.repeat(np.arange(len(part), dtype=np.int32), sizes)
        pos = np.arange(len(w), dtype=np.int64)
        ids = self.single[np.frombuffer(b"".join(part), np.uint8)]
        whole = np.array([self.ranks.get(p, -1) for p in part], np.int32)
        entire = whole >= 0  # a piece that is a token is that token
        first = np.cumsum(sizes) - sizes
        keep = ~entire[w] | (pos == first[w])
        self._put("begin", w=w[keep], pos=pos[keep], id=np.where(entire[w], whole[w], ids)[keep])
        found = self.db.sql(sql).to_arrow_table().combine_chunks()
        place = np.argsort(found.column("w").to_numpy())
        lists = found.column("ids").combine_chunks()
        texts = found.column("decoded")
        decoded = np.frombuffer(bytes.fromhex("".join(texts.to_pylist())), np.uint8)
        return [
            ordered((lists.flatten().to_numpy().astype(np.uint32), np.diff(lists.offsets.to_numpy()).astype(np.int64)), place),
            ordered((decoded, pc.binary_length(texts).to_numpy().astype(np.int64) // 2), place),
        ]


class SqlCoder(TextCoder):
    """Ids and decoded bytes by the recursion, each different piece of the public pattern once."""

    def __init__(self, path: str):
        super().__init__()
        self.code = SqlBpe(path).code
        self.findall = regex.compile(public_tokenizers.PATTERN).findall

    def each(self, texts: list[str]) -> list[Lists]:
        cut = list(map(self.findall, texts))
        number = {p: i for i, p in enumerate(dict.fromkeys(p for x in cut for p in x))}
        at = np.array([number[p] for x in cut for p in x], np.int64)
        groups = np.array([len(x) for x in cut], np.int64)
        return [grouped(ordered(lists, at), groups) for lists in self.code(list(number))]

    def spaced(self, parts: pa.Array, words: bool) -> list[Lists]:
        texts = [" " + p for p in parts.to_pylist()]
        return self.code(texts) if words else self.each(texts)  # a word is one piece


BATCH = 6_000_000  # characters of texts whose parts are looked up together

_coders: dict[str, SqlCoder] = {}


def _coder(path: str) -> SqlCoder:
    if path not in _coders:
        _coders[path] = SqlCoder(path)
    return _coders[path]


def _binary(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Lists of numbers as their bytes."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]) * values.itemsize
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(values))]
    return pa.Array.from_buffers(pa.binary(), len(sizes), buffers)


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j in slices_of(batch.column(0), BATCH):
                rows = batch.slice(i, j - i)
                (ids, n), (decoded, size) = _coder(path).texts(rows.column(0))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[1:], pa.array(n), _binary(ids.astype("<u4"), n), _binary(decoded, size)],
                    [*batch.schema.names[1:], "n_tokens", "token_ids", "decoded"],
                )

    return run


def bpe_documents(docs: DataFrame, vocabulary: str = VOCABULARY, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Ids of whole texts, and the bytes that they decode to, beside the columns ``carry``.

    ``docs`` has text and the carried columns; others are ignored. Each match of the public pattern
    is encoded for itself, without special tokens. Distinct pieces of a partition go through the
    recursion once; decoding aggregates the tokens' bytes in order. Returns ``carry``, n_tokens,
    token_ids (binary: little-endian unsigned 32-bit), decoded (binary); a row for each row. NULL and
    empty texts have no tokens; NULL ids and repeated rows are as any other; empty gives empty. A
    long piece without a cut takes rounds by its merges, not by its length, where merges repeat.
    """
    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry)
    return docs.select("text", *[F.col(f"`{c}`") for c in carry]).mapInArrow(
        _encode(public_tokenizers.path(vocabulary)),
        f"{fields}, n_tokens long, token_ids binary, decoded binary",
    )


@query()
def op6_bpe_round_trip(spark, sf_dir):
    return bpe_documents(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
