"""SuperMinHash near-duplicates: signatures, banding, verification on full sets, classes."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import components, query, stored, table

RANKS = 127  # places of a signature; a prime, so that a + b*j runs through all of them
BANDS, ROWS = 31, 4  # at a similarity of 0.8 a link is missed with probability 8e-8
BLOCK = 64  # texts of a candidate class that are verified together
WORDS_KEPT = 1_000_000  # word hashes that a task remembers

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: evenly spread 64-bit numbers."""
    x = x + _A
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        self[word] = n = xxhash.xxh3_64_intdigest(word)
        return n


def shingle_set(text: str | None, k: int, hashes: WordHashes) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct k-word shingles; A-Z lowered, blanks as in ASCII."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    x = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    if len(x) < k:
        return np.array([xxhash.xxh3_64_intdigest(b"short" + x.tobytes())], np.uint64)
    n = len(x) - k + 1
    s = x[:n]
    for i in range(1, k):
        s = mixed(s) + x[i : i + n]
    return np.unique(mixed(s))


def super_minhash(elements: np.ndarray) -> np.ndarray:
    """Least rank plus noise at each of RANKS places, over all elements.

    An element gives place a + b*j (mod RANKS) the rank j: a permutation, and any two places get
    any two ranks equally often, which is what lowers the variance against independent minima. The
    rank is in the upper 8 bits, the noise below. Ranks are gone through in ascending order and no
    further than the largest value so far: later ones can't lower any.
    """
    seed = mixed(elements)
    a = (seed % np.uint64(RANKS)).astype(np.int64)
    b = (mixed(seed) % np.uint64(RANKS - 1)).astype(np.int64) + 1
    least = np.full(RANKS, np.iinfo(np.uint64).max, np.uint64)
    j = 0
    while j < RANKS:
        step = min(RANKS - j, max(1, -(-700 // len(elements))))
        ranks = np.arange(j, j + step)
        places = (a[:, None] + b[:, None] * ranks) % RANKS
        noise = mixed(seed[:, None] + (ranks.astype(np.uint64) + np.uint64(1)) * _C) >> np.uint64(8)
        values = noise | (ranks.astype(np.uint64) << np.uint64(56))
        np.minimum.at(least, places.ravel(), values.ravel())
        j += step
        if int(least.max()) >> 56 < j:
            break
    return least


def band_hashes(signature: np.ndarray) -> np.ndarray:
    rows = signature[: BANDS * ROWS].reshape(BANDS, ROWS)
    h = mixed(np.arange(BANDS, dtype=np.uint64))
    for r in range(ROWS):
        h = mixed(h ^ rows[:, r])
    return h.view(np.int64)


def _signed(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sizes, keys, bands, offsets = [], [], [], [0]
            for text in batch.column(1).to_pylist():
                s = shingle_set(text, k, hashes)
                sizes.append(len(s))
                if len(s):
                    keys.append(blake2b(s.tobytes(), digest_size=16).digest())
                    bands.append(band_hashes(super_minhash(s)))
                else:
                    keys.append(None)
                offsets.append(len(bands) * BANDS)
            flat = np.concatenate(bands) if bands else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(sizes, pa.int64()),
                    pa.array(keys, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                ],
                ["doc_id", "n_shingles", "set_key", "bands"],
            )

    return run


def _sets(k: int):
    """id, class, block, set: of those rows whose text still has the set that was signed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            sets = [shingle_set(t, k, hashes).tobytes() for t in batch.column(1).to_pylist()]
            same = [
                blake2b(s, digest_size=16).digest() == key
                for s, key in zip(sets, batch.column(2).to_pylist(), strict=True)
            ]
            columns = [batch.column(0), *(batch.column(i) for i in (3, 4, 5))]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(sets, pa.binary())], ["id", "class", "block", "blocks", "set"]
            ).filter(pa.array(same, pa.bool_()))

    return run


def linked(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Edges that join the texts of a block as their links do: each to the first one of its class.

    From a text whose class is open, all texts not yet reached are compared at once; a text that is
    reached is compared with the rest in turn. No pair within a class is needed twice.
    """
    out = []
    left = np.arange(len(ids))
    sizes = np.array([len(s) for s in sets], np.int64)
    dense = starts = here = None
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue = [root]
        while queue and len(left):
            u = queue.pop()
            if here is None or len(left) < len(here) // 2:
                here = left.copy()
                names, dense = np.unique(np.concatenate([sets[i] for i in here]), return_inverse=True)
                starts = np.concatenate([[0], np.cumsum(sizes[here])[:-1]])
                row = np.full(len(ids), -1)
                row[here] = np.arange(len(here))
            mark = np.zeros(len(names), np.int64)
            at = np.searchsorted(names, sets[u])
            at[at == len(names)] = 0
            mark[at[names[at] == sets[u]]] = 1
            common = np.add.reduceat(mark[dense], starts)[row[left]]
            hit = 100 * common >= percent * (sizes[u] + sizes[left] - common)
            found = left[hit]
            left = left[~hit]
            queue.extend(found.tolist())
            out += [(ids[i], ids[root]) for i in found.tolist()]
    return out


def _verified(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            edges = []
            for members in batch.column(0):
                m = {x["id"]: x["set"] for x in members.as_py()}
                edges += linked(
                    list(m), [np.frombuffer(s, np.uint64) for s in m.values()], percent
                )
            yield pa.RecordBatch.from_arrays(
                [pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    return run


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Classes of documents whose k-word shingle sets overlap by ``percent`` or more.

    ``docs`` has doc_id and text; other columns are ignored. Equal sets become one; signatures of
    the different ones are cut in bands; sets that share a band form candidate classes (star edges
    to the least id of a bucket, never all pairs). A candidate class is verified on full sets, in
    blocks that are compared two by two, so that a large class is many tasks of bounded size, and
    the verified links are joined to classes.

    Returns doc_id, n_shingles, component_id (least id reachable by links), kept (the least id
    itself); a row for each row. NULL and empty texts have no shingles and link with nothing; rows
    without id link with nothing, have no component and are kept; repeated rows get the same result;
    rows that share an id but not the text get the class of their own text; empty gives empty.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    signed = stored(
        texts.mapInArrow(_signed(k), "doc_id long, n_shingles long, set_key binary, bands array<long>"),
        "signed",
    )
    sets = stored(
        signed.where("doc_id IS NOT NULL AND set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands")),
        "sets",
    )
    buckets = sets.select("rep", F.explode("bands").alias("band"))
    shared = buckets.groupBy("band").agg(F.min("rep").alias("least"), F.count("*").alias("n"))
    stars = (
        buckets.join(shared.where("n > 1"), "band")
        .where("rep <> least")
        .select(F.col("rep").alias("a"), F.col("least").alias("b"))
        .distinct()
    )
    candidates = components(stars).withColumnRenamed("component_id", "class")
    blocks = candidates.groupBy("class").agg(
        F.ceil(F.count("*") / F.greatest(F.lit(BLOCK), F.sqrt(F.count("*")))).cast("int").alias("blocks")
    )
    members = (
        candidates.join(blocks, "class")
        .join(sets.select(F.col("rep").alias("id"), "set_key"), "id")
        .select(
            "id",
            "set_key",
            "class",
            F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("block"),
            "blocks",
        )
    )
    packed = (
        texts.join(members, F.col("doc_id") == F.col("id"))
        .select("id", "text", "set_key", "class", "block", "blocks")
        .mapInArrow(_sets(k), "id long, class long, block int, blocks int, set binary")
        .groupBy("class", "block", "blocks")
        .agg(F.collect_list(F.struct("id", "set")).alias("members"))
    )
    others = F.filter(
        F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: (j != F.col("block")) | (F.col("blocks") == 1)
    )
    paired = (
        packed.withColumn("other", F.explode(others))
        .groupBy("class", F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"))
        .agg(F.flatten(F.collect_list("members")).alias("members"))
        .select("members")
    )
    links = paired.mapInArrow(_verified(percent), "a long, b long")
    classes = components(links)
    labels = sets.join(classes, F.col("rep") == F.col("id"), "left").select(
        F.col("set_key").alias("key"), F.coalesce("component_id", "rep").alias("component")
    )
    return (
        signed.join(
            labels, (F.col("set_key") == F.col("key")) & F.col("doc_id").isNotNull(), "left"
        )
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def distinct_documents(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each class, the one with the least id, with its columns; equal rows once."""
    kept = near_duplicates(docs, k, percent).where("kept AND doc_id IS NOT NULL")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    chosen = rows.join(
        kept.select(F.col("doc_id").alias("kept_id")).distinct(), F.col("row.doc_id") == F.col("kept_id")
    )
    once = chosen.groupBy("kept_id", F.sha2("row.text", 256)).agg(F.first("row").alias("row"))
    return once.select("row.*").unionByName(docs.where("doc_id IS NULL"))


@query()
def op5_near_duplicates(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85)
