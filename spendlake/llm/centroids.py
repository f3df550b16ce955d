"""Centroid clustering in exact integers, by equal-average equal-variance nearest search."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import query, stored, table

DIMS = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
LARGEST = 1 << 27  # a squared distance of such components still fits 64 bits


class Searcher:
    """Nearest centroids. ``centroids`` are whole numbers, one row each; ties go to the smaller row.

    They are sorted by the sum of their components, that is by mean. From a vector's own mean the
    search goes outwards to both sides and stops on a side where the distance of the means alone
    is too large. What is left is rejected if means and deviations together are, and otherwise
    compared in full. For sums S, squares Q and k components, k * distance >= (S - S')**2, and with
    V = sqrt(k * Q - S**2), k * distance >= (S - S')**2 + (V - V')**2. Rejecting allows for the
    rounding of V, so equal distances are always compared.
    """

    def __init__(self, centroids: np.ndarray):
        self.order = np.argsort(centroids.sum(axis=1), kind="stable")
        self.sorted = centroids[self.order]
        self.sums, self.deviations = _marks(self.sorted)
        self.tested = 0  # full comparisons

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row and squared distance of the nearest centroid, for each row of ``x``."""
        n, k = x.shape
        c = len(self.sorted)
        sums, deviations = _marks(x)
        high = np.searchsorted(self.sums.astype(np.float64), sums.astype(np.float64))
        low = high - 1
        best = np.full(n, np.iinfo(np.int64).max)
        label = np.full(n, c, np.int64)
        limit = np.full(n, np.inf)  # k * best, as far as a float tells
        rows = np.arange(n)
        while len(rows):
            a, b = low[rows], high[rows]
            left = np.where(a >= 0, np.abs(sums[rows] - self.sums[np.maximum(a, 0)]), np.inf)
            right = np.where(b < c, np.abs(sums[rows] - self.sums[np.minimum(b, c - 1)]), np.inf)
            take_left = left <= right
            gap = np.where(take_left, left, right)
            alive = gap * gap <= limit[rows] * (1 + 1e-9)  # the nearer side decides for both
            alive &= np.isfinite(gap)
            rows, take_left, gap = rows[alive], take_left[alive], gap[alive]
            at = np.where(take_left, low[rows], high[rows])
            low[rows[take_left]] -= 1
            high[rows[~take_left]] += 1
            spread = deviations[rows] - self.deviations[at]
            slack = 1e-6 * (np.abs(spread) + 1) * (deviations[rows] + 1)
            close = gap * gap + spread * spread - slack <= limit[rows] * (1 + 1e-9)
            near, at = rows[close], at[close]
            self.tested += len(near)
            diff = x[near] - self.sorted[at]
            distance = np.einsum("ij,ij->i", diff, diff)
            number = self.order[at]
            better = (distance < best[near]) | ((distance == best[near]) & (number < label[near]))
            near, distance = near[better], distance[better]
            best[near], label[near] = distance, number[better]
            limit[near] = distance.astype(np.float64) * k
        return label, best


def _marks(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    sums = x.sum(axis=1)
    spread = x - (sums / x.shape[1])[:, None]
    return sums, np.sqrt(x.shape[1] * (spread * spread).sum(axis=1))


def _integers(dims: int, scale: int):
    """Vectors that are kept, as whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 8192):
                part = batch.slice(low, 8192)
                flat = part.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)
                x = np.floor(scale * flat.reshape(-1, dims))
                fine = (np.abs(x) <= LARGEST).all(axis=1)
                raw = np.ascontiguousarray(x[fine], dtype="<i4").view(f"V{4 * dims}").ravel()
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).filter(pa.array(fine)), pa.array([r.tobytes() for r in raw], pa.binary())],
                    ["vec_id", "vector"],
                )

    return run


def whole_vectors(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE) -> DataFrame:
    """vec_id and vector (``dims`` little-endian 32-bit numbers): floor(scale * x) of what is kept."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
        .where(F.col("e").isNotNull() & (F.size("e") == dims) & F.forall("e", fine))
        .mapInArrow(_integers(dims, scale), "vec_id long, vector binary")
    )


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, dims).astype(np.int64)


def _moved(centroids: np.ndarray):
    """Per task: for each centroid its vectors, the sums of their components, and of their distances."""
    dims = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(centroids)
        k = len(centroids)
        totals = [[0] * (dims + 2) for _ in range(k)]
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0), dims)
            label, distance = searcher.nearest(x)
            for c in np.unique(label):
                mine = label == c
                news = [int(mine.sum()), sum(distance[mine].tolist()), *x[mine].sum(axis=0).tolist()]
                totals[c] = [a + b for a, b in zip(totals[c], news, strict=True)]
        rows = [(c, i, str(v)) for c in range(k) for i, v in enumerate(totals[c]) if totals[c][0]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], pa.int32()),
                pa.array([r[2] for r in rows], pa.string()),
            ],
            ["cluster", "i", "v"],
        )

    return run


def _sums(whole: DataFrame, centroids: np.ndarray) -> dict[int, list[int]]:
    """Count, inertia and sums of each cluster that has vectors: a bounded number of numbers."""
    found = (
        whole.select("vector")
        .mapInArrow(_moved(centroids), "cluster int, i int, v string")
        .groupBy("cluster", "i")
        .agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
        .collect()
    )
    out: dict[int, list[int]] = {}
    for r in sorted(found, key=lambda r: (r["cluster"], r["i"])):
        out.setdefault(r["cluster"], []).append(int(r["v"]))
    return out


def seeds(whole: DataFrame, clusters: int, dims: int) -> np.ndarray:
    """The vectors whose hash of clusters, seed and id is least; equal ids by their components."""
    first = (
        whole.withColumn("key", F.sha2(F.concat(F.lit("3:"), F.col("vec_id").cast("string")), 256))
        .orderBy(F.asc_nulls_last("key"), "vector")
        .limit(clusters)
        .collect()
    )
    return np.array([np.frombuffer(r["vector"], "<i4") for r in first], np.int64).reshape(-1, dims)


def _assigned(centroids: np.ndarray, inertia: list[int], total: int):
    dims = centroids.shape[1]
    digests = [hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest() for c in centroids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(centroids)
        for batch in batches:
            label, distance = (
                searcher.nearest(_matrix(batch.column(1), dims)) if batch.num_rows else (np.empty(0, int),) * 2
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(label, pa.int32()),
                    pa.array(distance, pa.int64()),
                    pa.array([inertia[c] for c in label], pa.int64()),
                    pa.array([total] * len(label), pa.int64()),
                    pa.array([digests[c] for c in label], pa.string()),
                ],
                ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"],
            )

    return run


CLUSTERED = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
)


def clustered_vectors(
    vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE
) -> DataFrame:
    """Each vector's nearest of ``clusters`` centroids after ``rounds`` of moving them, exactly.

    ``vectors`` has vec_id and embedding (array of float or double); other columns are ignored. Kept
    are those with ``dims`` components, all finite; a component x counts as floor(scale * x). (Beyond
    2**27 after scaling distances would not fit their type, and a vector is not kept.) A round is one
    pass: tasks return counts and sums, which are added exactly, so reruns and other partitions give
    the same. A centroid without vectors stays where it is.

    Returns vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 for each kept row.
    Repeated rows count each time; rows without id are clustered, and are seeds last; with fewer
    vectors than clusters there are fewer centroids; without any vector the result is empty.
    """
    spark = vectors.sparkSession
    whole = stored(whole_vectors(vectors, dims, scale), "whole")
    centroids = seeds(whole, clusters, dims)
    if not len(centroids):
        return spark.createDataFrame([], CLUSTERED)
    for _ in range(rounds):
        for c, (n, _, *sums) in _sums(whole, centroids).items():
            centroids[c] = [s // n for s in sums]
    found = _sums(whole, centroids)
    inertia = [found[c][1] if c in found else 0 for c in range(len(centroids))]
    return whole.mapInArrow(_assigned(centroids, inertia, sum(inertia)), CLUSTERED)


def _sql() -> str:
    """The same by plain comparison with all centroids, round after round."""
    near = """
n{r} AS MATERIALIZED (
  SELECT vec_id, v, min(struct_pack(d := d, c := c)) AS m FROM (
    SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, w), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d
    FROM whole, c{r})
  GROUP BY vec_id, v
)"""
    move = """
c{s} AS MATERIALIZED (
  SELECT c, coalesce(new, w) AS w FROM c{r} LEFT JOIN (
    SELECT c, list(CAST(floor_of AS BIGINT) ORDER BY i) AS new FROM (
      SELECT c, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS floor_of
      FROM (SELECT m.c AS c, unnest(v) AS x, unnest(range(64)) AS i FROM n{r}) GROUP BY c, i)
    GROUP BY c) USING (c)
)"""
    steps = [near.format(r=0)]
    for r in range(ROUNDS):
        steps += [move.format(r=r, s=r + 1), near.format(r=r + 1)]
    return f"""
WITH whole AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1 AS c, v AS w FROM whole
  ORDER BY sha256('3:' || vec_id) LIMIT 8
), {",".join(steps)}
SELECT vec_id, CAST(m.c AS INTEGER) AS cluster, CAST(m.d AS BIGINT) AS distance,
  CAST(sum(m.d) OVER (PARTITION BY m.c) AS BIGINT) AS cluster_inertia, CAST(sum(m.d) OVER () AS BIGINT) AS inertia,
  sha256(array_to_string(w, ',')) AS centroid_sha256
FROM n{ROUNDS} n JOIN c{ROUNDS} c ON c.c = n.m.c
"""


@query(_sql())
def op13_centroid_clusters(spark, sf_dir):
    return clustered_vectors(table(spark, sf_dir, "embeddings"))
