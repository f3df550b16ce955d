"""Epsilon grid order join: vectors within a distance, by recursion over sorted sequences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import components, dropped, lean, query, stored, table

LEADING = 8  # principal dimensions that order the grid
INTERVAL = 4096  # vectors of a sequence interval, the unit that is joined, while there are few
FEW = 16  # intervals from which on they have more vectors instead
INTERVAL_BYTES = 8 << 20  # of vectors in an interval, about, so that a task holds few times as much
LEAF = 512  # vectors below which the recursion compares all


def _unit(vectors: np.ndarray) -> np.ndarray:
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        if batch.num_rows:
            x = _unit(_matrix(batch.column(0)))
            x = np.hstack([np.ones((len(x), 1)), x])
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        n = len(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(n), n)), pa.array(np.tile(np.arange(n), n)), pa.array(total.ravel())],
            ["i", "j", "v"],
        )


def principal_axes(vectors: DataFrame) -> np.ndarray:
    """Orthogonal axes in descending order of variance, of all unit vectors.

    The sums of products are aggregated over the partitions; what is collected has the square of
    the dimension as its size, whatever the number of vectors.
    """
    sums = (
        vectors.select("embedding")
        .mapInArrow(_moments, "i long, j long, v double")
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    n = max(r["i"] for r in sums) + 1
    m = np.zeros((n, n))
    for r in sums:
        m[r["i"], r["j"]] = r["v"]
    mean = m[0, 1:] / m[0, 0]
    values, axes = np.linalg.eigh(m[1:, 1:] / m[0, 0] - np.outer(mean, mean))
    return axes[:, np.argsort(-values)]


def _rotated(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Leading coordinates and the length of the rest, which is one more lower bound."""
    y = x @ axes[:, :LEADING]
    rest = np.sqrt(np.maximum(0, (x * x).sum(axis=1) - (y * y).sum(axis=1)))
    return np.hstack([y, rest[:, None]])


def _celled(axes: np.ndarray, eps: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = np.floor(_rotated(_unit(_matrix(batch.column(2))), axes) / eps).astype(np.int32)
            cells = [pa.array(cells[:, i] if i < cells.shape[1] else np.zeros(len(cells), np.int32))
                     for i in range(LEADING)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *cells], [*batch.schema.names, *(f"c{i}" for i in range(LEADING))]
            )

    return run


def _intervals(axes: np.ndarray, most: int, first: str):
    """Cuts a sorted partition into intervals; each is one row with its vectors and their box."""

    def row(rows: pa.Table, block: int) -> pa.RecordBatch:
        v = _matrix(rows.column("embedding").combine_chunks())
        y = _rotated(_unit(v), axes)
        values = {
            "block": [block],
            "lo": [y.min(axis=0)],
            "hi": [y.max(axis=0)],
            "ids": [rows.column("rep").to_numpy()],
            "copies": [rows.column("copies").to_numpy()],
            "vectors": [v.astype(first).tobytes()],
        }
        return pa.RecordBatch.from_pydict(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, k, held, n = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            while n >= most:
                rows = pa.Table.from_batches(held)
                yield row(rows.slice(0, most), (part << 32) + k)
                k, n = k + 1, n - most
                held = rows.slice(most).to_batches()
        if n:
            yield row(pa.Table.from_batches(held), (part << 32) + k)

    return run


class _Side:
    def __init__(self, ids, copies, vectors: np.ndarray, axes: np.ndarray):
        self.ids, self.copies = np.asarray(ids), np.asarray(copies)
        self.x = _unit(vectors.astype(np.float64))
        self.rough = self.x.astype(np.float32)
        self.y = _rotated(self.x, axes)


def grid_order_join(a: _Side, b: _Side, eps: float, cosine: float, found, spans=None) -> None:
    """Halves both sequences until they are provably distant or small, then compares in full.

    The gap between the boxes of two intervals, over the leading dimensions and the rest's length,
    is at most the distance of any two of their vectors. Small pairs are compared by a matrix
    product in single precision with a margin, and again in double precision near the limit.
    """
    spans = spans or ((0, len(a.ids)), (0, len(b.ids)))
    (i, j), (p, q) = spans
    same = a is b and i == p and j == q
    if not same:
        u, v = a.y[i:j], b.y[p:q]
        gap = np.maximum(0, np.maximum(u.min(0) - v.max(0), v.min(0) - u.max(0)))
        if (gap * gap).sum() > eps * eps + 1e-9:
            return
    if j - i <= LEAF and q - p <= LEAF:
        near = a.rough[i:j] @ b.rough[p:q].T
        if not same and near.max() < cosine - 1e-4:
            return
        rows, cols = np.nonzero(near >= cosine - 1e-4)
        if same:
            rows, cols = rows[rows < cols], cols[rows < cols]
        for s in range(0, len(rows), 1 << 16):
            r, c = rows[s : s + (1 << 16)] + i, cols[s : s + (1 << 16)] + p
            hit = np.einsum("ij,ij->i", a.x[r], b.x[c]) >= cosine
            if hit.any():
                found(r[hit], c[hit])
        return
    if same:
        h = (i + j) // 2
        for pair in (((i, h), (i, h)), ((i, h), (h, j)), ((h, j), (h, j))):
            grid_order_join(a, b, eps, cosine, found, pair)
    elif j - i >= q - p:
        h = (i + j) // 2
        for part in ((i, h), (h, j)):
            grid_order_join(a, b, eps, cosine, found, (part, (p, q)))
    else:
        h = (p + q) // 2
        for part in ((p, h), (h, q)):
            grid_order_join(a, b, eps, cosine, found, ((i, j), part))


def _least(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Smallest position reachable over the links u-v, for each of n positions."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        then = label.copy()
        np.minimum.at(then, u, low)
        np.minimum.at(then, v, low)
        np.minimum.at(then, label[u], low)
        np.minimum.at(then, label[v], low)
        then = then[then]
        if (then == label).all():
            return label
        label = then


def _joined(axes: np.ndarray, eps: float, cosine: float, first: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                c = {n: batch.column(i)[r] for i, n in enumerate(batch.schema.names)}
                dims = c["dims"].as_py()
                sides = {}
                for x in "ab" if c["a"].as_py() != c["b"].as_py() else "a":
                    v = np.frombuffer(c[f"{x}_vectors"].as_buffer(), first).reshape(-1, dims)
                    sides[x] = _Side(
                        c[f"{x}_ids"].values.to_numpy(), c[f"{x}_copies"].values.to_numpy(), v, axes
                    )
                a, b = sides["a"], sides.get("b", sides["a"])
                shift = 0 if a is b else len(a.ids)
                ids = a.ids if a is b else np.concatenate([a.ids, b.ids])
                links = np.zeros(len(ids), np.int64)
                stars = [np.empty((0, 2), np.int64)]

                def found(i, j, a=a, b=b, links=links, stars=stars, shift=shift):
                    np.add.at(links, i, b.copies[j])
                    np.add.at(links, j + shift, a.copies[i])
                    j = j + shift
                    here = np.concatenate([np.arange(i.min(), i.max() + 1), np.arange(j.min(), j.max() + 1)])
                    label = _least(len(here), i - i.min(), j - j.min() + i.max() - i.min() + 1)
                    moved = np.nonzero(label != np.arange(len(here)))[0]
                    stars.append(np.stack([here[moved], here[label[moved]]], axis=1))

                grid_order_join(a, b, eps, cosine, found)
                s = np.concatenate(stars)
                label = _least(len(ids), s[:, 0], s[:, 1])
                met = np.nonzero(links)[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[met]), pa.array(links[met]), pa.array(ids[label[met]])],
                    ["a", "n", "b"],
                )

    return run


def _stored_intervals(reps: DataFrame, dims: int, axes: np.ndarray, eps: float, first: str) -> DataFrame:
    """The vectors in grid order, an interval a row: block, lo, hi (their box), ids, copies, vectors."""
    cells = [f"c{i}" for i in range(LEADING)]
    kind = reps.schema["embedding"].dataType.elementType.typeName()
    celled = reps.select("rep", "copies", "embedding").mapInArrow(
        _celled(axes, eps),
        f"rep long, copies long, embedding array<{kind}>, " + ", ".join(f"{c} int" for c in cells),
    )
    most = max(LEAF, INTERVAL_BYTES // (dims * np.dtype(first).itemsize))
    n = reps.count()
    parts = max(1, -(-n // most), min(FEW, -(-n // INTERVAL)))
    with lean(reps.sparkSession, min(10_000, most)):
        return stored(
            celled.repartitionByRange(parts, *cells, "rep")
            .sortWithinPartitions(*cells, "rep")
            .mapInArrow(
                _intervals(axes, most + most // 4, first),  # partitions by range are not quite even
                "block long, lo array<double>, hi array<double>, ids array<long>, copies array<long>, "
                "vectors binary",
            ),
            "intervals",
        )


def _links(intervals: DataFrame, dims: int, axes: np.ndarray, eps: float, cosine: float, first: str) -> DataFrame:
    """Links of different vectors of one length: a, n (vectors linked within a pair), b (a star).

    Each task reads two parts of the stored intervals and joins those whose boxes are near enough, so
    no vector is shuffled or written for its neighbours, however many they are.
    """
    side = lambda x: intervals.select(
        F.col("block").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in ("lo", "hi", "ids", "copies", "vectors")]
    )
    gaps = F.aggregate(
        F.zip_with(
            F.zip_with("a_lo", "b_hi", lambda x, y: F.greatest(x - y, F.lit(0.0))),
            F.zip_with("b_lo", "a_hi", lambda x, y: F.greatest(x - y, F.lit(0.0))),
            lambda x, y: x * x + y * y,
        ),
        F.lit(0.0),
        lambda s, x: s + x,
    )
    return (
        side("a")
        .join(side("b").hint("shuffle_replicate_nl"), (F.col("a") <= F.col("b")) & (gaps <= eps * eps + 1e-9))
        .select(*[f"{x}{c}" for x in "ab" for c in ("", "_ids", "_copies", "_vectors")], F.lit(dims).alias("dims"))
        .mapInArrow(_joined(axes, eps, cosine, first), "a long, n long, b long")
    )


def embedding_links(vectors: DataFrame, cosine: float = 0.95) -> DataFrame:
    """Links of cosine ``cosine`` or more, counted for each vector, and the classes they make.

    ``vectors`` has vec_id and embedding (array of float or double); other columns are ignored.
    Equal vectors become one with a count. The others are sorted in epsilon grid order: by the cells
    of a grid as wide as the largest distance of a link, on the leading principal axes. Intervals
    of that sequence whose boxes are near enough are joined, each pair in one task, by recursion; a
    task reads both from where they are stored. It returns counts and star edges, so a dense group
    stays linear.

    Returns vec_id, n_links (other vectors linked directly), component_id (least id reachable),
    kept (component_id is the own id); a row for each row. Vectors that are NULL, empty, zero or
    hold NULL, NaN or infinity link with nothing, neither do rows without id nor vectors of
    different length; repeated rows link with each other; ids are taken to be unique among
    different vectors; empty gives empty.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = rows.where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.forall("embedding", fine)
        & F.exists("embedding", lambda x: x != 0)
    )
    spark = rows.sparkSession
    with lean(spark):
        reps = stored(
            good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")),
            "vectors",
        )
    lengths = [r[0] for r in reps.select(F.size("embedding")).distinct().collect()]
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine)))
    first = "<f4" if reps.schema["embedding"].dataType.elementType.typeName() == "float" else "<f8"
    links = spark.createDataFrame([], "a long, n long, b long")
    intervals = []
    for n in sorted(lengths):
        of_length = reps.where(F.size("embedding") == n)
        axes = principal_axes(of_length)
        intervals.append(_stored_intervals(of_length, n, axes, eps, first))
        links = links.unionByName(_links(intervals[-1], n, axes, eps, cosine, first))
    with lean(spark, 1):  # a row is a pair of intervals
        links = stored(links, "links")
    for x in intervals:
        dropped(x)
    # Vectors find their first one here, for the last time: what follows are numbers.
    firsts = reps.select(F.col("embedding").alias("e"), F.xxhash64("embedding").alias("h"), "rep", "copies")
    same = (F.xxhash64(rows["embedding"]) == F.col("h")) & (rows["embedding"] == F.col("e"))
    with lean(spark):
        members = stored(
            rows.join(firsts, same & F.col("vec_id").isNotNull(), "left").select("vec_id", "rep", "copies"),
            "members",
        )
        dropped(reps)
        counts = links.groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
        classes = components(links.select("a", "b")).withColumnRenamed("id", "rep")
        marked = stored(counts.join(classes, "rep", "left"), "classes")
    return (
        members.join(marked, "rep", "left")
        .select(
            "vec_id",
            F.coalesce(F.coalesce("n", F.lit(0)) + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "rep", "vec_id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )


SQL = """
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), classes AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
), counts AS (
  SELECT a, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN classes ON classes.a = vec_id LEFT JOIN counts ON counts.a = vec_id
"""


@query(SQL)
def op4_embedding_links(spark, sf_dir):
    return embedding_links(table(spark, sf_dir, "embeddings"))
