"""Exact clustering against plain comparison with all centroids."""

from hashlib import sha256

import numpy as np
import pytest

from spendlake.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, label int, vector string, cluster int"


def plainly(rows, clusters=8, rounds=10, dims=64):
    kept = [
        (i, [int(np.floor(1024 * x)) for x in e])
        for i, e, *_ in rows
        if e is not None and len(e) == dims and all(x is not None and np.isfinite(x) for x in e)
    ]
    key = lambda r: ("~" if r[0] is None else sha256(f"3:{r[0]}".encode()).hexdigest(), np.array(r[1], "<i4").tobytes())
    at = [list(v) for _, v in sorted(kept, key=key)[:clusters]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c, strict=True))
    near = lambda v: min(range(len(at)), key=lambda c: (far(v, at[c]), c))
    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v), []).append(v)
        for c, vs in groups.items():
            at[c] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    out = [(i, near(v), far(v, at[near(v)])) for i, v in kept]
    total = sum(d for *_, d in out)
    return [
        (i, c, d, sum(x for _, o, x in out if o == c), total, sha256(",".join(map(str, at[c])).encode()).hexdigest())
        for i, c, d in out
    ]


def vectors(n, seed):
    r = np.random.default_rng(seed)
    middle = r.normal(size=(5, 64))
    return [(i, (middle[i % 5] * (1 + i % 3) + r.normal(size=64) / 3).tolist(), 0, "x", 1) for i in range(n)]


def odd_vectors():
    rows = vectors(120, 4)
    even = [0.5] * 64
    rows += [(200 + i, even, 1, "", 2) for i in range(9)]  # equal: all distances tie
    rows += [(300, None, 0, "", 0), (301, [], 0, "", 0), (302, [1.0] * 63, 0, "", 0), (303, [1.0] * 65, 0, "", 0)]
    rows += [(304 + i, [x] + even[1:], 0, "", 0) for i, x in enumerate([None, float("nan"), float("inf"), -0.0])]
    rows += [(None, even, 0, None, None), rows[0], rows[0], (400, [-3.7] * 64, 0, "", 0)]
    return rows


@pytest.mark.parametrize("rows", [odd_vectors(), vectors(5, 1), [(i, [0.25] * 64, 0, "", 0) for i in range(20)]])
def test_clusters(spark, rows):
    table = spark.createDataFrame(rows, SCHEMA).repartition(3)
    order = lambda rs: sorted(rs, key=repr)
    assert order(map(tuple, centroids.clustered_vectors(table).collect())) == order(plainly(rows))


def test_nothing_to_cluster(spark):
    table = spark.createDataFrame(odd_vectors(), SCHEMA)
    assert centroids.clustered_vectors(table.where("false")).count() == 0
    assert centroids.clustered_vectors(table.where("vec_id BETWEEN 300 AND 303")).count() == 0
    far = spark.createDataFrame([(1, [2.0**40] * 64), (2, [1.0] * 64)], "vec_id long, embedding array<double>")
    assert [r.vec_id for r in centroids.clustered_vectors(far).collect()] == [2]


def test_search_rejects_and_stays_exact():
    r = np.random.default_rng(3)
    for spread, k in ((1, 200), (40, 64), (1000, 8)):
        at = np.floor(r.normal(size=(k, 64)) * 50 + r.normal(size=(k, 1)) * spread).astype(np.int64)
        at[k // 2] = at[0]  # equal centroids: the smaller number
        x = at[r.integers(0, k, 500)] + r.integers(-20, 20, (500, 64))
        x[:50] = (at[:8] + at[-8:])[r.integers(0, 8, 50)] // 2
        searcher = centroids.Searcher(at)
        label, distance = searcher.nearest(x)
        plain = ((x[:, None, :] - at[None]) ** 2).sum(axis=2)
        assert (label == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()
        assert spread < 40 or searcher.tested < len(x) * k / 3
