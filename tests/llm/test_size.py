"""What operators leave on disk and hold at once, and that parts give what the whole gives."""

import os
import random
import threading
import time

import numpy as np
import pyarrow.compute as pc
import pytest

from spendlake.llm import grid_order, markov
from spendlake.llm.common import lean


def shuffled(spark):
    """Bytes of shuffle files on this session's disks."""
    disks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    files = [f"{at}/{f}" for d in disks for at, _, names in os.walk(d) for f in names if f.startswith("shuffle_")]
    return sum(os.path.getsize(f) for f in files if os.path.exists(f))


def left_by(spark, build):
    """The result of ``build``, and the bytes of shuffle files that are there more than before."""
    before = shuffled(spark)
    found = build()
    for _ in range(50):
        if (left := shuffled(spark) - before) <= 0:
            break
        time.sleep(0.1)
    return found, left


def most_by(spark, build):
    """The result of ``build``, and the most bytes of shuffle files that it had beside those before."""
    before, ended, most = shuffled(spark), threading.Event(), [0]

    def watch():
        while not ended.wait(0.05):
            most[0] = max(most[0], shuffled(spark) - before)

    watcher = threading.Thread(target=watch)
    watcher.start()
    try:
        found = build()
        return found, most[0]
    finally:
        ended.set()
        watcher.join()


def odd_docs(spark, n=600, words=3000):
    r = random.Random(3)
    vocabulary = [f"w{i}{r.choice(['ing', 'ed', 's', ''])}" for i in range(words)]
    rows = [(i, " ".join(r.choices(vocabulary, k=r.randint(0, 200)))) for i in range(n)]
    return spark.createDataFrame(
        [*rows, (None, "no id w1"), (n, None), (n + 1, " \n"), rows[5], rows[5]], "doc_id long, text string"
    )


def test_markov_measures_one_block_at_a_time(spark, monkeypatch):
    docs = odd_docs(spark)
    in_order = lambda rows: sorted(rows, key=lambda r: (r.doc_id is None, r.doc_id))
    whole = in_order(markov.score_documents(docs.coalesce(1), states=2, rounds=0).collect())
    real = markov._measure

    def checked(n):
        inner = real(n)

        def run(rows):
            assert len(pc.unique(rows["block"])) == 1 and rows["tokens"].null_count == len(rows) - 1
            return inner(rows)

        return run

    monkeypatch.setattr(markov, "_measure", checked)
    monkeypatch.setattr(markov, "BLOCK_CHARS", 5_000)
    monkeypatch.setattr(markov, "PLACED", 1_000)
    monkeypatch.setattr(markov, "WORDS", 100)
    parts = in_order(markov.score_documents(docs.repartition(5), states=2, rounds=0).collect())
    assert [r[:5] for r in parts] == [r[:5] for r in whole]
    assert np.allclose([r[5:] for r in parts], [r[5:] for r in whole], rtol=1e-9)


def test_markov_leaves_no_shuffled_words(spark):
    docs = odd_docs(spark, 3000, 100_000).repartition(8).localCheckpoint()
    text = sum(len(r.text or "") for r in docs.collect())
    _, left = left_by(spark, lambda: markov.score_documents(docs, states=2, rounds=1))
    assert left < text / 10


def test_markov_without_words(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([None, "", " "])], "doc_id long, text string")
    found = markov.score_documents(docs).collect()
    assert [(r.n_tokens, r.n_known) for r in found] == [(1, 1)] * 3


@pytest.mark.parametrize("shape", [0, 1, 70_000])
def test_numbers_come_back_from_their_planes(shape):
    r = np.random.default_rng(1)
    for kind in ("i2", "i4", "i8"):
        values = r.integers(np.iinfo(kind).min, np.iinfo(kind).max, shape).astype(kind)
        assert (markov._numbers(markov._planes(values), kind) == values).all()


def test_embedding_links_shuffle_no_vector_for_its_neighbours(spark, monkeypatch):
    r = np.random.default_rng(4)
    base = r.normal(size=(2500, 24))
    v = np.vstack([base, base[:400] + 0.02 * r.normal(size=(400, 24)), base[:50], 2 * base[:20], [[0.0] * 24]])
    v[7, 3] = v[2907, 3] = 0.0  # a copy of the other sign of 0
    v[2907, 3] *= -1
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    table = table.repartition(4).localCheckpoint()
    monkeypatch.setattr(grid_order, "INTERVAL", 100)
    monkeypatch.setattr(grid_order, "INTERVAL_BYTES", 700 * 24 * 8)
    found, most = most_by(spark, lambda: grid_order.embedding_links(table))
    assert most < 4 * v.nbytes
    unit = v[:-1] / np.linalg.norm(v[:-1], axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    found = {x.vec_id: x for x in found.collect()}
    assert len(found) == len(v) and found[len(v) - 1].n_links == 0 and found[len(v) - 1].kept
    assert [found[i].n_links for i in range(len(unit))] == (linked.sum(axis=1) - 1).tolist()
    reach = linked.astype(np.float32)
    for _ in range(4):
        reach = (reach @ reach > 0).astype(np.float32)
    assert [found[i].component_id for i in range(len(unit))] == reach.argmax(axis=1).tolist()


def test_lean_puts_the_options_back(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with pytest.raises(ValueError, match="within"), lean(spark, 7):
        assert spark.conf.get(key) == "7"
        raise ValueError("within")
    assert spark.conf.get(key) == before
