"""A hidden Markov language model: trained by Baum-Welch, scored by the forward recursion."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import dropped, lean, query, stored, table

STATES = 8
ROUNDS = 4
FREQUENT = 2048  # words with a class of their own: bounds the model, not the vocabulary
ENDINGS = 512  # classes of all other words, by their ending
END_CLASS = FREQUENT + ENDINGS
CLASSES = END_CLASS + 1
BLOCK_CHARS = 6_000_000  # of texts that are coded together
SEGMENT = 64  # tokens of a training segment
SIDE_BY_SIDE = 1024  # segments that a task trains on at a time
OWN = 1 << 39  # marks a looked-up word's own class, which stands where its count would
TEXTS = 500  # texts that Python is sent at once
WORDS = 10_000  # distinct words that it sends back at once
PLACED = 1 << 20  # looked-up words that a task brings together by their blocks


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


class _Local(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _list(values: np.ndarray | list, kind: pa.DataType) -> pa.Array:
    flat = pa.array(values, kind)
    return pa.ListArray.from_arrays(pa.array([0, len(flat)], pa.int32()), flat)


def _planes(values: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, the highest first, which are mostly 0 and so stored small."""
    wide = np.ascontiguousarray(values, values.dtype.newbyteorder(">"))
    return wide.view(np.uint8).reshape(len(wide), wide.itemsize).T.tobytes()


def _numbers(planes: pa.Buffer | memoryview, kind: str) -> np.ndarray:
    wide = np.dtype(kind).newbyteorder(">")
    flat = np.frombuffer(planes, np.uint8).reshape(wide.itemsize, -1).T
    return np.ascontiguousarray(flat).view(wide).ravel().astype(kind)


CODED = pa.schema([
    ("block", pa.int64()), ("pos", pa.int32()), ("word", pa.binary()), ("n", pa.int64()),
    ("doc_ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())), ("sizes", pa.list_(pa.int32())),
    ("tokens", pa.binary()), ("endings", pa.binary()),
])


def _code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts as numbers: a row with each token's place among the block's distinct words.

    These words, the more frequent ones first, are rows of their own, with their training count.
    """
    from pyspark import TaskContext

    part, k = TaskContext.get().partitionId(), 0
    local, ids, tokens, size = _Local(), [], [], 0

    def rows(count: int, **columns) -> pa.RecordBatch:
        columns["block"] = pa.array(np.full(count, (part << 32) + k))
        return pa.RecordBatch.from_arrays(
            [columns.get(f.name, pa.nulls(count, f.type)) for f in CODED], schema=CODED
        )

    def block() -> Iterator[pa.RecordBatch]:
        held = [is_held_out(i) for i in ids]
        seen = [np.empty(0, np.int32)]
        for h, t in zip(held, tokens, strict=True):
            if not h:
                seen.append(t)
        counts = np.bincount(np.concatenate(seen), minlength=len(local))
        flat = np.concatenate(tokens)
        order = np.argsort(-np.bincount(flat, minlength=len(local)), kind="stable")
        place = np.empty(len(order), np.int32)
        place[order] = np.arange(len(order))
        words = pa.array(list(local), pa.binary()).take(pa.array(order))
        endings = [FREQUENT + zlib.crc32(w[-3:]) % ENDINGS for w in words.to_pylist()]
        yield rows(
            1,
            doc_ids=_list(ids, pa.int64()),
            held=_list(held, pa.bool_()),
            sizes=_list([len(t) for t in tokens], pa.int32()),
            tokens=pa.array([_planes(place[flat])]),
            endings=pa.array([_planes(np.array(endings, np.int16))]),
        )
        for low in range(0, len(words), WORDS):
            some = words.slice(low, WORDS)
            yield rows(
                len(some),
                pos=pa.array(np.arange(low, low + len(some), dtype=np.int32)),
                word=some,
                n=pa.array(counts[order[low : low + WORDS]].astype(np.int64)),
            )

    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = (text or "").encode().lower().split()
            ids.append(doc_id)
            tokens.append(np.fromiter(map(local.__getitem__, words), np.int32, len(words)))
            size += len(text or "")
            if size >= BLOCK_CHARS:
                yield from block()
                local, ids, tokens, size, k = _Local(), [], [], 0, k + 1
                pa.default_memory_pool().release_unused()
    if ids:
        yield from block()


@dataclass
class Counted:
    """What the training texts hold: tokens N, distinct tokens V, and both for each class."""

    total: int
    distinct: int
    texts: int
    class_tokens: np.ndarray
    class_words: np.ndarray


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Looked-up words (block, pos, known) as a row for each block that is met: places, then what is known."""
    held, size = [], 0

    def rows() -> pa.RecordBatch:
        block, pos, known = (np.concatenate(c) for c in zip(*held, strict=True))
        order = np.lexsort((pos, block))
        block, pos, known = block[order], pos[order], known[order]
        cuts = np.flatnonzero(np.diff(block, prepend=block[:1] - 1, append=block[-1:] + 1))
        found = [_planes(pos[i:j]) + _planes(known[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(block[cuts[:-1]]), pa.array(found, pa.binary())], ["block", "found"])

    for batch in batches:
        if batch.num_rows:
            held.append([c.to_numpy() for c in batch.columns])
            size += batch.num_rows
        if size >= PLACED:
            yield rows()
            held, size = [], 0
    if size:
        yield rows()


def _measure(n: Counted):
    """For a block: classes of its tokens, ends included, and each text's sums over its words."""

    def run(rows: pa.Table) -> pa.Table:
        text = rows.filter(pc.is_valid(rows["tokens"]))
        block, ids, held, sizes, tokens, endings = (
            text[c][0] for c in ("block", "doc_ids", "held", "sizes", "tokens", "endings")
        )
        sizes, tokens = sizes.values.to_numpy(), _numbers(tokens.as_buffer(), "i4")
        cls = _numbers(endings.as_buffer(), "i2")
        c = np.zeros(len(cls), np.int64)
        for found in rows["found"].drop_null():
            data = memoryview(found.as_buffer())
            cut = len(data) // 12 * 4
            c[_numbers(data[:cut], "i4")] = _numbers(data[cut:], "i8")
        own = c & OWN != 0
        c &= OWN - 1
        cls[own] = c[own]
        c[own] = n.class_tokens[cls[own]]
        base = np.log10((c + 1) / (n.total + n.distinct + 1))
        inner = np.log10((c + 1) / (n.class_tokens[cls] + n.class_words[cls] + 1))
        inner[cls < FREQUENT] = 0.0
        ends = np.cumsum(sizes)
        sums = []
        for per_word in (base, inner, (c > 0).astype(np.float64)):
            run_sum = np.concatenate([[0.0], np.cumsum(per_word[tokens])])
            sums.append(run_sum[ends] - run_sum[ends - sizes])
        end_base = np.log10((n.texts + 1) / (n.total + n.distinct + 1))
        classes = np.insert(cls[tokens], ends, END_CLASS)
        pa.default_memory_pool().release_unused()
        return pa.Table.from_arrays(
            [
                pa.array([block.as_py()]),
                _list(ids.values, pa.int64()),
                _list(held.values, pa.bool_()),
                _list(sizes + 1, pa.int32()),
                pa.array([_planes(classes)]),
                _list(sums[0] + end_base, pa.float64()),
                _list(sums[1], pa.float64()),
                _list(np.rint(sums[2]).astype(np.int64) + (n.texts > 0), pa.int64()),
            ],
            ["block", "doc_ids", "held", "sizes", "classes", "base", "inner", "known"],
        )

    return run


@dataclass
class Model:
    """Start, transition and emission probabilities, and how often a state is met at all."""

    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray
    met: np.ndarray


def first_model(class_tokens: np.ndarray, states: int) -> Model:
    """States that stay, each with the corpus' classes at other odds (fixed seed)."""
    random = np.random.default_rng(7)
    emit = (class_tokens + 1.0) * np.exp(random.normal(size=(states, len(class_tokens))))
    move = np.full((states, states), 0.1 / max(1, states - 1))
    np.fill_diagonal(move, 0.9 if states > 1 else 1.0)
    even = np.full(states, 1 / states)
    return Model(even, move, emit / emit.sum(axis=1, keepdims=True), even)


def expected_counts(model: Model, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Emission, transition and start counts of a run of texts, each closed by an end.

    The run is cut in segments that are worked on side by side; after an end the state is drawn
    anew, and a segment that begins within a text begins with the states' mean shares.
    """
    k, n = len(model.start), len(classes)
    emits, moves, starts, loglik = np.zeros((CLASSES, k)), np.zeros((k, k)), np.zeros(k), 0.0
    rows = -(-n // SEGMENT)
    padded = np.full(rows * SEGMENT, END_CLASS, np.int64)
    padded[:n] = classes
    fresh = np.concatenate([[True], padded[:-1] == END_CLASS]).reshape(rows, SEGMENT)
    real = (np.arange(rows * SEGMENT) < n).reshape(rows, SEGMENT)
    padded = padded.reshape(rows, SEGMENT)
    table_ = np.ascontiguousarray(model.emit.T)
    for low in range(0, rows, SIDE_BY_SIDE):
        part = slice(low, low + SIDE_BY_SIDE)
        c, new, true = padded[part].T, fresh[part].T, real[part].T
        e = table_[c]
        alpha, scale = np.empty_like(e), np.empty(c.shape)
        for t in range(SEGMENT):
            prior = alpha[t - 1] @ model.move if t else np.broadcast_to(model.met, e[0].shape)
            a = np.where(new[t][:, None], model.start, prior) * e[t]
            scale[t] = a.sum(axis=1)
            alpha[t] = a / scale[t][:, None]
        loglik += float(np.log(scale[true]).sum())
        beta = np.ones_like(e[0])
        gamma = np.empty_like(e)
        for t in range(SEGMENT - 1, -1, -1):
            gamma[t] = alpha[t] * beta
            if t:
                ahead = e[t] * beta / scale[t][:, None]
                on = ~new[t] & true[t]
                moves += model.move * (alpha[t - 1][on].T @ ahead[on])
                beta = np.where(new[t][:, None], 1.0, ahead @ model.move.T)
        gamma /= gamma.sum(axis=2, keepdims=True)
        starts += gamma[new & true].sum(axis=0)
        where = c[true]
        for i in range(k):
            emits[:, i] += np.bincount(where, weights=gamma[..., i][true], minlength=CLASSES)
    return emits, moves, starts, loglik


def _expect(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for r in range(batch.num_rows):
                held, sizes = (c[r].values.to_numpy(zero_copy_only=False) for c in batch.columns[:2])
                classes = _numbers(batch.column(2)[r].as_buffer(), "i2")
                run_of = classes[np.repeat(~held.astype(bool), sizes)]
                if len(run_of):
                    found = expected_counts(model, run_of)
                    total = found if total is None else tuple(a + b for a, b in zip(total, found, strict=True))
        if total is not None:
            emits, moves, starts, _ = total
            rows = np.vstack([emits, moves, starts[None]])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(rows)))] + [pa.array(rows[:, i].copy()) for i in range(rows.shape[1])],
                ["i"] + [f"s{i}" for i in range(rows.shape[1])],
            )

    return run


def train(measured: DataFrame, n: Counted, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over all training texts: expected counts are summed over the partitions.

    What is collected is as large as the model: states times (classes + states + 1) numbers.
    """
    model = first_model(n.class_tokens, states)
    share = (n.class_tokens + 1.0) / (n.class_tokens + 1.0).sum()
    names = [f"s{i}" for i in range(states)]
    for _ in range(rounds if n.texts else 0):
        found = (
            measured.select("held", "sizes", "classes")
            .mapInArrow(_expect(model), "i long, " + ", ".join(f"{s} double" for s in names))
            .groupBy("i")
            .agg(*[F.sum(s).alias(s) for s in names])
            .collect()
        )
        sums = np.zeros((CLASSES + states + 1, states))
        for r in found:
            sums[r["i"]] = r[1:]
        emits = sums[:CLASSES].T + 20.0 * share
        moves, starts = sums[CLASSES:-1] + 1.0, sums[-1] + 1.0
        met = sums[:CLASSES].sum(axis=0) + 1.0
        model = Model(
            starts / starts.sum(),
            moves / moves.sum(axis=1, keepdims=True),
            emits / emits.sum(axis=1, keepdims=True),
            met / met.sum(),
        )
    return model


def log_likelihoods(model: Model, classes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """log10 of each text's probability by the scaled forward recursion, all texts in step."""
    order = np.argsort(-sizes, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    lengths = sizes[order]
    emit = np.ascontiguousarray(model.emit.T)
    out = np.zeros(len(sizes))
    if not len(sizes):
        return out
    alpha = np.broadcast_to(model.start, (len(sizes), len(model.start)))
    running = np.searchsorted(-lengths, -np.arange(int(lengths[0])), side="left")
    for t, m in enumerate(running):
        prior = alpha if t == 0 else alpha[:m] @ model.move
        alpha = prior[:m] * emit[classes[starts[:m] + t]]
        scale = alpha.sum(axis=1)
        alpha /= scale[:, None]
        out[:m] += np.log10(scale)
    back = np.empty_like(out)
    back[order] = out
    return back


def _score(model: Model, total: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, held, sizes, base, inner, known = (c[r].values for c in batch.columns[:-1])
                n = sizes.to_numpy()
                classes = _numbers(batch.column(6)[r].as_buffer(), "i2")
                score = log_likelihoods(model, classes, n) + inner.to_numpy()
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        held,
                        pa.array(n.astype(np.int64)),
                        known,
                        pa.array(np.full(len(n), total, np.int64)),
                        base,
                        pa.array(score),
                    ],
                    ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
                )

    return run


def score_documents(docs: DataFrame, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """Log-probability of each whole text under a unigram and under a hidden Markov model.

    ``docs`` has doc_id and text; other columns are ignored. Texts whose id has the remainder 2
    (crc32 of its digits, mod 7) are held out, all others train. The model's states emit word classes:
    each of the most frequent words is one, all other words share classes by their ending; within a
    class a word has its share of the training count, with one part left for unknown words. So the
    vocabulary stays a distributed table and the model bounded. Texts are coded once in blocks; their
    distinct words are shuffled once to be counted, and what is known of them comes to their block in
    rows of numbers, so that a task holds one block at a time.

    Returns doc_id, held_out, n_tokens (with the end), n_known, train_tokens, base_score, score; a
    row for each row. NULL and empty texts are the end alone; rows without id train; repeated rows
    count as often as they occur; empty gives empty.
    """
    spark = docs.sparkSession
    with lean(spark, TEXTS):
        blocks = stored(
            docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
                _code,
                "block long, pos int, word binary, n long, doc_ids array<long>, held array<boolean>, "
                "sizes array<int>, tokens binary, endings binary",
            ),
            "blocks",
        )
    words = blocks.where("word IS NOT NULL").select("word", "block", "pos", "n")
    blocks = blocks.where("tokens IS NOT NULL").select("block", "doc_ids", "held", "sizes", "tokens", "endings")
    of_word = Window.partitionBy("word")  # a row for each block that has the word, at most
    with lean(spark):
        pairs = stored(
            words.select(
                "word",
                "block",
                "pos",
                F.sum("n").over(of_word).alias("c"),
                (F.col("block") == F.min("block").over(of_word)).alias("first"),
            ),
            "words",
        )
    counts = pairs.where("first").select("word", "c")
    top = (
        counts.where("c > 0")
        .orderBy(F.col("c").desc(), "word")
        .limit(FREQUENT)
        .collect()
    )
    frequent = spark.createDataFrame(
        pa.table([pa.array([r["word"] for r in top], pa.binary()), pa.array(range(len(top)), pa.int32())], ["word", "own"])
    )
    ending = F.lit(FREQUENT) + F.pmod(F.crc32(F.substring("word", -3, 3)), F.lit(ENDINGS))
    marked = counts.join(F.broadcast(frequent), "word", "left")  # FREQUENT rows at most
    classed = marked.select("c", F.coalesce("own", ending.cast("int")).alias("class"))
    texts = blocks.select(F.size(F.filter("held", lambda h: ~h)).alias("n")).agg(F.sum("n")).first()[0] or 0
    class_tokens, class_words = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
    for r in (
        classed.groupBy("class")
        .agg(F.sum("c").alias("c"), F.count(F.when(F.col("c") > 0, 1)).alias("v"))
        .collect()
    ):
        class_tokens[r["class"]], class_words[r["class"]] = r["c"], r["v"]
    class_tokens[END_CLASS], class_words[END_CLASS] = texts, int(texts > 0)
    n = Counted(int(class_tokens.sum()), int(class_words.sum()), texts, class_tokens, class_words)
    known = F.coalesce(F.col("own") + F.lit(OWN), F.col("c"))
    looked_up = (
        pairs.join(F.broadcast(frequent), "word", "left")
        .select("block", "pos", known.alias("known"))
        .mapInArrow(_placed, "block long, found binary")
    )
    with lean(spark):
        measured = stored(
            blocks.unionByName(looked_up, allowMissingColumns=True)
            .groupBy("block")
            .applyInArrow(
                _measure(n),
                "block long, doc_ids array<long>, held array<boolean>, sizes array<int>, "
                "classes binary, base array<double>, inner array<double>, known array<long>",
            ),
            "measured",
        )
    dropped(blocks)
    dropped(pairs)
    model = train(measured, n, states, rounds)
    return measured.select("doc_ids", "held", "sizes", "base", "inner", "known", "classes").mapInArrow(
        _score(model, n.total),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )


@query()
def op3_markov_scores(spark, sf_dir):
    return score_documents(table(spark, sf_dir, "documents"))
