"""Token counts by a linear longest-match automaton: no piece is ever built."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import query, table

VOCABULARY = "word_bpe_49k.json"
END = 256  # the symbol after a word's last byte
WORDS_KEPT = 600_000


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte, by the public rule.

    Bytes that print stand for themselves; the others follow from code point 256 on, in order.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def vocabulary_pieces(path: str) -> tuple[list[tuple[int, ...]], str]:
    """Pieces as symbols (bytes, then END where a piece ends its word) and the pattern of words."""
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    letters, suffix = byte_letters(), file["model"]["end_of_word_suffix"] or ""
    special = {t["content"] for t in file["added_tokens"]}
    pieces = []
    for token in file["model"]["vocab"]:
        if token not in special:
            ends = bool(suffix) and token.endswith(suffix)
            body = token[: -len(suffix)] if ends else token
            pieces.append((*(letters[c] for c in body), *([END] if ends else [])))
    steps = file["pre_tokenizer"]["pretokenizers"]
    return pieces, next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")


class LongestMatch:
    """A trie whose nodes know where to go on when no child fits, and what that completes.

    If a node's text is a piece, going on pops one piece and starts afresh. Else the longest piece
    at its begin is popped, and the rest is walked from the root, which may pop more; the node that
    it ends in is the failure link. Built breadth first, each link from its parent's. A word then
    takes at most two steps a symbol, and its count is the sum of the counts popped.
    """

    def __init__(self, pieces: list[tuple[int, ...]]):
        self.goto: list[dict[int, int]] = [{}]
        is_piece = [False]
        for piece in pieces:
            node = 0
            for s in piece:
                if s not in self.goto[node]:
                    self.goto[node][s] = len(self.goto)
                    self.goto.append({})
                    is_piece.append(False)
                node = self.goto[node][s]
            is_piece[node] = True
        n = len(self.goto)
        self.link, self.popped = [-1] * n, [0] * n  # -1: no text can go on there
        queue = deque([0])
        while queue:
            parent = queue.popleft()
            for s, node in self.goto[parent].items():
                queue.append(node)
                if is_piece[node]:
                    self.link[node], self.popped[node] = 0, 1
                    continue
                z, more = self.link[parent], self.popped[parent]
                while z >= 0 and s not in self.goto[z]:
                    more += self.popped[z]
                    z = self.link[z]
                if z >= 0:
                    self.link[node], self.popped[node] = self.goto[z][s], more

    def count(self, word: bytes) -> int:
        """Pieces of a word by greedy longest match; 1 (an unknown word) if there are none."""
        goto, link, popped = self.goto, self.link, self.popped
        node = n = 0
        for s in word:
            while s not in goto[node]:
                n += popped[node]
                node = link[node]
                if node < 0:
                    return 1
            node = goto[node][s]
        while END not in goto[node]:
            if node == 0:
                return n  # the last piece has no form that ends a word
            n += popped[node]
            node = link[node]
            if node < 0:
                return 1
        return n + 1


class _Counts(dict):
    """Words and pieces of what stands between blanks, as one number: words * 2^32 + pieces."""

    def __init__(self, path: str):
        pieces, pattern = vocabulary_pieces(path)
        self.automaton, self.pattern = LongestMatch(pieces), regex.compile(pattern)

    def __missing__(self, part: str) -> int:
        if len(self) >= WORDS_KEPT:
            self.clear()
        n = 0
        for w in [part] if part.isascii() and part.isalpha() else self.pattern.findall(part):
            n += (1 << 32) + self.automaton.count(w.encode())
        self[part] = n
        return n


_known: dict[str, _Counts] = {}


def _count(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _known.get(path) or _known.setdefault(path, _Counts(path))
        for batch in batches:
            sums = [
                sum(map(known.__getitem__, (t or "").lower().split()))
                for t in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([s >> 32 for s in sums], pa.int64()),
                    pa.array([s & 0xFFFFFFFF for s in sums], pa.int64()),
                ],
                ["doc_id", "n_words", "n_tokens"],
            )

    return run


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """Words and word pieces of each whole text, lower-cased, by greedy longest match.

    ``docs`` has doc_id and text; other columns are ignored. Words are the matches of the
    vocabulary's own pattern; a piece that the vocabulary marks as a word's end only fits there, and a
    word may also end with a piece that has no such form.
    Returns doc_id, n_words, n_tokens; a row for each row. NULL and empty texts have 0; a word that
    the pieces can't make counts 1; NULL ids and repeated rows are as any other; empty gives empty.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text")).mapInArrow(
        _count(public_tokenizers.path(vocabulary)), f"doc_id {kind}, n_words long, n_tokens long"
    )


@query()
def op7_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"))
