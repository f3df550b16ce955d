"""Coding of texts by their different parts: what a byte-level BPE makes of one is fixed."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Beyond what Python calls white space: a cut beside them is not relied on.
INVISIBLE = frozenset("᠎​⁠﻿")


def _open(c: str) -> bool:
    return c.isspace() or c in INVISIBLE


def chunks(text: str) -> list[str]:
    """Cuts a text before single spaces between two characters that are no white space.

    The public pattern cuts there too, since a match can begin with one space and hold none later
    unless it holds nothing but white space. So what is made of the chunks, put together, is what
    is made of the text.
    """
    parts = text.split(" ")
    out, run = [], [parts[0]]
    for last, part in zip(parts, parts[1:], strict=False):
        if not last or not part or _open(last[-1]) or _open(part[0]):
            run.append(part)
        else:
            out.append(" ".join(run))
            run = ["", part]
    out.append(" ".join(run))
    return out


# Parts of a text between single spaces. A cut before such a space is sure if neither side has white
# space there; then what is made of the parts, put together, is what is made of the text.
_WHITE = (
    "\\x{9}-\\x{D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{180E}\\x{2000}-\\x{200B}\\x{2028}\\x{2029}\\x{202F}"
    "\\x{205F}\\x{2060}\\x{3000}\\x{FEFF}"
)
_UNSURE = f"^$|^[{_WHITE}]|[{_WHITE}]$"
_END_UNSURE = f"^$|[{_WHITE}]$"
_LATIN = "^[\\x{0}-\\x{24F}]*$"  # every library knows the letters up to here
_MARKED = "[.,;:!?)]$"  # a mark that is a piece of its own between a word and a blank

KNOWN_WORDS = 600_000  # words that a coder remembers

# Lists of numbers: all of them one behind the other, and how many belong to each.
Lists = tuple[np.ndarray, np.ndarray]


class Pool:
    """Lists by where they begin and how long they are."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.size = 0

    def put(self, lists: Lists) -> np.ndarray:
        """Adds lists; returns their begins."""
        values, sizes = lists
        begins = self.size + np.cumsum(sizes) - sizes
        self.parts.append(values)
        self.size += len(values)
        return begins

    def taken(self, begins: np.ndarray, sizes: np.ndarray) -> Lists:
        """Lists in the given order."""
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        kind = np.int32 if max(total, self.size) < 1 << 31 else np.int64
        at = np.repeat((begins - (ends - sizes)).astype(kind), sizes)
        at += np.arange(total, dtype=kind)
        return np.concatenate(self.parts)[at], sizes


def ordered(lists: Lists, places: np.ndarray) -> Lists:
    pool = Pool()
    begins = pool.put(lists)
    return pool.taken(begins[places], lists[1][places])


def grouped(lists: Lists, groups: np.ndarray) -> Lists:
    """Neighbouring lists as one: ``groups`` says how many of them."""
    ends = np.concatenate([[0], np.cumsum(lists[1])])
    return lists[0], np.diff(ends[np.concatenate([[0], np.cumsum(groups)])])


class TextCoder:
    """Codes whole texts, each different part of a batch once, and known words not at all.

    A code may have several lists, as ids and bytes. Subclasses state how texts are coded (``each``:
    for each list of a code, those of all texts), and how sure parts behind a space are (``spaced``).
    """

    special: Sequence[str] = ()  # texts with one of these are coded as wholes

    def __init__(self):
        self.known: pa.Array | None = None
        self.codes: list[Lists] = []

    def each(self, texts: list[str]) -> list[Lists]:
        raise NotImplementedError

    def spaced(self, parts: pa.Array, words: bool) -> list[Lists]:
        raise NotImplementedError

    def texts(self, texts: pa.Array) -> list[Lists]:
        """The codes of texts; NULL is an empty text.

        A text with a cut that is not sure is cut where cuts are sure.
        """
        if not len(texts):
            return self.each([])
        texts = pc.fill_null(texts.cast(pa.string()), "")
        cut = pc.split_pattern(texts, " ")
        offsets = cut.offsets.to_numpy().astype(np.int64)
        offsets, flat = offsets - offsets[0], cut.flatten()
        firsts, counts = offsets[:-1], np.diff(offsets)
        coded = flat.dictionary_encode()
        places = coded.indices.to_numpy().astype(np.int64)
        unsure, parts = self._parts(coded.dictionary)

        begin = flat.take(pa.array(firsts))
        doubt = unsure[places]
        doubt[firsts] = pc.match_substring_regex(begin, _END_UNSURE).to_numpy(False) & (counts > 1)
        odd = np.add.reduceat(doubt, firsts) > 0
        for s in self.special:
            odd |= pc.match_substring(texts, s).to_numpy(False)
        hidden = np.repeat(odd, counts)
        plain, at = np.flatnonzero(~odd), np.flatnonzero(odd)
        heads = self.each(begin.take(pa.array(plain)).to_pylist())
        wholes = self._odd([texts[i].as_py() for i in at.tolist()])
        out = []
        for part, head, whole in zip(parts, heads, wholes, strict=True):
            pool = Pool()
            begins, sizes = pool.put(part)[places], np.where(hidden, 0, part[1][places])
            begins[firsts[plain]], sizes[firsts[plain]] = pool.put(head), head[1]
            begins[firsts[at]], sizes[firsts[at]] = pool.put(whole), whole[1]
            out.append(grouped(pool.taken(begins, sizes), counts))
        return out

    def _parts(self, parts: pa.Array) -> tuple[np.ndarray, list[Lists]]:
        """Which parts are not sure, and the codes of the others."""
        mask = lambda p: pc.match_substring_regex(parts, p).to_numpy(False)
        some = lambda m: parts.filter(pa.array(m))
        unsure, latin = mask(_UNSURE), mask(_LATIN)
        word = pc.utf8_is_alpha(parts).to_numpy(False) & latin
        stems = pc.utf8_slice_codeunits(parts, 0, -1)
        marked = mask(_MARKED) & latin & pc.utf8_is_alpha(stems).to_numpy(False)
        rest = ~(word | marked | unsure)
        stems = stems.filter(pa.array(marked))
        words = pc.unique(pa.concat_arrays([some(word), stems]))
        marks = pc.utf8_slice_codeunits(some(marked), -1).dictionary_encode()
        place = lambda x: pc.index_in(x, words).to_numpy(False)
        own, stem, mark = place(some(word)), place(stems), marks.indices.to_numpy()
        out = []
        for w, m, r in zip(
            self._words(words), self.each(marks.dictionary.to_pylist()), self.spaced(some(rest), False), strict=True
        ):
            pool = Pool()
            begins, sizes = np.zeros((2, len(parts)), np.int64), np.zeros((2, len(parts)), np.int64)
            at = pool.put(w)
            begins[0, word], sizes[0, word] = at[own], w[1][own]
            begins[0, marked], sizes[0, marked] = at[stem], w[1][stem]
            begins[1, marked], sizes[1, marked] = pool.put(m)[mark], m[1][mark]
            begins[0, rest], sizes[0, rest] = pool.put(r), r[1]
            out.append(grouped(pool.taken(begins.T.ravel(), sizes.T.ravel()), np.full(len(parts), 2)))
        return unsure, out

    def _words(self, words: pa.Array) -> list[Lists]:
        if self.known is None:
            self.known, self.codes = words.slice(0, 0), self.spaced(words.slice(0, 0), True)
        at = pc.index_in(words, self.known)
        fresh = pc.is_null(at).to_numpy(False)
        new = words.filter(pa.array(fresh))
        at = pc.fill_null(at, 0).to_numpy(False).astype(np.int64)
        at[fresh] = len(self.known) + np.arange(len(new))
        self.known = pa.concat_arrays([self.known, new])
        self.codes = [
            tuple(np.concatenate(x) for x in zip(a, b, strict=True))
            for a, b in zip(self.codes, self.spaced(new, True), strict=True)
        ]
        out = [ordered(c, at) for c in self.codes]
        if len(self.known) > KNOWN_WORDS:
            self.known, self.codes = words, out
        return out

    def _odd(self, texts: list[str]) -> list[Lists]:
        cut = [[t] if any(s in t for s in self.special) else chunks(t) for t in texts]
        number = {c: i for i, c in enumerate(dict.fromkeys(c for x in cut for c in x))}
        at = np.array([number[c] for x in cut for c in x], np.int64)
        groups = np.array([len(x) for x in cut], np.int64)
        return [grouped(ordered(lists, at), groups) for lists in self.each(list(number))]


def slices_of(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """Slices of texts that have about ``most`` characters together."""
    begin = total = 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(texts), 0).to_pylist()):
        total += n
        if total >= most:
            yield begin, i + 1
            begin, total = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)
