"""License scans: an exact set-similarity join of text blocks with license templates."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import query, stored, table

PERCENT = 80  # share of a template's different words that a block must hold
TEMPLATE_WORDS = 100_000  # words of all templates together, which bounds what is broadcast

# Phrases whose words have to stand one after the other, and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# Notices as public licenses ask to have them reproduced, and common ways to name one.
TEMPLATES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except "
     "in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation; either version 2 of the License, or (at "
     "your option) any later version."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
     "General Public License as published by the Free Software Foundation, either version 3 of the License, or (at "
     "your option) any later version."),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
     "Lesser General Public License as published by the Free Software Foundation"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
     "associated documentation files (the Software), to deal in the Software without restriction, including without "
     "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
     "Software"),
    ("mit", "Released under the MIT License."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
     "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
     "that the following conditions are met: Redistributions of source code must retain the above copyright notice, "
     "this list of conditions and the following disclaimer."),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of "
     "the MPL was not distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-sa-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
     "License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
)

# A-Z lowered; letters, digits and all bytes beyond ASCII stay, the rest parts words.
_PLAIN = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def text_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_PLAIN).split()


@dataclass(frozen=True)
class Template:
    label: str
    number: int  # its place in the list
    words: frozenset[bytes]
    span: int  # words of a block's half: the next power of two from its length, repeats counted
    need: int  # words that a block must share with it


def templates_of(templates: Sequence[tuple[str, str]], percent: int) -> list[Template]:
    out = []
    for label, text in templates:
        words = text_words(text)
        if not words:
            raise ValueError(f"a template for {label!r} has no words")
        different = frozenset(words)
        span = 1 << (len(words) - 1).bit_length()
        out.append(Template(label, len(out), different, span, -(-percent * len(different) // 100)))
    if sum(len(t.words) for t in out) > TEMPLATE_WORDS:
        raise ValueError(f"templates have more than {TEMPLATE_WORDS} words")
    return out


def phrase_places(words: list[bytes], phrases: Sequence[tuple[str, str]]) -> tuple[list[str], int, int, int]:
    """Labels, number of places, smallest and largest start of phrases in a text's words."""
    whole = b" " + b" ".join(words) + b" "
    labels, places, first, last = set(), 0, None, None
    for phrase, label in phrases:
        wanted = b" " + b" ".join(text_words(phrase)) + b" "
        at, seen, start = whole.find(wanted), 0, 0
        while at >= 0:
            start += whole.count(b" ", seen, at)  # words between one place and the next
            seen, places = at, places + 1
            first = start if first is None else min(first, start)
            last = start if last is None else max(last, start)
            labels.add(label)
            at = whole.find(wanted, at + 1)
    return sorted(labels), places, first, last


SCANNED = (
    "n_words long, n_base long, first_word long, last_word long, base_labels array<string>, "
    "blocks array<struct<span: int, block: long, words: array<int>>>"
)


def _scanned(parsed: list[Template], phrases):
    names = sorted(set().union(*(t.words for t in parsed)))
    number = {w: i for i, w in enumerate(names)}
    spans = {}
    for t in parsed:
        own, least = spans.get(t.span, (frozenset(), t.need))
        spans[t.span] = (own | {number[w] for w in t.words}, min(least, t.need))

    def blocks_of(words: list[bytes]) -> list[dict]:
        """Blocks of two spans, one beginning at each span, that share enough words to hold a template."""
        hits = [(i, number[w]) for i, w in enumerate(words) if w in number]
        out = []
        for span, (own, least) in spans.items():
            halves: dict[int, set[int]] = {}
            for i, w in hits:
                if w in own:
                    halves.setdefault(i // span, set()).add(w)
            for b in {b for h in halves for b in (h - 1, h) if b >= 0}:
                held = halves.get(b, set()) | halves.get(b + 1, set())
                if len(held) >= least:
                    out.append({"span": span, "block": b, "words": sorted(held)})
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.struct([("span", pa.int32()), ("block", pa.int64()), ("words", pa.list_(pa.int32()))])
        for batch in batches:
            sizes, bases, blocks = [], [], []
            for text in batch.column(0).to_pylist():
                words = text_words(text)
                sizes.append(len(words))
                bases.append(phrase_places(words, phrases))
                blocks.append(blocks_of(words))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[1:],
                    pa.array(sizes, pa.int64()),
                    *(pa.array([b[i] for b in bases], pa.int64()) for i in (1, 2, 3)),
                    pa.array([b[0] for b in bases], pa.list_(pa.string())),
                    pa.array(blocks, pa.list_(block)),
                ],
                [*batch.schema.names[1:], "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"],
            )

    return run, names


def scanned_texts(docs: DataFrame, parsed: list[Template], phrases=PHRASES) -> tuple[DataFrame, list[bytes]]:
    """doc_id, row and what SCANNED lists, stored; and the words that blocks name by number."""
    run, names = _scanned(parsed, phrases)
    texts = docs.select("text", "doc_id", F.monotonically_increasing_id().alias("row"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return stored(texts.mapInArrow(run, f"doc_id {kind}, row long, {SCANNED}"), "scanned"), names


def matched_blocks(scanned: DataFrame, parsed: list[Template], names: list[bytes]) -> DataFrame:
    """All pairs of a block and a template of its span that share the words needed: an exact join.

    Words are ordered by the number of blocks that hold them, rare ones first (their counts are one
    for each template word, whatever the table). If a block of b words and a template of t share n,
    the first t - n + 1 words of the one and the first b - n + 1 of the other have one in common;
    what may follow it must still make n. Blocks too short for any template of their span were not
    kept. A pair is taken at its first common word only, so no pair arrives twice.

    Returns row, doc_id, label, first_word, n_words (of the block), containment.
    """
    spark = scanned.sparkSession
    blocks = scanned.select("row", "doc_id", F.col("n_words").alias("all_words"), F.explode("blocks").alias("b"))
    blocks = blocks.select("row", "doc_id", "all_words", "b.*")
    counts = {
        r["word"]: r["n"]
        for r in blocks.select(F.explode("words").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()
    }
    rank = [0] * len(names)
    for place, w in enumerate(sorted(range(len(names)), key=lambda w: (counts.get(w, 0), w))):
        rank[w] = place
    at = {w: i for i, w in enumerate(names)}
    least = {t.span: min(x.need for x in parsed if x.span == t.span) for t in parsed}
    rows = []
    for t in parsed:
        words = sorted(rank[at[w]] for w in t.words)
        for i, w in enumerate(words[: len(words) - t.need + 1]):
            rows.append((t.span, w, i, t.label, t.need, words))
    prefixes = F.broadcast(  # at most TEMPLATE_WORDS rows
        spark.createDataFrame(
            rows, "span int, word int, place int, label string, need int, template array<int>"
        )
    )
    ranks = F.array(*(F.lit(x) for x in rank))
    sharing = F.coalesce(*(F.when(F.col("span") == s, n) for s, n in least.items()))
    ordered = blocks.withColumn("words", F.sort_array(F.transform("words", lambda w: F.get(ranks, w))))
    begun = ordered.select("*", F.posexplode(F.slice("words", 1, F.size("words") - sharing + 1)).alias("here", "word"))
    rest = F.least(F.size("template") - F.col("place"), F.size("words") - F.col("here"))
    common = F.array_intersect("words", "template")
    paired = (
        begun.join(prefixes, ["span", "word"])
        .where((F.size("words") >= F.col("need")) & (rest >= F.col("need")))
        .withColumn("common", common)
        .where((F.size("common") >= F.col("need")) & (F.get("common", F.lit(0)) == F.col("word")))
    )
    first = F.col("block") * F.col("span")
    return paired.select(
        "row",
        "doc_id",
        "label",
        first.alias("first_word"),
        F.least(F.lit(2) * F.col("span"), F.col("all_words") - first).alias("n_words"),
        (F.size("common") / F.size("template")).alias("containment"),
    )


def license_blocks(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, percent: int = PERCENT
) -> DataFrame:
    """The blocks of texts that hold a template: doc_id, label, first_word, n_words, containment.

    ``docs`` has doc_id and text; ``templates`` are pairs of a label and a text. A template of m
    words is sought in blocks of twice the next power of two, which begin at each multiple of that
    power, so any m words that follow each other lie in one block. A block holds a template if it
    has ``percent`` of its different words. NULL and empty texts hold none; repeated rows give
    their blocks each; rows without id are as any other; an empty table gives an empty one.
    """
    parsed = templates_of(templates, percent)
    scanned, names = scanned_texts(docs, parsed)
    return matched_blocks(scanned, parsed, names).drop("row")


def licensed_documents(
    docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, percent: int = PERCENT
) -> DataFrame:
    """Labels of each document: of phrases that stand in it, and of templates that its blocks hold.

    Returns doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score; a row for each
    row. The score is the greatest share of a template found, 1 where a phrase stands, else 0. NULL
    and empty texts have no words, no labels and a score of 0. See ``license_blocks``.
    """
    parsed = templates_of(templates, percent)
    scanned, names = scanned_texts(docs, parsed)
    found = matched_blocks(scanned, parsed, names)
    held = found.groupBy("row").agg(F.collect_set("label").alias("more"), F.max("containment").alias("most"))
    texts = scanned.drop("blocks").join(held, "row", "left")
    both = F.array_union("base_labels", F.coalesce("more", F.array().cast("array<string>")))
    return texts.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join(F.sort_array(both), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("most", F.lit(0.0))).alias("score"),
    )


def _sql() -> str:
    """The same without order, prefixes or filters: every block against every template."""
    words = lambda text: "[" + ", ".join(f"'{w.decode()}'" for w in text_words(text)) + "]"
    parsed = templates_of(TEMPLATES, PERCENT)
    known = ", ".join(
        f"({t.number}, '{t.label}', {t.span}, {t.need}, list_distinct({words(text)}))"
        for t, (_, text) in zip(parsed, TEMPLATES, strict=True)
    )
    phrases = ", ".join(f"('{label}', {words(phrase)})" for phrase, label in PHRASES)
    return f"""
WITH templates(number, label, span, need, t) AS (VALUES {known}),
phrases(label, p) AS (VALUES {phrases}),
texts AS MATERIALIZED (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents
), places AS (
  SELECT r, label, unnest(list_filter(range(len(w)), lambda i: w[i + 1 : i + len(p)] = p)) AS i FROM texts, phrases
), base AS (
  SELECT r, count(*) AS n, min(i) AS first, max(i) AS last, list_sort(list(DISTINCT label)) AS labels
  FROM places GROUP BY r
), blocks AS (
  SELECT r, span, w[b * span + 1 : (b + 2) * span] AS words
  FROM (SELECT r, w, span, unnest(range(len(w) // span + 1)) AS b
    FROM texts, (SELECT DISTINCT span FROM templates))
), held AS (
  SELECT r, list(DISTINCT label) AS labels, max(shared / len(t)) AS score FROM (
    SELECT r, label, t, need, len(list_intersect(list_distinct(words), t)) AS shared FROM blocks JOIN templates USING (span))
  WHERE shared >= need GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base,
  CAST(first AS BIGINT) AS first_word, CAST(last AS BIGINT) AS last_word,
  coalesce(array_to_string(b.labels, ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(h.labels, [])))), ','), '')
    AS labels,
  CAST(CASE WHEN n > 0 THEN 1 ELSE coalesce(score, 0) END AS DOUBLE) AS score
FROM texts LEFT JOIN base b USING (r) LEFT JOIN held h USING (r)
"""


@query(_sql())
def op12_license_scan(spark, sf_dir):
    return licensed_documents(table(spark, sf_dir, "documents"))
