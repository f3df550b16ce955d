"""Language of web pages: text, declared language, address and host, fused by Bayes' rule."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import query, stored, table

GRAMS = 64**3  # letter classes in a row of three: bounds the text model
STRENGTH = 4.0  # pages that a wider level of the host hierarchy counts for
OVERLAP = 3.0  # each letter is in three trigrams; their evidence is not independent

_OPENS = re.compile(r"(?i)<(?:(script|style)\b|!--)")
_CLOSES = {
    "script": re.compile(r"(?i)</script\s*+>"), "style": re.compile(r"(?i)</style\s*+>"), "": re.compile("-->"),
}
_HTML = re.compile(r"(?i)<html\b")
_LANG = re.compile(r"""(?i)\blang\s*+=\s*+["']?\s*+([a-z]{2,3})\b""")
_CODE = re.compile(r"/([a-z]{2})(?:/|$)")


def _classes() -> np.ndarray:
    """Each byte as one of 64 classes: blanks and signs 0, letters, UTF-8 lead bytes, the others."""
    table_ = np.zeros(256, np.int64)
    for c in range(26):
        table_[ord("a") + c] = table_[ord("A") + c] = c + 1
    table_[0x80:0xC0] = 27 + np.arange(64) % 32
    table_[0xC0:] = 59 + np.arange(64) % 5
    return table_


_TABLE = _classes()


def grams(text: str) -> np.ndarray:
    """Class trigrams of a text; runs of blanks and signs count as one, trigrams of them not."""
    c = _TABLE[np.frombuffer(text.encode(), np.uint8)]
    c = c[np.concatenate([[True], (c[1:] != 0) | (c[:-1] != 0)])] if len(c) else c
    return c[:-2] * 4096 + c[1:-1] * 64 + c[2:] if len(c) >= 3 else np.empty(0, np.int64)


def _counted(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {x: np.zeros(GRAMS, np.int64) for x in languages}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                g = grams(text)
                if len(g) > GRAMS // 16:
                    sums[lang] += np.bincount(g, minlength=GRAMS)
                else:
                    np.add.at(sums[lang], g, 1)
        for i, n in enumerate(sums.values()):
            at = np.nonzero(n)[0]
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), i, np.int32)), pa.array(at.astype(np.int32)), pa.array(n[at])],
                    ["language", "gram", "n"],
                )

    return run


def text_model(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities (GRAMS x languages), from texts with a language.

    Counts are summed per partition and then by Spark. The collected model is bounded by the number
    of letter classes and languages, whatever the corpus.
    """
    known = docs.select("lang", "text").where("lang IS NOT NULL AND text IS NOT NULL")
    languages = [r[0] for r in known.select("lang").distinct().orderBy("lang").collect()]
    counts = np.zeros((GRAMS, len(languages)))
    if languages:
        for r in (
            known.mapInArrow(_counted(languages), "language int, gram int, n long")
            .groupBy("language", "gram")
            .agg(F.sum("n").alias("n"))
            .toLocalIterator()
        ):
            counts[r["gram"], r["language"]] = r["n"]
    seen = counts.sum(axis=1) > 0
    counts = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * max(1, seen.sum())))
    return languages, counts.astype(np.float32)


def visible_text(html: str) -> str:
    """The text without scripts, styles, comments and tags, a blank for each.

    One pass, whatever is left open: an end that is not found once is not sought again. What has no
    end hides nothing but its own tag, and a tag that has none is text.
    """
    out, i, endless = [], 0, set()
    while (j := html.find("<", i)) >= 0:
        out.append(html[i:j])
        end = None
        if opened := _OPENS.match(html, j):
            kind = (opened[1] or "").lower()
            if kind not in endless:
                closed = _CLOSES[kind].search(html, opened.end())
                end = closed and closed.end()
                if closed is None:
                    endless.add(kind)
        if end is None and ">" not in endless:
            end = html.find(">", j) + 1 or None
            if end is None:
                endless.add(">")
        out.append("<" if end is None else " ")
        i = end or j + 1
    out.append(html[i:])
    return "".join(out)


def declared_language(html: str) -> str | None:
    """``lang`` of the first html tag that has one."""
    for opened in _HTML.finditer(html):
        end = html.find(">", opened.end())
        end = len(html) if end < 0 else end
        if found := _LANG.search(html, opened.end(), end):
            return found[1].lower()
        if end == len(html):
            return None  # the tag is not closed: later ones lie within it
    return None


def page_parts(url: str | None, html: str | None) -> tuple[str, str | None, str | None, str | None, str | None]:
    """Visible text, declared language, host, address suffix, language code in the path."""
    html = html or ""
    try:
        address = urlsplit(url or "")
        host = address.hostname
    except ValueError:
        address, host = None, None
    suffix = host.rpartition(".")[2] if host else None
    code = _CODE.match(address.path.lower()) if address else None
    return (
        unescape(visible_text(html)),
        declared_language(html),
        host,
        suffix,
        code and code[1],
    )


def _evidence(model: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = model.shape[1]
        for batch in batches:
            rows, logs, sizes = [], [], []
            for url, html in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                text, *parts = page_parts(url, html)
                g = grams(text)
                rows.append(parts)
                sizes.append(len(g))
                logs.append(model[g].sum(axis=0, dtype=np.float64) / OVERLAP)
            flat = np.concatenate(logs) if logs else np.empty(0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array([r[i] for r in rows], pa.string()) for i in range(4)),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * k, pa.int32()), pa.array(flat)),
                ],
                ["page_id", "declared", "host", "suffix", "code", "n_grams", "logs"],
            )

    return run


def identify_pages(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """The most probable language of every page, from four kinds of evidence.

    ``pages`` has page_id, url and html, ``docs`` lang and text; other columns are ignored.
    Text: trigram likelihoods learned from ``docs``. Declared language, address suffix and path code:
    how often pages of each language (by their text) show that value, smoothed towards the value's
    overall share. Host: the languages of its other pages, smoothed towards those of its domain (the
    last two labels), smoothed towards those of all pages. All counts are grouped aggregates, and the
    page itself is left out of those that judge it.

    Returns page_id, host, declared, text_lang, lang, confidence (posterior); a row for each row.
    Pages without text, address or declaration are judged by what is left, at last by the shares of
    all pages; NULL ids and repeated rows are as any other; lang is NULL if ``docs`` names no
    language; ties go to the language first in order; empty gives empty.
    """
    languages, model = text_model(docs)
    kind = pages.schema["page_id"].dataType.simpleString()
    if not languages:
        none = F.lit(None).cast("string")
        return pages.select(
            "page_id",
            *[none.alias(c) for c in ("host", "declared", "text_lang", "lang")],
            F.lit(None).cast("double").alias("confidence"),
        )
    seen = stored(
        pages.select("page_id", "url", "html").mapInArrow(
            _evidence(model),
            f"page_id {kind}, declared string, host string, suffix string, code string, "
            "n_grams long, logs array<double>",
        ),
        "evidence",
    )
    n = len(languages)
    seen = seen.withColumn(
        "guess",
        F.when(F.col("n_grams") > 0, F.array_position("logs", F.array_max("logs")).cast("int") - 1),
    ).withColumn(
        "domain", F.when(F.col("host").isNotNull(), F.substring_index("host", ".", -2))
    )
    counts = F.array(*[F.sum((F.col("guess") == i).cast("long")) for i in range(n)])
    tally = lambda rows: F.transform(rows, lambda x: F.coalesce(x, F.lit(0)).cast("double"))
    overall = seen.where("guess IS NOT NULL").agg(*[F.sum((F.col("guess") == i).cast("long")) for i in range(n)]).first()
    totals = [float(x or 0) for x in overall]
    total = sum(totals)
    shares = [(x + 1.0) / (total + n) for x in totals]

    def by(key: str, name: str) -> DataFrame:
        return (
            seen.where(F.col(key).isNotNull() & F.col("guess").isNotNull())
            .groupBy(F.col(key).alias(f"{name}_key"))
            .agg(tally(counts).alias(name))
        )

    hosts = by("host", "host_n").withColumn("of", F.substring_index("host_n_key", ".", -2))
    domains = (
        hosts.groupBy(F.col("of").alias("domain_n_key"))
        .agg(F.array(*[F.sum(F.get("host_n", F.lit(i))) for i in range(n)]).alias("domain_n"))
    )
    hosts = hosts.join(domains, F.col("of") == F.col("domain_n_key"), "left").select(
        "host_n_key", "host_n", "domain_n"
    )
    joined = seen.join(hosts, F.col("host") == F.col("host_n_key"), "left")
    for key in ("declared", "suffix", "code"):
        joined = joined.join(by(key, f"{key}_n"), F.col(key) == F.col(f"{key}_n_key"), "left")

    own = lambda i: (F.col("guess") == i).cast("double")
    mine = [F.coalesce(own(i), F.lit(0.0)) for i in range(n)]
    other = lambda c, i: F.greatest(F.coalesce(F.get(c, F.lit(i)), F.lit(0.0)) - mine[i], F.lit(0.0))
    add = lambda xs: sum(xs[1:], xs[0])
    posterior = []
    for i in range(n):
        score = F.get("logs", F.lit(i))
        domain_all = add([other("domain_n", j) for j in range(n)])
        domain = (other("domain_n", i) + STRENGTH * shares[i]) / (domain_all + STRENGTH)
        host_all = add([other("host_n", j) for j in range(n)])
        score += F.log((other("host_n", i) + STRENGTH * domain) / (host_all + STRENGTH))
        for key in ("declared", "suffix", "code"):
            c = f"{key}_n"
            share = (add([other(c, j) for j in range(n)]) + 1.0) / (total + 1.0)
            likely = F.log((other(c, i) + STRENGTH * share) / (totals[i] - mine[i] + STRENGTH))
            score += F.when(F.col(key).isNotNull(), likely).otherwise(0.0)
        posterior.append(score)
    names = F.array(*[F.lit(x) for x in languages])
    scored = joined.select(
        "page_id", "host", "declared", "guess", F.array(*posterior).alias("p")
    ).withColumn("best", F.array_max("p"))
    return scored.select(
        "page_id",
        "host",
        "declared",
        F.get(names, "guess").alias("text_lang"),
        F.element_at(names, F.array_position("p", F.col("best")).cast("int")).alias("lang"),
        (1 / F.aggregate("p", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("best")))).alias("confidence"),
    )


@query()
def op9_page_language(spark, sf_dir):
    return identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))
