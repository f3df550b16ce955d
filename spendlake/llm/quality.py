"""Quality rules: an ordered decision list of threshold conjunctions, learned from labels."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import log2

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import NO_BLANK, query, stored, table, words

SYMBOL = "[#*$%&|<>]"

# What the rules may test, as SQL over the columns of ``text_measures``.
FEATURES = {
    "words": "CAST(n_words AS DOUBLE)",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "distinct_words": "n_distinct_words / greatest(n_words, 1)",
    "words_per_line": "n_words / greatest(n_lines, 1)",
}


def text_measures(docs: DataFrame) -> DataFrame:
    """Counts of each text beside the columns of ``docs``, all within the row.

    Adds n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_distinct_words.
    For repeated three-word windows the row sorts pairs of a window's 64-bit hash and its place, so
    equal windows become neighbours; the neighbours are then compared as words.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in docs.columns]
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NO_BLANK))
    symbols = F.when(
        text.rlike(SYMBOL), F.length(text) - F.length(F.regexp_replace(text, SYMBOL, ""))
    ).otherwise(0)
    first = docs.select(
        *kept,
        words(text).alias("__words"),
        symbols.cast("long").alias("n_symbols"),
        lines.alias("__lines"),
    )
    w = F.col("__words")
    window = lambda i: (F.get(w, i), F.get(w, i + 1), F.get(w, i + 2))
    hashed = lambda i: F.struct(F.xxhash64(*window(i)).alias("hash"), i.alias("place"))
    second = first.select(
        *kept,
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size(F.array_distinct(w)).cast("long").alias("n_distinct_words"),
        "__words",
        F.when(
            F.size(w) >= 3,
            F.sort_array(F.transform(F.sequence(F.lit(0), F.size(w) - 3), hashed)),
        )
        .otherwise(F.array().cast("array<struct<hash:bigint,place:int>>"))
        .alias("__sorted"),
    )
    s = F.col("__sorted")
    head = lambda x: x["hash"]
    third = second.withColumn(
        "__hits",
        F.filter(
            s,
            lambda x, k: (head(x) == head(F.get(s, k + 1))) | (head(x) == head(F.get(s, k - 1))),
        ),
    )
    h = F.col("__hits")
    place = lambda x: x["place"]
    same = lambda x, y: reduce(
        lambda p, q: p & q,
        [a == b for a, b in zip(window(place(x)), window(place(y)), strict=True)],
    )
    fourth = third.withColumn(
        "__places",
        F.sort_array(
            F.transform(
                F.filter(h, lambda x, k: same(x, F.get(h, k + 1)) | same(x, F.get(h, k - 1))),
                place,
            )
        ),
    )
    p = F.col("__places")
    covered = F.aggregate(
        F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))),
        F.lit(0),
        lambda a, x: a + x,
    )
    return fourth.select(
        *kept,
        F.size("__words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        "n_lines",
        "n_dup_lines",
        covered.cast("long").alias("n_repeat_words"),
        "n_distinct_words",
    )


@dataclass(frozen=True)
class Test:
    feature: str
    above: bool
    limit: float

    def sql(self) -> str:
        return f"({FEATURES[self.feature]}) {'>' if self.above else '<='} {self.limit!r}D"


Rule = tuple[Test, ...]


def rule_sql(rule: Rule) -> str:
    return " AND ".join(f"({t.sql()})" for t in rule)


def decision_list(rules: list[Rule]):
    """The name of the first rule that a text meets, as one conditional expression; else NULL."""
    verdict = F.lit(None).cast("string")
    for i, rule in reversed(list(enumerate(rules))):
        name = f"{i + 1}: " + " and ".join(
            f"{t.feature} {'>' if t.above else '<='} {t.limit:.4g}" for t in rule
        )
        verdict = F.when(F.expr(rule_sql(rule)), F.lit(name)).otherwise(verdict)
    return verdict


def learn_rules(
    labelled: DataFrame,
    max_rules: int = 6,
    max_tests: int = 3,
    bins: int = 20,
    min_precision: float = 0.95,
    min_support: int = 8,
) -> list[Rule]:
    """Sequential covering over ``labelled``: measures and ``bad`` (1 for a text to reject).

    Two of three rows grow a rule, the others prune it. A rule grows by the threshold test with the
    greatest information gain, read from one histogram of all features over the rows that it still
    holds, until it holds no good text or has ``max_tests`` tests. It loses its last tests as long
    as that does not lower its precision on the pruning rows, and is accepted if it keeps
    ``min_precision`` there with ``min_support`` rows. Rows that it holds then leave both parts.
    Learning ends with the first rule that is not accepted. Every labelled row counts; only
    histograms reach the driver.
    """
    names = list(FEATURES)
    numbers = stored(
        labelled.where("bad IS NOT NULL").select(
            *[F.expr(sql).alias(name) for name, sql in FEATURES.items()],
            F.col("bad").cast("long").alias("bad"),
            (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prunes"),
        ),
        "labelled",
    )
    steps = [i / bins for i in range(1, bins)]
    cuts = numbers.agg(
        *[F.percentile_approx(n, steps, 10_000).alias(n) for n in names]
    ).first()
    limits = {n: sorted(set(cuts[n] or [])) for n in names}

    def held(rule: Rule, rows: DataFrame) -> DataFrame:
        for t in rule:
            rows = rows.where(F.col(t.feature) > t.limit if t.above else F.col(t.feature) <= t.limit)
        return rows

    def histogram(rows: DataFrame) -> dict[tuple[str, int], tuple[int, int]]:
        cells = F.array(
            *[
                F.struct(
                    F.lit(n).alias("feature"),
                    sum(((F.col(n) > x).cast("int") for x in limits[n]), F.lit(0)).alias("bin"),
                )
                for n in names
            ]
        )
        found = (
            rows.select("bad", F.explode(cells).alias("cell"))
            .groupBy("cell")
            .agg(F.sum("bad").alias("p"), F.sum(1 - F.col("bad")).alias("n"))
            .collect()
        )
        return {(r["cell"]["feature"], r["cell"]["bin"]): (r["p"], r["n"]) for r in found}

    def best_test(counts) -> tuple[float, Test, int] | None:
        best = None
        for name in names:
            bars = [counts.get((name, i), (0, 0)) for i in range(len(limits[name]) + 1)]
            p, n = (sum(x) for x in zip(*bars, strict=True))
            if not p:
                return None
            low_p = low_n = 0
            for (bp, bn), limit in zip(bars, limits[name], strict=False):
                low_p, low_n = low_p + bp, low_n + bn
                for above, tp, tn in ((False, low_p, low_n), (True, p - low_p, n - low_n)):
                    if tp >= min_support:
                        gain = tp * (log2(tp / (tp + tn)) - log2(p / (p + n)))
                        if gain > 1e-9 and (best is None or gain > best[0]):
                            best = (gain, Test(name, above, limit), tn)
        return best

    rules: list[Rule] = []
    left = numbers
    while len(rules) < max_rules:
        rule: Rule = ()
        grows = left.where("NOT prunes")
        while len(rule) < max_tests:
            step = best_test(histogram(held(rule, grows)))
            if step is None:
                break
            rule = (*rule, step[1])
            if not step[2]:
                break
        if not rule:
            break
        prefixes = [rule[: k + 1] for k in range(len(rule))]
        sums = []
        for k, prefix in enumerate(prefixes):
            holds = reduce(
                lambda a, b: a & b,
                [F.col(t.feature) > t.limit if t.above else F.col(t.feature) <= t.limit for t in prefix],
            )
            sums += [
                F.sum(F.when(holds, F.col("bad"))).alias(f"p{k}"),
                F.sum(F.when(holds, 1 - F.col("bad"))).alias(f"n{k}"),
            ]
        seen = left.where("prunes").agg(*sums).first()
        score = [
            ((seen[f"p{k}"] or 0) / max(1, (seen[f"p{k}"] or 0) + (seen[f"n{k}"] or 0)), -k)
            for k in range(len(rule))
        ]
        precision, k = max(score)
        support = seen[f"p{-k}"] or 0
        if precision < min_precision or support < min_support:
            break
        rules.append(prefixes[-k])
        t = rules[-1]
        left = left.where(
            ~reduce(
                lambda a, b: a & b,
                [F.col(x.feature) > x.limit if x.above else F.col(x.feature) <= x.limit for x in t],
            )
        )
    return rules


def judged(measured: DataFrame, labels: DataFrame) -> DataFrame:
    """Adds base_failed, rule (the rule met, or NULL) and kept to measured documents.

    ``labels`` has doc_id and quality (0 or 1); the least label of an id counts, NULL ones don't.
    """
    marks = labels.groupBy("doc_id").agg((1 - F.min("quality")).alias("bad"))
    columns = [c for c in measured.columns if c in ("doc_id", *MEASURES)]
    rules = learn_rules(measured.select(*columns).join(marks, "doc_id"))
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        measured.withColumn("base_failed", base)
        .withColumn("rule", decision_list(rules))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
    )


MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
    "n_distinct_words",
)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Measures and verdict of every document: fixed base limits, then the learned decision list.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality; other columns are ignored. Returns
    doc_id, the measures, base_failed, rule, kept; a row for each row. NULL and empty texts have
    zeros throughout and fail the base limits; a NULL id can't be labelled; repeated rows are judged
    alike; without labels there are no rules and the base limits decide; empty gives empty.
    """
    measured = stored(text_measures(docs.select("doc_id", "text")).drop("text"), "measures")
    return judged(measured, labels).select("doc_id", *MEASURES, "base_failed", "rule", "kept")


def quality_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that base limits and learned rules keep, with their columns as they are."""
    inner = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), "doc_id", "text"
    )
    measured = stored(text_measures(inner).drop("text"), "measures")
    return judged(measured, labels).where("kept").select("__row.*")


@query()
def op10_quality_rules(spark, sf_dir):
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "rule",
    )
