"""Secret scans: candidates from all texts, false positives removed by a random forest in SQL."""

from __future__ import annotations

from dataclasses import dataclass
from math import log

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import BLANK, NO_BLANK, query, stored, table, words

LEAST_LENGTH = 12
VALUE = "[A-Za-z0-9_+/@.~-]{12,}+"  # a whole run, passed once; dots and @ at its end are cut off
RUN_END = "(?<![@.])[@.]++$"
MASK = "<SECRET>"

# Names of credentials, and formats that only one kind of value has.
CREDENTIAL_NAMES = (
    "(?i)(token|secret|passw|passphrase|pwd|api.?key|access.?key|private.?key|credential|bearer)"
)
CREDENTIAL_FORMATS = "^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,})$"
FORMATS_WITHIN = f"(?<![A-Za-z0-9]){CREDENTIAL_FORMATS[1:-1]}(?![A-Za-z0-9])"
# A name, at most 100 characters of the rest of its word, = or :, and in group 2 what follows in the
# last word: up to the closing quote, or without the punctuation that ends a clause.
NAMED_VALUE = (
    CREDENTIAL_NAMES + r"""[^\s=:]{0,100}+\s?[=:]++>?\s?[(\[{]*+["'`]?"""
    r"""((?<=")[^"\s]+|(?<=')[^'\s]+|(?<=`)[^`\s]+|(?<!["'`])[^\s"'`]*[^\s"'`.,;:)\]}])(?=\S*$)"""
)
HARMLESS_FORMATS = (
    r"^([A-Za-z0-9._+~-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+|\d{1,3}(\.\d{1,3}){3}|[\d./+~-]+"
    r"|[a-z]+(\.[a-z0-9-]+)*\.(com|org|net|html?)(/.*)?)$"
)

FEATURES = (
    "length", "runs", "transitions", "dictionary", "separators", "digits", "distinct", "named",
    "assigned", "prose",
)

TREES, DEPTH, BINS, TRIED = 15, 4, 16, 5
MAX_LABELLED = 20_000  # different labelled values that train the forest
COMMON = 50  # occurrences that make a word part of the dictionary


def candidates(docs: DataFrame) -> DataFrame:
    """What may be a secret, and what stands beside it: one row for each occurrence.

    Three kinds, each value of a word once: long runs with a digit; credentials' own formats; and
    what follows a credential's name and = or :, if it has a letter or digit, however short.
    """
    held = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id",
        "text",
        F.col("text").rlike(FORMATS_WITHIN).alias("formatted"),
        (F.col("text").rlike("[=:]") & F.col("text").rlike(CREDENTIAL_NAMES)).alias("assigning"),
    )
    held = held.where(F.col("text").rlike("[0-9]") | F.col("formatted") | F.col("assigning"))
    w = F.col("words")
    beside = lambda i: F.coalesce(F.get(w, F.col("place") + i), F.lit(""))
    line = F.concat_ws(" ", beside(-2), beside(-1), "word")
    none = F.array().cast("array<string>")
    at = held.select("doc_id", "formatted", "assigning", words(F.col("text")).alias("words")).select(
        "*", F.posexplode("words").alias("place", "word")
    )
    near = at.where(
        ((F.length("word") >= LEAST_LENGTH) & F.col("word").rlike("[0-9]"))
        | F.when(F.col("formatted"), F.col("word").rlike(FORMATS_WITHIN)).otherwise(False)
        | F.when(F.col("assigning"), line.rlike(NAMED_VALUE)).otherwise(False)
    ).select(
        "doc_id",
        "place",
        "word",
        beside(-1).alias("before"),
        beside(-2).alias("before2"),
        beside(1).alias("after"),
        F.filter(
            F.transform(
                F.regexp_extract_all("word", F.lit(VALUE), F.lit(0)),
                lambda v: F.regexp_replace(v, RUN_END, ""),
            ),
            lambda v: (F.length(v) >= LEAST_LENGTH) & v.rlike("[0-9]"),
        ).alias("long"),
        F.when(F.col("formatted"), F.regexp_extract_all("word", F.lit(FORMATS_WITHIN), F.lit(0)))
        .otherwise(none)
        .alias("exact"),
        F.when(
            F.col("assigning"),
            F.arrays_zip(
                F.regexp_extract_all(line, F.lit(NAMED_VALUE), F.lit(2)).alias("value"),
                F.regexp_extract_all(line, F.lit(NAMED_VALUE), F.lit(0)).alias("whole"),
            ),
        )
        .otherwise(F.array().cast("array<struct<value:string,whole:string>>"))
        .alias("named"),
    )
    runs = F.concat("long", F.array_except("exact", "long"))
    until = lambda s, v, n: F.call_function("substring_index", s, v, F.lit(n)).alias("prefix")
    parts = F.concat(
        F.transform(runs, lambda v: F.struct(v.alias("value"), until(F.col("word"), v, 1))),
        F.transform(
            F.filter(
                "named",
                lambda x: x["value"].rlike("[\\p{L}\\p{N}]")
                & (x["value"] != MASK)
                & ~F.array_contains(F.concat("long", "exact"), x["value"]),
            ),
            lambda x: F.struct(
                x["value"].alias("value"),
                # Taken from the end: a short value may also occur in its own name.
                until(F.left(x["whole"], F.length(x["whole"]) - F.length(x["value"])), F.lit(" "), -1),
            ),
        ),
    )
    return near.select("doc_id", "place", "before", "before2", "after", F.explode(parts).alias("part")).select(
        "doc_id", "place", "before", "before2", "after", "part.value", "part.prefix"
    )


def word_counts(docs: DataFrame) -> DataFrame:
    """Lower-case letter runs of all texts' words with their counts; counted as written first."""
    raw = (
        docs.select(F.explode(words(F.col("text"))).alias("raw"))
        .groupBy("raw")
        .agg(F.count("*").alias("n"))
    )
    return (
        raw.select(F.explode(F.regexp_extract_all(F.lower("raw"), F.lit("[a-z]{3,}"), F.lit(0))).alias("word"), "n")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )


def _pairs(text):
    """Neighbouring characters; digits are one character. A single character is its own pair."""
    s = F.split(F.regexp_replace(F.lower(text), "[0-9]", "0"), "")
    after = F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0)))
    return F.when(F.size(s) > 1, F.zip_with(F.slice(s, 1, F.size(s) - 1), after, lambda a, b: F.concat(a, b))).otherwise(s)


def described(found: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds the features to candidates; ``counts`` are the words of the corpus."""
    common = counts.where(F.col("n") >= COMMON)
    pairs = (
        common.select(F.explode(_pairs(F.col("word"))).alias("pair"), "n")
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
    )
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]  # one number
    rates = pairs.select("pair", F.log((F.col("n") + 1) / F.lit(float(total + 729))).alias("rate"))
    unseen = F.lit(-log(total + 729))
    # Parts of a value go by its hash: a long value would else be repeated beside each of them.
    found = found.withColumn("key", F.unhex(F.sha2("value", 256)))
    values = found.select("value", "key").distinct()
    shape = (
        values.select("key", F.explode(_pairs(F.col("value"))).alias("pair"))
        .join(F.broadcast(rates), "pair", "left")  # pairs of a-z: at most 676 rows
        .groupBy("key")
        .agg(F.avg(F.coalesce("rate", unseen)).alias("transitions"))
    )
    runs = F.regexp_extract_all(F.lower("value"), F.lit("[a-z]{3,}+"), F.lit(0))
    covered = (
        values.select("key", F.explode(runs).alias("word"))
        .join(common.select("word"), "word")
        .groupBy("key")
        .agg(F.sum(F.length("word")).alias("covered"))
    )
    kinds = F.col("value")
    for pattern, letter in (("[a-z]+", "a"), ("[A-Z]+", "A"), ("[0-9]+", "0"), ("[^A-Za-z0]+", "-")):
        kinds = F.regexp_replace(kinds, pattern, letter)
    size = F.length("value").cast("double")
    name = F.concat_ws(" ", "before2", "before", "prefix")
    plain = lambda c: F.col(c).rlike("^[\\p{L}]+[.,;:!?]*$").cast("double")
    return (
        found.join(shape, "key", "left")
        .join(covered, "key", "left")
        .select(
            *(c for c in found.columns if c != "key"),
            size.alias("length"),
            (F.length(kinds) / size).alias("runs"),
            F.coalesce("transitions", unseen).alias("transitions"),
            (F.coalesce("covered", F.lit(0)) / size).alias("dictionary"),
            (F.length(F.regexp_replace("value", "[^/.@~+-]", "")) / size).alias("separators"),
            (F.length(F.regexp_replace("value", "[^0-9]", "")) / size).alias("digits"),
            (F.size(F.array_distinct(F.split("value", ""))) / size).alias("distinct"),
            name.rlike(CREDENTIAL_NAMES).cast("double").alias("named"),
            (F.col("prefix").rlike("[=:]") | F.col("before").rlike("[=:]>?$")).cast("double").alias("assigned"),
            ((plain("before") + plain("after")) / 2).alias("prose"),
        )
    )


def known_labels(found: DataFrame) -> DataFrame:
    """Labelled findings from formats: 1 for a credential's own format or a named, assigned value
    of hexadecimal length; 0 for addresses, numbers and hosts; NULL where no format tells."""
    hexadecimal = F.col("value").rlike("^[0-9a-f]{16,}$") & F.col("value").rlike("[a-f]")
    return found.withColumn(
        "label",
        F.when(F.col("value").rlike(CREDENTIAL_FORMATS), 1)
        .when(F.col("value").rlike(HARMLESS_FORMATS), 0)
        .when(hexadecimal & (F.col("named") > 0) & (F.col("assigned") > 0), 1),
    )


@dataclass
class Node:
    feature: str | None = None
    limit: float = 0.0
    share: float = 0.5
    low: Node | None = None
    high: Node | None = None


def _column(node: Node, leaf):
    if node.feature is None:
        return leaf(node)
    return F.when(F.col(node.feature) <= node.limit, _column(node.low, leaf)).otherwise(
        _column(node.high, leaf)
    )


def forest_score(trees: list[Node]):
    """Mean share of secrets in the leaves a finding reaches, as one expression."""
    leaves = [_column(t, lambda n: F.lit(float(n.share))) for t in trees]
    return sum(leaves[1:], leaves[0]) / len(trees)


def labelled_sample(values: DataFrame, most: int) -> tuple[DataFrame, tuple[float, float]]:
    """At most ``most`` rows of ``values``, drawn by hash within each label, and weights of 0 and 1.

    Half of them are kept for each label; what one label does not fill is the other's. So a rare
    label stays in the sample, and the weights give both labels the shares they have in ``values``.
    """
    held = {r["label"]: r["n"] for r in values.groupBy("label").agg(F.count("*").alias("n")).collect()}
    ones = min(held.get(1, 0), max(most // 2, most - held.get(0, 0)))
    taken = {0: min(held.get(0, 0), most - ones), 1: ones}
    part = lambda k: (
        values.where(F.col("label") == k).orderBy(F.xxhash64("value"), "value").limit(taken[k])
    )
    size, total = sum(taken.values()), sum(held.values())
    weights = tuple(held[k] * size / (total * taken[k]) if taken[k] else 0.0 for k in (0, 1))
    return part(0).unionByName(part(1)), weights


def learn_forest(labelled: DataFrame, weights: tuple[float, float] = (1.0, 1.0)) -> list[Node]:
    """A random forest from FEATURES, label (0 or 1) and value, grown level by level.

    A value counts as often as ``weights`` says for its label.

    Each tree draws the values with Poisson weights made from a hash, and each node may use TRIED of
    the features. A level is one aggregate over the (bounded) labelled values: weights by tree, node,
    feature and bin of the feature; only that histogram reaches the driver. Same rows, same forest.
    """
    cuts = labelled.agg(  # exact, as the order in which partitions arrive must not matter
        *[F.percentile(f, [i / BINS for i in range(1, BINS)]).alias(f) for f in FEATURES],
        F.count("label").alias("n"),
        F.sum("label").alias("p"),
    ).first()
    n, p = cuts["n"], cuts["p"] or 0
    trees = [Node(share=_share(n, p, weights) if n else 0.5) for _ in range(TREES)]
    if p in (0, n):
        return trees
    limits = {f: sorted(set(cuts[f])) for f in FEATURES}
    bins = F.array(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                sum(((F.col(f) > x).cast("int") for x in limits[f]), F.lit(0)).alias("bin"),
            )
            for f in FEATURES
        ]
    )

    def weight(t: int):
        u = F.pmod(F.xxhash64("value", F.lit(t)), F.lit(1_000_000)) / 1_000_000
        return sum((u > x).cast("int") for x in (0.3679, 0.7358, 0.9197, 0.9810, 0.9963))

    places: list[dict[int, Node]] = [{1: t} for t in trees]
    numbers = {id(t): 1 for t in trees}
    for _ in range(DEPTH):
        drawn = F.array(
            *[
                F.struct(
                    F.lit(t).alias("tree"),
                    _column(trees[t], lambda n: F.lit(numbers.get(id(n), 0))).alias("node"),
                    weight(t).alias("w"),
                )
                for t in range(TREES)
            ]
        )
        cells: dict[tuple[int, int], dict] = {}
        for r in (
            labelled.select("label", bins.alias("bins"), F.explode(drawn).alias("d"))
            .where("d.w > 0 AND d.node > 0")
            .select("label", "d.*", F.explode("bins").alias("b"))
            .groupBy("tree", "node", "b.feature", "b.bin")
            .agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("label")).alias("p"))
            .collect()
        ):
            cells.setdefault((r["tree"], r["node"]), {})[r["feature"], r["bin"]] = (r["n"], r["p"])
        fresh: dict[int, int] = {}
        grown: list[dict[int, Node]] = [{} for _ in trees]
        for (t, number), bars in cells.items():
            node = places[t].get(number)
            order = sorted(FEATURES, key=lambda f: hash_of(t, number, f))
            best = _best_split(bars, order[:TRIED], limits, weights) if node else None
            if best:
                node.feature, node.limit, low, high = best
                node.low, node.high = Node(share=low), Node(share=high)
                for side, child in ((0, node.low), (1, node.high)):
                    grown[t][2 * number + side] = child
                    fresh[id(child)] = 2 * number + side
        places, numbers = grown, fresh
        if not fresh:
            break
    return trees


def hash_of(*parts) -> int:
    """A fixed order of the features for a node."""
    n = 1469598103934665603
    for byte in repr(parts).encode():
        n = (n ^ byte) * 1099511628211 % (1 << 64)
    return n


def _share(n: int, p: int, weights: tuple[float, float]) -> float:
    """The weighted share of ``p`` secrets among ``n`` values."""
    return weights[1] * p / (weights[0] * (n - p) + weights[1] * p)


def _best_split(bars, features, limits, weights):
    def impurity(n, p):
        return weights[1] * p * (1 - _share(n, p, weights))

    best = None
    for f in features:
        row = [bars.get((f, i), (0, 0)) for i in range(len(limits[f]) + 1)]
        n, p = (sum(x) for x in zip(*row, strict=True))
        if not 0 < p < n:
            continue
        ln = lp = 0
        for (bn, bp), limit in zip(row, limits[f], strict=False):
            ln, lp = ln + bn, lp + bp
            hn, hp = n - ln, p - lp
            if ln and hn:
                left = impurity(ln, lp) + impurity(hn, hp)
                if left < impurity(n, p) - 1e-9 and (best is None or left < best[0] - 1e-12):
                    best = (left, (f, limit, _share(ln, lp, weights), _share(hn, hp, weights)))
    return best and best[1]


def secret_findings(docs: DataFrame, labels: DataFrame | None = None, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Every candidate of every text, its score, and whether it is taken for a secret.

    ``docs`` has doc_id and text; other columns are ignored. ``labels`` has value and label (0 or
    1, NULL ignored; the largest of a value counts); without it the formats of ``known_labels`` say.
    The forest learns from at most ``max_labelled`` different labelled values, drawn by hash within
    each label and weighted by its share; a value labelled 1 is a secret whatever its score. The
    dictionary and the character transitions are counted over all texts.

    Returns doc_id, place (of the word), value, the features, label, score, is_secret; a row for
    each occurrence. NULL and empty texts have none; NULL ids and repeated rows are as any other; a
    corpus without labels of both kinds gets the share of secrets as score; empty gives empty.
    """
    found = stored(described(candidates(docs), word_counts(docs)), "candidates")
    if labels is None:
        marked = known_labels(found)
    else:
        marks = labels.groupBy("value").agg(F.max("label").alias("label"))
        marked = found.join(marks, "value", "left")
    values = (
        marked.where("label IS NOT NULL")
        .groupBy("value")
        .agg(F.max("label").alias("label"), *[F.min(f).alias(f) for f in FEATURES])
    )
    sample, weights = labelled_sample(values, max_labelled)
    trees = learn_forest(stored(sample, "labelled"), weights)
    taken = (F.coalesce("label", F.lit(0)) == 1) | (F.col("score") >= 0.5)
    return marked.withColumn("score", forest_score(trees)).select(
        "doc_id", "place", "value", *FEATURES, "label", "score", taken.alias("is_secret")
    )


def _masked_word(word, values):
    """A word with MASK in place of the values found in it, longer ones first.

    A value under LEAST_LENGTH is replaced where no letter or digit adjoins it.
    """
    longest = F.array_sort(
        values, lambda a, b: F.coalesce(F.nullif(F.length(b) - F.length(a), F.lit(0)), F.when(a < b, -1).otherwise(1))
    )
    quoted = lambda v: F.concat(F.lit("\\Q"), F.replace(v, F.lit("\\E"), F.lit("\\E\\\\E\\Q")), F.lit("\\E"))
    alone = lambda v: F.concat(
        F.lit(f"(?<![\\p{{L}}\\p{{N}}])(?!(?<=<){MASK[1:]})"), quoted(v), F.lit("(?![\\p{L}\\p{N}])")
    )
    return F.aggregate(
        longest,
        word,
        lambda t, v: F.when(F.length(v) >= LEAST_LENGTH, F.replace(t, v, F.lit(MASK))).otherwise(
            F.regexp_replace(t, alone(v), F.lit(MASK))
        ),
    )


def masked_documents(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """All documents, with MASK in place of each secret in the word it was found in, and n_chars to match.

    The same characters elsewhere in the text stay. Rows that share an id get the masks of all of
    them, each where its own words have the value.
    """
    found = (
        secret_findings(docs, labels)
        .where("is_secret")
        .groupBy("doc_id", "place")
        .agg(F.collect_set("value").alias("values"))
        .groupBy(F.col("doc_id").alias("found_id"))
        .agg(F.map_from_entries(F.collect_list(F.struct("place", "values"))).alias("found"))
    )
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(row.alias("row")).join(found, F.expr("row.doc_id <=> found_id"), "left")
    # Each word with the blanks behind it; what is before the first word is no word.
    text = F.col("row.text")
    lead = F.regexp_extract(text, f"^{BLANK}*+", 0)
    begun = F.split(F.substring(text, F.length(lead) + 1, F.length(text)), f"(?<={BLANK})(?={NO_BLANK})")
    masked = F.concat(
        lead,
        F.array_join(
            F.transform(
                begun,
                lambda w, i: F.when(
                    F.map_contains_key("found", i), _masked_word(w, F.try_element_at("found", i))
                ).otherwise(w),
            ),
            "",
        ),
    )
    text = F.when(F.col("found").isNull(), text).otherwise(masked)
    rows = rows.select("row", text.alias("text"), F.col("found").isNotNull().alias("changed"))
    columns = []
    for f in docs.schema.fields:
        column = F.col(f"row.`{f.name}`")
        if f.name == "text":
            column = F.col("text")
        elif f.name == "n_chars":
            column = F.when(F.col("changed"), F.length("text")).otherwise(column).cast(f.dataType)
        columns.append(column.alias(f.name))
    return rows.select(*columns)


@query()
def op1_secret_scan(spark, sf_dir):
    return secret_findings(table(spark, sf_dir, "documents")).select(
        "doc_id", "place", "value", "label", "score", "is_secret"
    )
