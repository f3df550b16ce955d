"""Mixing sources to target weights: a curriculum whose weights change over training time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import query, table, words

# Weight of a source at the begin and the end of training, in turn by its rank. It changes
# linearly, so its integral over training is the mean of the two: 5, 2 and 1.
SCHEDULES = ((7.5, 2.5), (2.0, 2.0), (0.5, 1.5))
MAX_REPEAT = 3
BUCKETS = 3  # hex digits of the shuffle order that name a bucket


def source_targets(sizes: DataFrame, schedules=SCHEDULES, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Words that the mix takes of each source; ``sizes`` has source and size.

    Sources are ranked by code point, NULL last. All of them share the sum of all sizes by the
    integrals of their schedules. A source stops at ``max_repeat`` times its size and its excess
    goes to the others by weight: with sources in order of size per weight, the first one that the
    common factor leaves below its limit ends the filling.
    """
    n = len(schedules)
    by = lambda i: F.element_at(
        F.array(*[F.lit(float(s[i])) for s in schedules]), ((F.col("rank") - 1) % n + 1).cast("int")
    )
    sources = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())))
        .withColumn("begins", by(0))
        .withColumn("ends", by(1))
        .withColumn("weight", (F.col("begins") + F.col("ends")) / 2)
    )
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(0)).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    full = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    sources = sources.select(
        "*",
        F.row_number().over(order).alias("place"),
        (
            (F.sum("source_size").over(everything) - max_repeat * full("source_size"))
            / (F.sum("weight").over(everything) - full("weight"))
        ).alias("factor"),
    )
    fits = F.col("factor") * F.col("weight") <= max_repeat * F.col("source_size")
    common = F.min(F.when(fits, F.struct("place", "factor"))).over(everything)["factor"]
    return sources.withColumn(
        "target",
        F.least(
            (max_repeat * F.col("source_size")).cast("double"),
            F.coalesce(common * F.col("weight"), F.lit(0.0)),
        ),
    ).select("source", "rank", "source_size", "begins", "ends", "target")


def training_time(share):
    """The time at which a linear schedule from ``begins`` to ``ends`` has handed out ``share``.

    Its integral up to t is begins*t + (ends-begins)*t*t/2; this is the inverse.
    """
    a, b = F.col("begins"), F.col("ends")
    return F.when(a == b, share).otherwise(
        F.abs((F.sqrt(a * a + (b * b - a * a) * share) - a) / (b - a))
    )


def mix_sources(docs: DataFrame, schedules=SCHEDULES, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """How many words of each document the mix takes, and when in training it is first met.

    ``docs`` has doc_id, text and source; other columns are ignored. Each source is a stream: its
    documents in a fixed shuffled order (digest of the id), repeated, cut at the target. The place
    of a document in its source's stream is a running sum, taken in two steps, over buckets of the
    order and within one, so that a source with a third of all rows is no single task. A document's
    training position is the time at which the source's cumulative demand reaches its place.

    Returns doc_id, source, size (words), source_size, target, taken, copies (times it is met, the
    last one perhaps in part: at most one document of a source), place, position (NULL if nothing
    is taken), in order of position. NULL and empty texts have size 0 and take nothing; NULL is a
    source of its own; NULL ids share one place in the order; repeated rows are separate documents;
    an empty table gives an empty result.
    """
    mix = _placed(docs, schedules, max_repeat).select(*COLUMNS)
    return mix.orderBy(F.col("position").asc_nulls_last(), "doc_id")


COLUMNS = (
    "doc_id", "source", "size", "source_size", "target", "taken", "copies", "place", "position",
)


def _placed(docs: DataFrame, schedules, max_repeat: int) -> DataFrame:
    sizes = docs.select(
        "doc_id",
        "source",
        F.size(words(F.col("text"))).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("shuffled"),
    )
    targets = source_targets(sizes, schedules, max_repeat)
    ranked = (
        sizes.alias("d")
        .join(targets.alias("t"), F.expr("d.source <=> t.source"))
        .select("d.*", "rank", "source_size", "begins", "ends", "target")
        .withColumn("bucket", F.substring("shuffled", 1, BUCKETS))
    )
    buckets = (
        ranked.groupBy("rank", "bucket")
        .agg(F.sum("size").alias("n"))
        .select(
            "rank",
            "bucket",
            F.coalesce(
                F.sum("n").over(
                    Window.partitionBy("rank")
                    .orderBy("bucket")
                    .rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("before"),
        )
    )
    within = (
        Window.partitionBy("rank", "bucket")
        .orderBy("shuffled", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    placed = ranked.join(buckets, ["rank", "bucket"]).withColumn(
        "place", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    )
    met = [
        F.greatest(
            F.lit(0),
            F.least(
                F.col("size"),
                F.floor("target") - (F.lit(k).cast("long") * F.col("source_size") + F.col("place")),
            ),
        )
        for k in range(max_repeat)
    ]
    return (
        placed.withColumn("taken", sum(met[1:], met[0]).cast("long"))
        .withColumn("copies", sum(((m > 0).cast("int") for m in met[1:]), (met[0] > 0).cast("int")))
        .withColumn(
            "position",
            F.when(F.col("taken") > 0, training_time(F.col("place") / F.col("target"))),
        )
        .select(*COLUMNS, "begins", "ends")
    )


def mixed_documents(docs: DataFrame, schedules=SCHEDULES, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """The mix itself: every document as often as it is met, whole, in order of training position.

    ``docs`` keeps its columns. A document with an empty text, of which nothing can be taken, stays
    once, at the begin. Rows that share an id and a source get the most copies of any of them.
    """
    plan = (
        _placed(docs, schedules, max_repeat)
        .groupBy(F.col("doc_id").alias("id"), F.col("source").alias("of"))
        .agg(
            F.max("copies").alias("copies"),
            F.max("size").alias("size"),
            *[F.max(c).alias(c) for c in ("place", "source_size", "target", "begins", "ends")],
        )
        .where("copies > 0 or size = 0")
        .withColumn(
            "k", F.explode(F.sequence(F.lit(0), F.greatest(F.col("copies"), F.lit(1)) - 1))
        )
        .withColumn(
            "position",
            F.coalesce(
                training_time(
                    (F.col("k") * F.col("source_size") + F.col("place")) / F.col("target")
                ),
                F.lit(0.0),
            ),
        )
        .select("id", "of", "k", "position")
    )
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return (
        rows.join(plan, F.expr("row.doc_id <=> id AND row.source <=> of"))
        .orderBy("position", "id", "k")
        .select("row.*")
    )


SQL = """
WITH sizes AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffled,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size
  FROM documents
), ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM sizes GROUP BY source
), weighted AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 7.5::DOUBLE WHEN 1 THEN 2 ELSE 0.5 END AS a,
    CASE (rank - 1) % 3 WHEN 0 THEN 2.5::DOUBLE WHEN 1 THEN 2 ELSE 1.5 END AS b,
    CASE (rank - 1) % 3 WHEN 0 THEN 5::DOUBLE WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM ranked
), filling AS (
  SELECT *, row_number() OVER o AS place,
    (CAST(sum(source_size) OVER () AS BIGINT) - 3 * CAST(coalesce(sum(source_size) OVER p, 0) AS BIGINT))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER p, 0)) AS factor
  FROM weighted
  WINDOW o AS (ORDER BY source_size / weight, rank),
    p AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, rank, source_size, a, b, least(CAST(3 * source_size AS DOUBLE), weight * (
    SELECT factor FROM filling WHERE factor * weight <= 3 * source_size ORDER BY place LIMIT 1
  )) AS target
  FROM filling
), placed AS (
  SELECT s.doc_id, s.size, t.*, CAST(coalesce(sum(s.size) OVER (
    PARTITION BY t.rank ORDER BY s.shuffled, s.doc_id, s.size
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), taken AS (
  SELECT *, CAST(greatest(0, least(size, floor(target)::BIGINT - place))
    + greatest(0, least(size, floor(target)::BIGINT - (source_size + place)))
    + greatest(0, least(size, floor(target)::BIGINT - (2 * source_size + place))) AS BIGINT) AS taken
  FROM placed
)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN
    CASE WHEN a = b THEN place / target
    ELSE abs((sqrt(a * a + (b * b - a * a) * (place / target)) - a) / (b - a)) END END AS position
FROM taken
"""


@query(SQL)
def op2_mix_sources(spark, sf_dir):
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "position"
    )
