"""Untagged resources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators import inventory as I
from spendlake.registry.catalog import query
from spendlake.registry.views import (
    DOCUMENT_SIZE,
    EXCLUDED_ACCOUNT,
    RESOURCES_SQL,
    UNTAGGED_SQL,
    aliases,
    inventory_documents,
    table,
)
from spendlake.sinks.documents import write_documents
from spendlake.sinks.reports import write_text_report
from spendlake.sources.files import scratch
from spendlake.sources.listing import spread
from spendlake.sources.lists import read_inventory

# Small files that a task writes.
FILES_PER_TASK = 5_000

_LINE_SQL = """concat(rpad(region_label, 5, ' '), ' ', account,
  repeat(' ', greatest(0, 18 - length(account))), '  ', arn)"""


def _untagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    resources = I.flatten_resources(inventory_documents(spark, sf_dir))
    return I.untagged_resources(
        resources,
        I.REGION_LABELS,
        aliases(spark, sf_dir),
        excluded_account=EXCLUDED_ACCOUNT,
    )


@query(f"WITH {RESOURCES_SQL}, {UNTAGGED_SQL} SELECT * FROM untagged")
def untagged_resources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _untagged(spark, sf_dir)


@query(f"""WITH {RESOURCES_SQL}, {UNTAGGED_SQL}
SELECT count(*) AS n_resources, cast(50 + sum(length({_LINE_SQL}) + 1) AS bigint) AS report_length,
  50 + sum(length({_LINE_SQL}) + 1) > 60 AS should_alert
FROM untagged""")
def untagged_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return I.should_alert(_untagged(spark, sf_dir))


@query(f"""WITH {RESOURCES_SQL}, {UNTAGGED_SQL}
SELECT 'Region * Account ***** No migration tag resource.' AS value
UNION ALL SELECT {_LINE_SQL} FROM untagged""")
def untagged_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The text report, written and read again."""
    target = scratch(spark, "untagged")
    write_text_report(_untagged(spark, sf_dir), target)
    return spark.read.text(target)


@query(f"""WITH {RESOURCES_SQL}
SELECT arn AS "Arn", region AS "Region", owner AS "OwningAccountId", rtype AS "ResourceType"
FROM res""")
def inventory_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory documents as files, found by their suffix and flattened."""
    target = scratch(spark, "inventory")
    inventory_documents(spark, sf_dir).write.text(target)
    return I.flatten_resources(read_inventory(spark, target, ".txt", whole_files=False))


@query(f"""WITH {RESOURCES_SQL}
SELECT arn AS "Arn", region AS "Region", owner AS "OwningAccountId", rtype AS "ResourceType"
FROM res""")
def inventory_whole_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One document per file, some spread over lines; files that hold next to nothing are passed over."""
    target = scratch(spark, "inventory")
    over_lines = F.regexp_replace("value", r"\},\{", "},\n  {")
    documents = inventory_documents(spark, sf_dir).select(over_lines.alias("value"))
    empty = F.element_at(F.array(F.lit("{}"), F.lit(""), F.lit("null"), F.lit("[ ]\n")), (F.col("s_suppkey") % 4 + 1).cast("int"))
    nothing = table(spark, sf_dir, "supplier").select(empty.cast("string").alias("value"))
    write_documents(documents.unionByName(spread(nothing, FILES_PER_TASK)), target)
    return I.flatten_resources(read_inventory(spark, target, ".txt", whole_files=True))


@query(f"""WITH {RESOURCES_SQL}
SELECT count(DISTINCT event_id // {DOCUMENT_SIZE}) AS n_malformed
FROM events WHERE (event_id // {DOCUMENT_SIZE}) % 3 = 0""")
def inventory_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third document is cut short, and is found."""
    documents = inventory_documents(spark, sf_dir, keep="page")
    cut = F.expr("substring(value, 1, length(value) - 3)")
    broken = documents.withColumn("value", F.when(F.col("page") % 3 == 0, cut).otherwise(F.col("value")))
    return I.malformed_documents(broken).agg(F.count("*").alias("n_malformed"))


@query(f"WITH {RESOURCES_SQL}, {UNTAGGED_SQL} SELECT * FROM untagged")
def untagged_by_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lists given as tables, each row twice: keys that repeat change nothing."""
    twice = lambda rows: rows.unionByName(rows)
    one = lambda values: twice(spark.createDataFrame([(v,) for v in values], "v string"))
    return I.untagged_resources(
        I.flatten_resources(inventory_documents(spark, sf_dir)),
        twice(spark.createDataFrame(list(I.REGION_LABELS), "region string, label string")),
        twice(aliases(spark, sf_dir)),
        monitored=one(I.MONITORED_TYPES),
        excluded_patterns=one(I.EXCLUDED_PATTERNS),
        excluded_account=one([EXCLUDED_ACCOUNT]),
    )
