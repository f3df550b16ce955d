"""Untagged resources: flatten inventory documents, filter, label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.operators.ids import matching_values

INVENTORY_SCHEMA = T.StructType(
    [
        T.StructField(
            "Resources",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("Arn", T.StringType()),
                        T.StructField("Region", T.StringType()),
                        T.StructField("OwningAccountId", T.StringType()),
                        T.StructField("ResourceType", T.StringType()),
                    ]
                )
            ),
        )
    ]
)

# Regions that are watched, and their labels in the report.
REGION_LABELS = (("ap-southeast-1", "SG"), ("ap-northeast-1", "JP"), ("ap-east-1", "HK"))

# Resources whose name contains one of these are made by tools.
EXCLUDED_PATTERNS = ("aws-tagging-automation", "cf-templates")

# Fixed value: the account that is never reported.
EXCLUDED_ACCOUNT = "851805"

# Resource types that cost money.
MONITORED_TYPES = (
    "backup:backupplan", "cloudfront:distribution", "dms:replicationinstance",
    "dms:replicationtask", "dynamodb:table", "ec2:volume", "ec2:instance", "ec2:natgateway",
    "ec2:image", "ec2:eip", "ec2:transitgateway", "ec2:vpcendpoint", "ecs:cluster",
    "eks:cluster", "elasticache:cachecluster", "elasticache:snapshot", "efs:filesystem",
    "elasticloadbalancingv2:loadbalancer", "elasticsearch:domain", "opensearchservice:domain",
    "kinesisfirehose:deliverystream", "glue:crawler", "glue:database", "glue:job",
    "kafka:cluster", "kinesis:stream", "lambda:function", "logs:loggroup",
    "cloudwatch:dashboard", "cloudwatch:alarm", "rds:dbcluster", "rds:dbinstance",
    "rds:dbsnapshot", "redshift:cluster", "route53:hostedzone", "s3:bucket",
    "sagemaker:notebookinstance", "secretsmanager:secret", "sns:topic", "sqs:queue",
)

# First line of the report, shortest document that is read, and the length
# above which a report is worth sending.
REPORT_HEADER = "Region * Account ***** No migration tag resource."
MIN_DOCUMENT = 7
MIN_ALERT = 60


def flatten_resources(documents: DataFrame, column: str = "value") -> DataFrame:
    """One row per resource of documents ``{"Resources": [...]}``; near-empty ones are skipped."""
    parsed = F.from_json(F.col(column), INVENTORY_SCHEMA)
    return (
        documents.where(F.length(column) >= MIN_DOCUMENT)
        .select(F.explode(parsed["Resources"]).alias("r"))
        .select("r.*")
    )


def malformed_documents(documents: DataFrame, column: str = "value") -> DataFrame:
    """Documents that ``flatten_resources`` takes no resource from, though they are long enough.

    Cut short, no JSON, or without a list of resources: an account whose listing failed would look
    fully tagged. An empty list is well formed.
    """
    listed = F.from_json(F.col(column), INVENTORY_SCHEMA)["Resources"]
    return documents.where((F.length(column) >= MIN_DOCUMENT) & listed.isNull())


def unique_keys(lookup: DataFrame, key: str, value: str) -> DataFrame:
    """A lookup table with one row per key: of repeated ones the first value in order."""
    return lookup.groupBy(key).agg(F.min(value).alias(value))


def literal_table(
    spark: SparkSession, names: Sequence[str], rows: Sequence[tuple[str, ...]]
) -> DataFrame:
    """A small table of texts that is part of the plan itself, so its size is known."""
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def arn_account(arn: Column) -> Column:
    """Fifth part of an ARN; NULL when there are fewer."""
    return F.get(F.split(arn, ":"), F.lit(4))


def untagged_resources(
    resources: DataFrame,
    regions: Sequence[tuple[str, str]] | DataFrame,
    aliases: DataFrame,
    monitored: Sequence[str] | DataFrame = MONITORED_TYPES,
    excluded_patterns: Sequence[str] | DataFrame = EXCLUDED_PATTERNS,
    excluded_account: str | DataFrame = EXCLUDED_ACCOUNT,
    alias_prefix: str = "HK-",
) -> DataFrame:
    """Watched resources with the label of their region and the alias of their account.

    ``regions`` are pairs or a table ``(region, label)``, ``aliases`` is a table
    ``(account_id, alias)``; a key that is there twice has its first value in order, so no resource
    is repeated. Excluded accounts and patterns may be tables of one column as well. An account
    without alias shows its own id. Tables are not forced to broadcast: the planner does so while
    they are small, and otherwise splits a hot account at run time.
    """
    if isinstance(regions, DataFrame):
        regions = unique_keys(regions, "region", "label")
    else:
        first = dict(sorted(regions, reverse=True))  # the first label in order is the last one set
        regions = literal_table(resources.sparkSession, ("region", "label"), sorted(first.items()))
    aliases = unique_keys(aliases, "account_id", "alias")
    arn, owner = F.col("Arn"), F.col("OwningAccountId")
    if isinstance(excluded_account, DataFrame):
        accounts = excluded_account.select(F.col(excluded_account.columns[0]).alias("__account"))
        kept = resources.join(accounts, arn_account(arn) == F.col("__account"), "left_anti")
        kept = kept.join(accounts, owner == F.col("__account"), "left_anti")
    else:
        kept = resources.where(
            ~arn_account(arn).eqNullSafe(excluded_account) & ~owner.eqNullSafe(excluded_account)
        )
    if isinstance(excluded_patterns, DataFrame):
        hits = matching_values(kept, "Arn", excluded_patterns)
        kept = kept.where(arn.isNotNull()).join(hits, "Arn", "left_anti")
    else:
        for pattern in excluded_patterns:
            kept = kept.where(~arn.contains(pattern))
    if isinstance(monitored, DataFrame):
        types = monitored.select(F.col(monitored.columns[0]).alias("ResourceType"))
        kept = kept.join(types, "ResourceType", "left_semi")
    else:
        kept = kept.where(F.col("ResourceType").isin(*monitored))
    return (
        kept.join(regions.withColumnRenamed("region", "Region"), "Region")
        .join(aliases.withColumnRenamed("account_id", "OwningAccountId"), "OwningAccountId", "left")
        .select(
            F.col("label").alias("region_label"),
            F.concat(F.lit(alias_prefix), F.coalesce("alias", "OwningAccountId")).alias("account"),
            F.col("Arn").alias("arn"),
        )
    )


def report_line() -> Column:
    """Fixed-width line of the text report."""
    return F.format_string("%-5s %-18s  %s", "region_label", "account", "arn")


def should_alert(untagged: DataFrame) -> DataFrame:
    """One row: number of resources, length of the report, and whether to send it."""
    body = F.coalesce(F.sum(F.length(report_line()) + 1), F.lit(0))
    return untagged.agg(
        F.count(F.lit(1)).alias("n_resources"),
        (F.lit(len(REPORT_HEADER) + 1) + body).alias("report_length"),
    ).withColumn("should_alert", F.col("report_length") > MIN_ALERT)
