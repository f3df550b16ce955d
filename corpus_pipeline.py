"""From raw documents to token ids: quality, near-duplicates, secrets, mixture, encoding.

Each stage takes the documents that the one before kept; all but the last return the columns of
documents. ``run`` writes every stage as Parquet to the shared scratch folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm.bpe_sql import bpe_documents
from spendlake.llm.common import dropped, stored, table
from spendlake.llm.mixing import mixed_documents
from spendlake.llm.quality import quality_documents
from spendlake.llm.secret_scan import masked_documents
from spendlake.llm.shingles import distinct_documents

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects what fails the base limits or meets a rule learned from the labels."""
    return quality_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates: five words, a similarity of 0.8."""
    return distinct_documents(docs, k=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its secrets masked."""
    return masked_documents(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole, in order of training position."""
    return mixed_documents(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, token_ids (binary, 32-bit), round_trip (decodes to the text)."""
    carry = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    named = docs.select(*carry, "text", F.coalesce("text", F.lit("")).alias("given"))
    return bpe_documents(named, carry=(*carry, "given")).select(
        *carry, "n_tokens", "token_ids", (F.col("decoded") == F.encode("given", "UTF-8")).alias("round_trip")
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("near-duplicates", near_dedup),
    ("secret scan", secrets),
    ("mixture", mixture),
    ("encoding", encoding),
]

# Learned rules, a forest and recursive encoding are not SQL over the tables: tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``: doc_id, lang, source, n_tokens, token_ids, round_trip.

    A row for each time that the mix takes a document. NULL and empty texts fail the quality limits;
    rows without id pass near-duplicate detection as they are; of rows that share id and text one
    stays; other columns of the table, whatever their names, change nothing; without labels the
    base limits alone decide on quality; empty tables give an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        done = stored(stage(spark, docs, sf_dir), f"stage{i}")
        if i:
            dropped(docs)
        docs = done
    return docs
