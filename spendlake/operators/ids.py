"""Rows whose text contains any id of a list (a substring semi join)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.operators.skew import salted_join

# Up to this many ids are tested one by one inside generated code.
INLINE_IDS = 32

LINE_ID = "identity_line_item_id"


def contains_any(column: Column, ids: Sequence[str]) -> Column:
    """True where the text contains one of a few ids; NULL text never matches."""
    if not ids:
        return F.lit(False)
    tests = [column.contains(i) for i in ids]
    while len(tests) > 1:  # a balanced tree: deep chains are slow to plan
        tests = [
            tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i]
            for i in range(0, len(tests), 2)
        ]
    return tests[0]


def matching_values(rows: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """The distinct values of ``column`` that contain any id.

    Instead of testing every value against every id, each distinct value is cut into its
    substrings of the lengths that ids have, and those are equi-joined with the ids. The
    work is distinct values x text length x lengths, whatever the number of ids. All values
    share substrings such as their prefix, so the join is salted by the value.
    """
    wanted = ids.select(F.col(ids.columns[0]).alias("__id")).where(F.length("__id") > 0).distinct()
    lengths = wanted.agg(F.collect_set(F.length("__id"))).scalar()
    starts = F.sequence(F.lit(1), F.length(column) - F.col("__n") + 1)
    pieces = (
        rows.select(column)
        .where(F.col(column).isNotNull())
        .distinct()
        .select(column, F.explode(lengths).alias("__n"))
        .where(F.col("__n") <= F.length(column))
        .select(column, "__n", F.explode(starts).alias("__at"))
        .select(column, F.substr(column, F.col("__at"), F.col("__n")).alias("__id"))
    )
    found = salted_join(pieces, wanted, ["__id"], "left_semi", [column])
    return found.select(column).distinct()


def matches_any_id(
    rows: DataFrame,
    column: str,
    ids: Sequence[str] | DataFrame,
    salt_by: Sequence[str] | None = None,
    slices: int = 16,
) -> DataFrame:
    """Rows whose ``column`` contains any id; rows are never duplicated.

    ``ids`` is a list, or a DataFrame of one column. A long list becomes a DataFrame. A hot
    value is spread over ``slices`` tasks by a hash of ``salt_by`` (default: the identity of
    a line item, or every column that can be hashed).
    """
    if not isinstance(ids, DataFrame):
        ids = usable_ids(ids)
        if len(ids) <= INLINE_IDS:
            return rows.where(contains_any(F.col(column), ids))
        ids = ids_frame(rows.sparkSession, ids)
    hits = matching_values(rows, column, ids)
    if salt_by is None and LINE_ID in rows.columns:
        salt_by = [LINE_ID]
    elif salt_by is None:
        salt_by = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    return salted_join(rows, hits, [column], "left_semi", salt_by, slices)


def ids_frame(spark: SparkSession, ids: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(i,) for i in usable_ids(ids)], "id string")


def usable_ids(ids: Sequence[str | None]) -> list[str]:
    """Different ids in order; an empty or missing one would match everything or nothing."""
    return list(dict.fromkeys(i for i in ids if i))
