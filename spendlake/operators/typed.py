"""Typed line items from all-text rows, by the declared schema and never by inference."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions import maps, times
from spendlake.sources.schema import cur_schema

# Columns that are text whatever they look like; blanks become ''.
STRING_COLUMNS = (
    "line_item_usage_account_id",
    "bill_payer_account_id",
    "line_item_resource_id",
    "product_region",
    "line_item_operation",
    "line_item_line_item_type",
    "product_product_family",
    "line_item_usage_type",
    "pricing_term",
    "product_from_account_id",
    "product_to_account_id",
    "pricing_plan_arn",
    "resource_id",
    "bill_invoice_id",
)

# Columns holding times.
TIME_COLUMNS = (
    "line_item_usage_start_date",
    "line_item_usage_end_date",
    "bill_billing_period_start_date",
    "bill_billing_period_end_date",
)

# Columns holding JSON maps.
MAP_COLUMNS = ("cost_category", "discount", "product", "resource_tags")

# Cell texts that the reader of the original exports takes for missing.
MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


_MISSING_SQL = ", ".join(f"'{w}'" for w in MISSING_WORDS)


def present_text(name: str) -> str:
    """SQL for a text column in which the words for a missing value are NULL."""
    return f"CASE WHEN `{name}` NOT IN ({_MISSING_SQL}) THEN `{name}` END"


def to_typed(rows: DataFrame, maps_as: str = "text") -> DataFrame:
    """Casts every column to its type: one projection, no shuffle.

    ``maps_as`` is ``text`` for normalised JSON text, or ``map`` for real map columns as the
    billing table declares them (text that is no object is then NULL).
    """
    if maps_as not in ("text", "map"):
        raise ValueError(f"maps_as must be 'text' or 'map', got {maps_as!r}")
    declared = {f.name: f.dataType for f in cur_schema().fields}
    fields = rows.schema.fields
    # What generated code settles is a column first: used twice, it is not merged with the rest,
    # whose lambdas would take the whole projection out of generated code.
    ways = {f.name: _map_ways(f, maps_as) for f in fields if f.name in MAP_COLUMNS}
    ways = {name: w for name, w in ways.items() if w is not None}
    quick = {f"__quick_{name}": F.expr(w[0]) for name, w in ways.items()}
    if quick:
        rows = rows.withColumns(quick)
    columns = []
    for f in fields:
        if f.name in ways:
            done = f"__quick_{f.name}"
            column = F.expr(f"CASE WHEN {done} IS NOT NULL THEN {done} ELSE {ways[f.name][1]} END")
        else:
            column = _typed(f.name, f.dataType, declared.get(f.name))
        columns.append(column.alias(f.name))
    return rows.select(*columns)


def _typed(name: str, actual: T.DataType, declared: T.DataType | None) -> Column:
    column = F.expr(present_text(name) if isinstance(actual, T.StringType) else f"`{name}`")
    if name in MAP_COLUMNS:  # a map that stays one
        return column
    if name in STRING_COLUMNS:
        return F.coalesce(column.cast("string"), F.lit(""))
    if name in TIME_COLUMNS:
        return times.truncate_millis(times.written_clock(column, actual))
    if isinstance(declared, T.DoubleType):
        return column.try_cast("double")
    if declared is None or isinstance(declared, T.StringType):
        # Undeclared numbers keep their kind; text stays text.
        if isinstance(actual, (T.FloatType, T.DoubleType)):
            return column.cast("double")
        if isinstance(actual, T.IntegralType):
            return column.cast("bigint")
        return column.cast("string")
    return column.cast(declared)


def _map_ways(field: T.StructField, maps_as: str) -> maps.Ways | None:
    text = present_text(field.name) if isinstance(field.dataType, T.StringType) else f"`{field.name}`"
    if isinstance(field.dataType, T.MapType):
        if maps_as == "map":
            return None
        text = f"to_json({text})"
    if field.name == "discount":
        return maps.discount_text_ways(text) if maps_as == "text" else maps.double_map_ways(text)
    return maps.map_text_ways(text) if maps_as == "text" else maps.string_map_ways(text)
