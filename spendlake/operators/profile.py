"""Column storage and column quality."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions import amounts

# Bytes of one stored value, by type.
_WIDTHS: dict[type[T.DataType], int] = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.DateType: 4,
    T.FloatType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
}


def _value_bytes(column: Column, dtype: T.DataType) -> Column:
    """Bytes that the values of a column hold."""
    if isinstance(dtype, T.DecimalType):
        width = 8 if dtype.precision <= 18 else 16
    else:
        width = _WIDTHS.get(type(dtype))
    if width is not None:
        return F.count(column) * width
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        sizes = F.octet_length(column)
    elif isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        sizes = F.octet_length(F.to_json(column))
    else:
        sizes = F.octet_length(column.cast("string"))
    return F.coalesce(F.sum(sizes.cast("bigint")), F.lit(0))


def _nulls(column: Column, dtype: T.DataType) -> Column:
    missing = column.isNull()
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        missing = missing | F.isnan(column)
    return F.count_if(missing)


def column_profile(table: DataFrame, nulls: bool = True, sizes: bool = True) -> DataFrame:
    """One row per column: type, rows, NULLs, value bytes and share of all value bytes.

    All columns are measured in one aggregate pass that carries one row per task to the
    final step; the rows per column are unfolded from that one row. ``nulls`` and ``sizes``
    leave out what is not needed.
    """
    measures, rows, total = [], [], F.lit(0).cast("bigint")
    for i, f in enumerate(table.schema.fields):
        column = F.col(f"`{f.name}`")
        row = [F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type")]
        if nulls:
            measures.append(_nulls(column, f.dataType).alias(f"nulls_{i}"))
            row.append(F.col(f"nulls_{i}").alias("nulls"))
        if sizes:
            measures.append(_value_bytes(column, f.dataType).alias(f"bytes_{i}"))
            row.append(F.col(f"bytes_{i}").alias("value_bytes"))
            total = total + F.col(f"bytes_{i}")
        rows.append(F.struct(*row))
    summed = table.agg(F.count(F.lit(1)).alias("n_rows"), *measures)
    unfolded = summed.select("n_rows", total.alias("total"), F.explode(F.array(*rows)).alias("c"))
    columns = [F.col("c.column"), F.col("c.type"), F.col("n_rows")]
    if nulls:
        missing = percent(F.col("c.nulls"), F.col("n_rows"))
        columns += [F.col("c.nulls"), missing.alias("null_percent")]
    if sizes:
        share = percent(F.col("c.value_bytes"), F.col("total"))
        columns += [F.col("c.value_bytes"), share.alias("share_percent")]
    return unfolded.select(*columns)


def percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * F.lit(100.0) / whole).otherwise(F.lit(0.0))


def top_nulls(profile: DataFrame, top: int = 10) -> DataFrame:
    """The columns with most NULLs; ties by name."""
    return (
        profile.select("column", "nulls", "n_rows", "null_percent")
        .orderBy(F.desc("nulls"), "column")
        .limit(top)
    )


def by_size(profile: DataFrame) -> DataFrame:
    """Bytes per column, largest first, with their share."""
    return profile.select("column", "type", "value_bytes", "share_percent").orderBy(
        F.desc("value_bytes"), "column"
    )


def by_type(profile: DataFrame) -> DataFrame:
    """Types: number of columns, their NULLs and bytes."""
    return profile.groupBy("type").agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.sum("nulls").alias("nulls"),
        F.sum("value_bytes").alias("value_bytes"),
    )


def null_profile(table: DataFrame, top: int = 10) -> DataFrame:
    return top_nulls(column_profile(table, sizes=False), top)


def files_without_counts(chunks: DataFrame) -> DataFrame:
    """``path`` of files whose footer does not count the NULLs of each plain column."""
    return chunks.where("flat AND null_count IS NULL").select("path").distinct()


def footer_nulls(chunks: DataFrame) -> DataFrame:
    """``column``, ``nulls``, ``n_rows`` of the plain columns, over the files whose footers count.

    A file that lacks a column has a NULL for each of its rows. Lists, maps and structs, whose
    parts are what a footer counts, are not in the result.
    """
    silent = files_without_counts(chunks).withColumn("silent", F.lit(True))
    marked = chunks.join(silent, "path", "left")
    counts = lambda c: F.coalesce(F.sum(F.when(F.col("silent").isNull(), F.col(c))), F.lit(0))
    first = marked.where("ordinal = 0").agg(counts("num_rows").alias("n"))
    return (
        marked.groupBy("column")
        .agg(
            F.bool_and("flat").alias("flat"), counts("null_count").alias("nulls"), counts("num_rows").alias("n")
        )
        .where("flat")
        .withColumn("n_rows", first.scalar())
        .select("column", (F.col("nulls") + F.col("n_rows") - F.col("n")).alias("nulls"), "n_rows")
    )


def value_bytes(table: DataFrame) -> DataFrame:
    return by_size(column_profile(table, nulls=False))


def type_histogram(table: DataFrame) -> DataFrame:
    return by_type(column_profile(table))


def shape(table: DataFrame) -> DataFrame:
    """One row: number of rows and columns."""
    return table.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_columns", F.lit(len(table.columns)).cast("bigint")
    )


def storage_profile(chunks: DataFrame) -> DataFrame:
    """Stored bytes per column from footer rows (see ``sources.footers``), largest first.

    Keyed by the full path of the column: leaf names of maps are all ``key`` and ``value``.
    """
    return (
        chunks.groupBy("column")
        .agg(
            F.array_join(F.array_sort(F.collect_set("physical_type")), "|").alias("physical_type"),
            F.sum("compressed").alias("compressed"),
            F.sum("uncompressed").alias("uncompressed"),
            F.sum("num_values").alias("num_values"),
        )
        .withColumns(_size_texts())
        .orderBy(F.desc("compressed"), "column")
    )


def storage_totals(chunks: DataFrame) -> DataFrame:
    """One row over all columns, with the number of stored rows."""
    return chunks.agg(
        F.count_distinct("column").alias("n_columns"),
        # Every row group states its rows once per column chunk; count its first chunk only.
        F.sum(F.when(F.col("ordinal") == 0, F.col("num_rows"))).alias("n_rows"),
        F.sum("compressed").alias("compressed"),
        F.sum("uncompressed").alias("uncompressed"),
    ).withColumns(_size_texts())


def storage_report(chunks: DataFrame) -> DataFrame:
    """The storage profile as text, largest column first, total last."""
    # Grouping sets, not a second aggregate on top: footers are read once.
    types = F.array_join(F.array_sort(F.collect_set("physical_type")), "|")
    rows = chunks.groupingSets([[F.col("column")], []], "column").agg(
        F.grouping("column").alias("last"),
        types.alias("type"),
        F.sum("compressed").alias("compressed"),
        F.sum("uncompressed").alias("uncompressed"),
    )
    total = F.col("last") == 1
    rows = rows.withColumns(
        {
            "column": F.when(total, "TOTAL").otherwise(F.col("column")),
            "type": F.when(total, "").otherwise(F.col("type")),
        }
    )
    return rows.orderBy("last", F.desc("compressed"), "column").select(
        "column",
        "type",
        amounts.human_bytes(F.col("compressed")).alias("compressed"),
        amounts.human_bytes(F.col("uncompressed")).alias("uncompressed"),
        amounts.ratio_text(F.col("uncompressed"), F.col("compressed")).alias("ratio"),
    )


def quality_report(table: DataFrame) -> DataFrame:
    """The column profile as text, largest column first."""
    return profile_report(column_profile(table))


def profile_report(profile: DataFrame) -> DataFrame:
    rows = profile.orderBy(F.desc("value_bytes"), "column")
    return rows.select(
        "column",
        "type",
        amounts.count_text(F.col("n_rows")).alias("rows"),
        amounts.count_text(F.col("nulls")).alias("nulls"),
        amounts.percent_text(F.col("nulls"), F.col("n_rows")).alias("null_percent"),
        amounts.human_bytes(F.col("value_bytes")).alias("size"),
    )


def _size_texts() -> dict[str, Column]:
    return {
        "ratio": amounts.ratio(F.col("uncompressed"), F.col("compressed")),
        "compressed_text": amounts.human_bytes(F.col("compressed")),
        "uncompressed_text": amounts.human_bytes(F.col("uncompressed")),
    }
