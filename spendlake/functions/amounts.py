"""Amounts: exact sums, money text, byte sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# 15 integer and 12 fraction digits. A sum has 25 integer digits, and the difference of two
# sums still fits 38 digits, beyond which Spark would round fractions off.
AMOUNT = T.DecimalType(27, 12)


def exact(column: Column, dtype: T.DataType) -> Column:
    """The amount as a decimal, so that sums do not depend on row order or file split.

    NaN counts as missing. A value that does not fit is an error: it is never dropped
    silently from a sum.
    """
    if isinstance(dtype, T.DecimalType):
        return column
    if isinstance(dtype, T.IntegralType):
        return column.cast(T.DecimalType(20, 0))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        present = column.isNotNull() & ~F.isnan(column)
    else:
        present = F.trim(column) != ""
    too_big = F.raise_error(F.concat(F.lit("amount out of range: "), column.cast("string")))
    return F.when(present, F.coalesce(column.try_cast(AMOUNT), too_big.cast(AMOUNT)))


def total(column: Column, dtype: T.DataType) -> Column:
    """Sum in which nothing to add gives 0, not NULL."""
    return F.coalesce(F.sum(exact(column, dtype)), F.lit(0))


def fixed_text(column: Column) -> Column:
    """Decimal with two fraction digits as text, half up."""
    return F.round(column, 2).cast("string")


def money_text(column: Column) -> Column:
    """``$12.30``; a negative amount is ``$-12.30``."""
    return F.concat(F.lit("$"), fixed_text(column))


_UNITS = ("B", "KB", "MB", "GB", "TB")


def human_bytes(column: Column) -> Column:
    """``13.73 GB``: largest unit of 1024 that leaves less than 1024, two decimals, half even.

    Whole-number arithmetic, so ties (1152 bytes is exactly 1.125 KB) are seen as ties.
    """
    size = column.cast("bigint")
    text = None
    for power in reversed(range(len(_UNITS))):
        unit = 1024**power
        hundredths = size * 100
        whole = F.call_function("div", hundredths, F.lit(unit))
        rest = (hundredths - whole * unit) * 2
        up = (rest > unit) | ((rest == unit) & (whole % 2 == 1))
        cents = whole + F.when(up, 1).otherwise(0)
        number = F.concat(
            F.call_function("div", cents, F.lit(100)).cast("string"),
            F.lit("."),
            F.lpad((cents % 100).cast("string"), 2, "0"),
            F.lit(f" {_UNITS[power]}"),
        )
        text = number if text is None else F.when(size < unit * 1024, number).otherwise(text)
    return text


def count_text(column: Column) -> Column:
    """``1,234``."""
    return F.format_number(column, 0)


def percent_text(part: Column, whole: Column) -> Column:
    """``12.3%`` of two whole numbers, half up; ``0.0%`` of nothing."""
    tenths = F.call_function("div", part * 2000 + whole, whole * 2)
    text = F.concat(
        F.call_function("div", tenths, F.lit(10)).cast("string"),
        F.lit("."),
        (tenths % 10).cast("string"),
        F.lit("%"),
    )
    return F.when(whole > 0, text).otherwise(F.lit("0.0%"))


def ratio_text(uncompressed: Column, compressed: Column) -> Column:
    """``2.31x`` of two whole numbers, half up; ``0.00x`` when nothing is stored."""
    hundredths = F.call_function("div", uncompressed * 200 + compressed, compressed * 2)
    text = F.concat(
        F.call_function("div", hundredths, F.lit(100)).cast("string"),
        F.lit("."),
        F.lpad((hundredths % 100).cast("string"), 2, "0"),
        F.lit("x"),
    )
    return F.when(compressed > 0, text).otherwise(F.lit("0.00x"))


def ratio(uncompressed: Column, compressed: Column) -> Column:
    """Uncompressed over compressed size, 0 when nothing is stored."""
    return F.when(
        compressed > 0, uncompressed.cast("double") / compressed.cast("double")
    ).otherwise(F.lit(0.0))
