"""Billing times. Everything here is independent of the session time zone.

Billing exports state times in UTC. The working type is therefore ``timestamp_ntz``
holding the UTC wall clock: ``to_date``, ``year``, ``month`` and comparisons on it never go
through the session zone, and a range on it is pushed down to the Parquet scan.
"""

from __future__ import annotations

import re
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PERIOD = re.compile(r"^(\d{4})-(0[1-9]|1[0-2])$")

# A time of day followed by a numeric offset, e.g. ``T08:00:00+08:00``.
_NUMERIC_OFFSET = r":\d{2}(\.\d+)?\s*[+-]\d{1,2}(:?\d{2})?$"


def current_period() -> str:
    """Current UTC month as ``YYYY-MM``."""
    return datetime.now(timezone.utc).strftime("%Y-%m")


def add_months(period: str, months: int) -> str:
    """``YYYY-MM`` moved by a number of months."""
    first = _month_start(period)
    index = first.year * 12 + first.month - 1 + months
    return f"{index // 12:04d}-{index % 12 + 1:02d}"


def month_bounds(period: str) -> tuple[str, str]:
    """First day of the month and of the next one, as ISO dates."""
    return _month_start(period).isoformat(), _month_start(add_months(period, 1)).isoformat()


def _month_start(period: str) -> date:
    match = _PERIOD.match(period)
    if match is None:
        raise ValueError(f"period must look like YYYY-MM, got {period!r}")
    return date(int(match.group(1)), int(match.group(2)), 1)


def in_month(column: Column, dtype: T.DataType, period: str) -> Column:
    """Half-open month range; a plain comparison for both timestamp types, so it pushes down."""
    start, end = month_bounds(period)
    if isinstance(dtype, T.TimestampType):
        # An instant column: the bounds are UTC instants whatever the session zone is.
        low = F.expr(f"timestamp'{start} 00:00:00+00:00'")
        high = F.expr(f"timestamp'{end} 00:00:00+00:00'")
        return (column >= low) & (column < high)
    low, high = F.expr(f"timestamp_ntz'{start}'"), F.expr(f"timestamp_ntz'{end}'")
    value = utc_clock(column, dtype)
    return (value >= low) & (value < high)


def utc_clock(column: Column, dtype: T.DataType) -> Column:
    """UTC wall clock as ``timestamp_ntz``; text that is no time becomes NULL."""
    if isinstance(dtype, T.TimestampNTZType):
        return column
    if isinstance(dtype, T.TimestampType):
        return _instant_to_utc_clock(column)
    if isinstance(dtype, T.StringType):
        # Naive text and text ending in Z already state UTC; other offsets are converted.
        return F.when(
            column.rlike(_NUMERIC_OFFSET), _instant_to_utc_clock(column.try_cast("timestamp"))
        ).otherwise(column.try_cast("timestamp_ntz"))
    return column.cast("timestamp_ntz")


def _instant_to_utc_clock(column: Column) -> Column:
    seconds = (F.unix_micros(column).cast("decimal(20,0)") / 1_000_000).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.expr("timestamp_ntz'1970-01-01'") + F.make_dt_interval(zero, zero, zero, seconds)


def written_clock(column: Column, dtype: T.DataType) -> Column:
    """Wall clock as written, any zone or offset dropped without moving the hour."""
    if isinstance(dtype, T.StringType):
        return column.try_cast("timestamp_ntz")
    return utc_clock(column, dtype)


def truncate_millis(clock: Column) -> Column:
    """Cut (not round) a ``timestamp_ntz`` to milliseconds."""
    zero = F.lit(0)
    excess = F.date_part(F.lit("SECOND"), clock) % F.lit("0.001").cast("decimal(3,3)")
    return clock - F.make_dt_interval(zero, zero, zero, excess.cast("decimal(18,6)"))


def iso_millis(clock: Column) -> Column:
    """``2025-06-01T00:00:00.000`` from a ``timestamp_ntz``."""
    text = F.replace(clock.cast("string"), F.lit(" "), F.lit("T"))
    dotted = F.when(text.contains("."), text).otherwise(F.concat(text, F.lit(".")))
    return F.rpad(F.substring(dotted, 1, 23), 23, "0")


def period_of(clock: Column) -> Column:
    """``YYYY-MM`` of a date or ``timestamp_ntz``."""
    return F.concat_ws("-", F.year(clock).cast("string"), F.format_string("%02d", F.month(clock)))
