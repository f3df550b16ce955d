from datetime import datetime
from decimal import Decimal

import json
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.functions import amounts, maps, times

def one(spark, ddl, values, column):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {ddl}")
    return [r["o"] for r in frame.select("i", column(F.col("x")).alias("o")).orderBy("i").collect()]


def test_human_bytes(spark):
    sizes = [0, 1023, 1024, 1536, 1152, 1664, 14744759553, 2**40, 5 * 2**50, None]
    assert one(spark, "bigint", sizes, lambda x: amounts.human_bytes(x)) == [
        "0.00 B", "1023.00 B", "1.00 KB", "1.50 KB", "1.12 KB", "1.62 KB", "13.73 GB",
        "1.00 TB", "5120.00 TB", None,
    ]


def test_human_bytes_like_float_formatting(spark):
    def formatted(size):
        value = float(size)
        for unit in ("B", "KB", "MB", "GB"):
            if value < 1024:
                return f"{value:.2f} {unit}"
            value /= 1024
        return f"{value:.2f} TB"

    sizes = [7**k for k in range(18)] + [2**k + 2 ** (k - 3) for k in range(3, 50)]
    assert one(spark, "bigint", sizes, lambda x: amounts.human_bytes(x)) == [formatted(s) for s in sizes]


def test_count_percent_and_ratio_text(spark):
    frame = spark.createDataFrame([(1234567, 3), (1, 3), (1, 2000), (0, 0)], "a bigint, b bigint")
    got = frame.select(
        amounts.count_text(F.col("a")),
        amounts.percent_text(F.col("a"), F.col("b")),
        amounts.ratio_text(F.col("a"), F.col("b")),
    ).collect()
    assert [tuple(r) for r in got] == [
        ("1,234,567", "41152233.3%", "411522.33x"), ("1", "33.3%", "0.33x"),
        ("1", "0.1%", "0.00x"), ("0", "0.0%", "0.00x"),
    ]


def test_money_text(spark):
    values = [Decimal(v) for v in ("0.125", "2.675", "-5", "1234567.891", "0")]
    assert one(spark, "decimal(30,12)", values, lambda x: amounts.money_text(x)) == [
        "$0.13", "$2.68", "$-5.00", "$1234567.89", "$0.00",
    ]


def test_exact_keeps_cents_and_counts_nan_as_missing(spark):
    values = [0.1, 0.2, float("nan"), None, 1e-7]
    got = one(spark, "double", values, lambda x: amounts.exact(x, T.DoubleType()))
    assert got == [Decimal("0.1"), Decimal("0.2"), None, None, Decimal("1E-7")]
    assert one(spark, "string", ["", "1.10", None], lambda x: amounts.exact(x, T.StringType()))[1] == Decimal("1.1")


@pytest.mark.parametrize("ddl,value", [("double", 1e30), ("double", float("inf")), ("string", "abc")])
def test_amount_that_does_not_fit_is_an_error(spark, ddl, value):
    dtype = T.DoubleType() if ddl == "double" else T.StringType()
    with pytest.raises(Exception, match="amount out of range"):
        one(spark, ddl, [value], lambda x: amounts.exact(x, dtype))


def test_times_do_not_depend_on_the_session_zone(spark):
    text = [
        "2025-03-09T02:30:00.123456Z",  # an hour that the session zone skips
        "2025-03-09 02:30:00+08:00",
        "2025-03-09",
        "no time",
        None,
    ]
    utc = one(spark, "string", text, lambda x: times.utc_clock(x, T.StringType()))
    assert utc == [
        datetime(2025, 3, 9, 2, 30, 0, 123456),
        datetime(2025, 3, 8, 18, 30),
        datetime(2025, 3, 9),
        None,
        None,
    ]

    def written(x):
        return times.truncate_millis(times.written_clock(x, T.StringType()))

    assert one(spark, "string", text, written)[:2] == [
        datetime(2025, 3, 9, 2, 30, 0, 123000),
        datetime(2025, 3, 9, 2, 30),
    ]
    assert one(spark, "string", text, lambda x: times.iso_millis(written(x)))[:3] == [
        "2025-03-09T02:30:00.123",
        "2025-03-09T02:30:00.000",
        "2025-03-09T00:00:00.000",
    ]


def test_truncation_cuts(spark):
    got = one(
        spark,
        "timestamp_ntz",
        [datetime(1960, 1, 1, 0, 0, 0, 999999), datetime(2025, 1, 1, 0, 0, 59, 999900)],
        lambda x: times.truncate_millis(x),
    )
    assert [g.microsecond for g in got] == [999000, 999000]


def test_instants_compare_in_utc(spark):
    frame = spark.sql(
        "select timestamp'2025-06-01 00:00:00+00:00' as a, timestamp'2025-07-01 00:00:00+00:00' as b"
    )
    kind = T.TimestampType()
    row = frame.select(
        times.in_month(F.col("a"), kind, "2025-06").alias("first"),
        times.in_month(F.col("b"), kind, "2025-06").alias("next"),
        times.utc_clock(F.col("a"), kind).alias("clock"),
    ).first()
    assert tuple(row) == (True, False, datetime(2025, 6, 1))


def test_month_ends(spark):
    values = [datetime(2025, 6, 30, 23, 59, 59, 999999), datetime(2025, 7, 1), datetime(2025, 6, 1)]
    assert one(spark, "timestamp_ntz", values, lambda x: times.in_month(x, T.TimestampNTZType(), "2025-06")) == [
        True, False, True,
    ]


def test_periods():
    assert times.month_bounds(times.current_period())
    assert times.add_months("2025-01", -3) == "2024-10"
    assert times.add_months("2024-11", 14) == "2026-01"
    assert times.month_bounds("2024-12") == ("2024-12-01", "2025-01-01")
    for bad in ("2025-13", "2025-1", "202501", "2025-01-01"):
        with pytest.raises(ValueError):
            times.month_bounds(bad)


OBJECTS = [
    ("", "{}"),
    (None, "{}"),
    ("xyz", "xyz"),
    ("{bad", "{bad"),
    ('{"a":1} tail', '{"a":1} tail'),
    ('{"a":1},{"b":2}', '{"a":1},{"b":2}'),
    ('{"a":"0.5"}', '{"a": "0.5"}'),
    ('{"c":true,"d":null,"e":"true"}', '{"c": "True", "d": "None", "e": "true"}'),
    ('{"a":1,"b":5,"a":2}', '{"b": "5", "a": "2"}'),
    ('{"q":"say \\"hi\\"\\n"}', '{"q": "say \\"hi\\"\\n"}'),
    ('{"n":{"b":1}}', '{"n": "{\\"b\\":1}"}'),
    (" {} ", "{}"),
]


def test_map_text(spark):
    got = one(spark, "string", [o[0] for o in OBJECTS], lambda _: maps.map_text("x"))
    assert got == [o[1] for o in OBJECTS]


def test_discount_text_falls_back_by_row(spark):
    texts = ['{"a":"0.5","b":2}', '{"a":"x","b":2}', '{"a":true}', '{"a":null}', '{"a":"1d"}', "xyz", ""]
    assert one(spark, "string", texts, lambda _: maps.discount_text("x")) == [
        '{"a": 0.5, "b": 2.0}', '{"a": "x", "b": "2"}', '{"a": 1.0}', '{"a": "None"}',
        '{"a": "1d"}', "xyz", "{}",
    ]
    assert one(spark, "string", texts, lambda _: maps.double_map("x")) == [
        {"a": 0.5, "b": 2.0}, None, {"a": 1.0}, None, None, None, {},
    ]


def test_json_or_default(spark):
    texts = [None, "", "{}", "[]", "0", "null", "false", '""', "text", '{"a":1}', "[1]"]
    empty = {"_empty": ""}
    assert one(spark, "string", texts, lambda _: maps.json_or_default("x")) == [
        *[empty] * 8, {"value": "text"}, {"a": "1"}, {"value": "[1]"},
    ]


def test_quick_and_slow_maps_agree(spark):
    """Every object also as the second of two equal names, which is never quick."""
    r = random.Random(7)
    texts = ["x", "a:b", "a,b", 'q"q', "b\\s", "}", "{", "é\n", "", ": ,", "null", "true", ':"true"', "1", "1e3", "-0.0"]
    numbers = [0, 1.5, -2, 1e20, 123456789012345678, 0.1]
    objects = []
    for _ in range(400):
        pool = r.choice([texts, numbers, numbers + texts, [*texts, None, True, False, [1], {"n": "a,b"}]])
        objects.append({r.choice(texts) + str(i): r.choice(pool) for i in range(r.randint(0, 5))})
    plain = [json.dumps(o, ensure_ascii=False, separators=r.choice([(",", ":"), (" , ", " : ")])) for o in objects]
    twice = ["{" + '"again":0' + ("," if o else "") + t.strip()[1:-1] + ',"again":7}' for o, t in zip(objects, plain, strict=True)]
    for f, last in ((maps.map_text, '"again": "7"'), (maps.discount_text, None)):
        quick = one(spark, "string", plain, lambda _, f=f: f("x"))
        slow = one(spark, "string", twice, lambda _, f=f: f("x"))
        for o, q, s in zip(objects, quick, slow, strict=True):
            end = last or ('"again": 7.0' if s.endswith("7.0}") else '"again": "7"')
            assert s == q[:-1] + (", " if o else "") + end + "}", (q, s)
    for f, kind in ((maps.string_map, str), (maps.double_map, float)):
        quick = one(spark, "string", plain, lambda _, f=f: f("x"))
        slow = one(spark, "string", twice, lambda _, f=f: f("x"))
        assert slow == [None if q is None else {**q, "again": kind(7)} for q in quick]
