import datetime as dt
from decimal import Decimal

import pytest

from tidemark.functions import (
    clean_name, clock_kind, clock_seconds, clock_text, initcap, number_text, parse_clock, set_flag,
    try_date, try_numeric, try_ts,
)

D = dt.date(2024, 1, 2)
T = dt.datetime(2024, 1, 2, 10, 20, 30)

CASTS = [
    # text, timestamp, date, numeric, time of day, kind
    ("2024-01-02 10:20:30", T, D, None, None, "invalid"),
    ("2024-01-02T10:20:30", T, D, None, None, "invalid"),
    ("  2024-01-02 10:20:30 ", T, D, None, None, "invalid"),
    ("2024-01-02", dt.datetime(2024, 1, 2), D, None, None, "invalid"),
    ("2024-1-2", dt.datetime(2024, 1, 2), D, None, None, "invalid"),
    ("2024-02-30", None, None, None, None, "invalid"),
    ("2024-01-02 10:99", None, None, None, None, "invalid"),
    ("2024", None, None, Decimal(2024), None, "invalid"),
    ("2024-01-02Tgarbage", None, None, None, None, "invalid"),
    ("2024-01-02 10:20:30+05:00", None, None, None, None, "invalid"),
    ("2024-01-02\n", None, None, None, None, "invalid"),
    ("today", None, None, None, None, "invalid"),
    ("10:20", None, None, None, "10:20:00", "clock"),
    ("9:05:10", None, None, None, "09:05:10", "clock"),
    ("09:05:10.250", None, None, None, "09:05:10.25", "clock"),
    ("10:00:00.000", None, None, None, "10:00:00", "clock"),
    ("24:00:00", None, None, None, "24:00:00", "clock"),
    ("24:00:01", None, None, None, None, "over24h"),
    ("26:10:00", None, None, None, None, "over24h"),
    ("10:61", None, None, None, None, "invalid"),
    ("11136.0", None, None, Decimal(11136), None, "invalid"),
    (" -1.5e2 ", None, None, Decimal(-150), None, "invalid"),
    ("NaN", None, None, None, None, "invalid"),
    ("1_000", None, None, None, None, "invalid"),
    ("1e999", None, None, None, None, "invalid"),
    ("1.123456789012", None, None, None, None, "invalid"),
    ("1.12345678900000", None, None, Decimal("1.123456789"), None, "invalid"),
    ("1230e-12", None, None, None, None, "invalid"),
    ("12300e-12", None, None, Decimal("0.0000000123"), None, "invalid"),
    ("9" * 28, None, None, Decimal("9" * 28), None, "invalid"),
    ("9" * 30, None, None, None, None, "invalid"),
    ("0.000000000000", None, None, Decimal(0), None, "invalid"),
    ("2024-01-02 10:20:30.123456000", dt.datetime(2024, 1, 2, 10, 20, 30, 123456), D, None, None, "invalid"),
    ("2024-01-02 10:20:30.123456789", None, None, None, None, "invalid"),
    ("12345:10:00", None, None, None, None, "over24h"),
    ("", None, None, None, None, "empty"),
    ("  ", None, None, None, None, "empty"),
    (None, None, None, None, None, "empty"),
]


def test_guarded_casts(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASTS)], "i int, x string")
    got = df.select("i", try_ts("x"), try_date("x"), try_numeric("x"), clock_text("x"), clock_kind("x")).orderBy("i").collect()
    for row, case in zip(got, CASTS):
        assert tuple(row)[1:] == case[1:], case[0]


def test_durations_are_seconds(spark):
    df = spark.createDataFrame([("26:10:00",), ("9:05",), ("100:00:00.5",), ("10:61",), ("99999999:00",)], "x string")
    got = df.select(clock_seconds("x"), parse_clock("x")).collect()
    assert [r[0] for r in got] == [Decimal(94200), Decimal(32700), Decimal("360000.5"), None, Decimal(99999999 * 3600)]
    assert [r[1] for r in got][:4] == [
        dt.timedelta(hours=26, minutes=10), dt.timedelta(hours=9, minutes=5),
        dt.timedelta(hours=100, milliseconds=500), None,
    ]


@pytest.mark.parametrize("value,expected", [
    (None, False), ("", False), ("  ", False), ("Yes", True), (" x ", True), ("\t", True),
])
def test_flag(spark, value, expected):
    df = spark.createDataFrame([(value,)], "x string")
    assert df.select(set_flag("x")).first()[0] is expected


def test_numbers_read_like_python_floats(spark):
    values = [0.0, -0.0, 1.0, 0.1, 1e-3, 9.99e-4, 1e-4, 9.9e-5, 1.5e-5, 1e-10, 9999999.0, 1e7, 12345678.5, 1e15,
              123456789012345.6, 9007199254740992.0, 1e16, 1.2345e22, 1e100, -1e7, -1.5e-5, float("nan"),
              float("inf"), float("-inf"), 11136.0, 1.2345678901234567e-4, -9.87654321e-4, 1.2345678901234567e15, 2e7, -1.05e8]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(number_text("x")).collect()]
    assert got == [str(v) for v in values]
    assert spark.createDataFrame([(None,)], "x double").select(number_text("x")).first()[0] is None


def test_names(spark):
    df = spark.createDataFrame([("o'NEIL-smith VILLAGE_two",), ("été\x07 ßen 2nd x2y",)], "x string")
    assert [r[0] for r in df.select(initcap("x")).collect()] == ["O'Neil-Smith Village_Two", "Été\x07 ßen 2nd X2y"]
    assert df.select(clean_name("x")).collect()[1][0] == "Été ßen 2nd X2y"
