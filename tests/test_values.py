"""Column functions on single values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tillhouse.functions import values as V
from tillhouse.functions.arrays import first_payment_type, tip_total
from tillhouse.functions.windows import each_day, week_windows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def text(value):
    return F.lit(value).cast("string")


def number(value):
    return F.lit(value).cast("double")


@pytest.mark.parametrize(
    "raw, expected",
    [("20260208", "2026-02-08"), ("2026-02-08", "2026-02-08"), ("20251399", "2025-13-99"), ("2025", "2025"), (None, None)],
)
def test_iso_day(spark, raw, expected):
    assert one(spark, V.iso_day(text(raw))) == expected


@pytest.mark.parametrize(
    "raw, expected", [("2026-02-08", dt.date(2026, 2, 8)), ("2025-13-99", None), ("2025", None), ("", None), (None, None)]
)
def test_to_day(spark, raw, expected):
    assert one(spark, V.to_day(text(raw))) == expected


@pytest.mark.parametrize(
    "raw, suffix", [("+0000", "Z"), ("-0000", "Z"), ("Z", "Z"), ("+0530", "+0530")]
)
def test_utc_suffix(spark, raw, suffix):
    stamp = "2026-02-08T04:26:03.864"
    assert one(spark, V.utc_suffix(text(stamp + raw))) == stamp + suffix


@pytest.mark.parametrize("offset, minutes", [("+0000", 0), ("-0000", 0), ("Z", 0), ("+0530", 330)])
def test_to_instant(spark, offset, minutes):
    raw = text("2026-02-08T04:26:03.864" + offset)
    utc = dt.datetime(2026, 2, 8, 4, 26, 3, 864000) - dt.timedelta(minutes=minutes)
    assert one(spark, V.to_instant(raw).cast("timestamp_ntz")) == utc


@pytest.mark.parametrize("raw", ["junk", "", "2026", "12:30:00"])
def test_to_instant_needs_a_date(spark, raw):
    assert one(spark, V.to_instant(text(raw))) is None


@pytest.mark.parametrize(
    "first, second, expected", [("a", "b", "a"), ("", "b", "b"), (None, "b", "b"), ("", None, None), (None, "", "")]
)
def test_first_text(spark, first, second, expected):
    assert one(spark, V.first_text(text(first), text(second))) == expected


@pytest.mark.parametrize(
    "first, second, expected", [(7.0, 8.0, 7.0), (0.0, 7.0, 7.0), (None, 7.0, 7.0), (None, None, 0.0), (-1.0, 2.0, -1.0)]
)
def test_first_number(spark, first, second, expected):
    assert one(spark, V.first_number(number(first), number(second))) == expected


PAYMENTS = "array<struct<tipAmount:double,type:string>>"


@pytest.mark.parametrize(
    "payments, tip, kind",
    [
        (None, 0.0, None),
        ([], 0.0, None),
        ([(1.5, None), (None, "CASH"), (2.0, "CARD")], 3.5, "CASH"),
        ([(1.0, ""), (1.0, "CARD")], 2.0, ""),
    ],
)
def test_payments(spark, payments, tip, kind):
    row = spark.createDataFrame([(payments,)], f"p {PAYMENTS}").select(
        tip_total(F.col("p")).alias("tip"), first_payment_type(F.col("p")).alias("kind")
    )
    assert tuple(row.first()) == (tip, kind)


def day(text_value):
    return F.lit(dt.date.fromisoformat(text_value))


def test_week_windows(spark):
    windows = one(spark, week_windows(day("2025-01-01"), day("2025-01-17")))
    assert [(w.week_start.day, w.week_end.day) for w in windows] == [(1, 7), (8, 14), (15, 17)]


def test_no_window_when_the_range_is_reversed(spark):
    assert one(spark, week_windows(day("2025-01-02"), day("2025-01-01"))) is None
    assert one(spark, each_day(day("2025-01-02"), day("2025-01-01"))) is None


@pytest.mark.parametrize("length", [1, 6, 7, 8, 20])
def test_windows_tile_the_range(spark, length):
    start = dt.date(2024, 2, 20)
    end = start + dt.timedelta(days=length - 1)
    windows = one(spark, week_windows(F.lit(start), F.lit(end)))
    days = [w.week_start + dt.timedelta(days=i) for w in windows for i in range((w.week_end - w.week_start).days + 1)]
    assert days == one(spark, each_day(F.lit(start), F.lit(end)))
    assert days == [start + dt.timedelta(days=i) for i in range(length)]
