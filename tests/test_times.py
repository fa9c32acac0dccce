from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from wirecount.functions import times


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(
        f"{n} {'timestamp' if isinstance(v, datetime) else 'string'}" for n, v in values.items()))
    return df.select(column).first()[0]


@pytest.mark.parametrize("published, expected", [
    ("2023-11-13T23:43:15Z", 1699918995000),
    ("2023-11-13T23:43:15.500Z", 1699918995500),
    ("2023-11-13T23:43:15+02:00", 1699911795000),
    ("Mon, 13 Nov 2023 23:43:15 GMT", 1699918995000),
    ("Mon, 13 Nov 2023 23:43:15 +0200", 1699911795000),
    ("2023-11-13T23:43:15", 1699918995000),
    ("2023-11-13", 1699833600000),
    ("Mon, 3 Nov 2023 23:43:15 GMT", 1699054995000),
    ("Mon, 13 Nov 2023 23:43:15 EST", None),
    ("2023", None),
    ("2023-02-31T00:00:00Z", None),
    ("junk", None),
    ("", None),
    (None, None),
])
def test_published_millis(spark, published, expected):
    assert one(spark, times.published_millis(F.col("p")), p=published) == expected


@pytest.mark.parametrize("published, true, wall", [
    ("Mon, 13 Nov 2023 23:43:15 +0200", "2023-11-13T21:43:15Z", "2023-11-13T23:43:15Z"),
    ("2023-11-13T23:43:15+02:00", "2023-11-13T21:43:15Z", "2023-11-13T23:43:15Z"),
    ("2023-11-13T23:43:15.5Z", "2023-11-13T23:43:15.500000Z", "2023-11-13T23:43:15.500000Z"),
    ("2023-11-13T23:43:15", "2023-11-13T23:43:15Z", "2023-11-13T23:43:15Z"),
    ("junk", None, None),
])
def test_published_iso(spark, published, true, wall):
    assert one(spark, times.published_iso(F.col("p")), p=published) == true
    assert one(spark, times.published_iso(F.col("p"), wall_clock=True), p=published) == wall


@pytest.mark.parametrize("unit, start, end", [
    ("hour", "2023-12-31 23", "2024-01-01 00"),
    ("day", "2023-12-31 00:00:00", "2024-01-01 00:00:00"),
    ("month", "2023-12", "2024-01"),
])
def test_labels(spark, unit, start, end):
    ts = datetime(2023, 12, 31, 23, 59, 59)
    assert one(spark, times.label(F.col("t"), unit), t=ts) == start
    assert one(spark, times.label(F.col("t"), unit, "end"), t=ts) == end
    first = one(spark, times.label_start(F.col("l"), unit), l=start)
    assert one(spark, times.label_start(F.col("l"), unit, "end"), l=end) == first


def test_calendar(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 1, 30),)], "t timestamp")
    got = df.select(*(c.alias(n) for n, c in times.calendar(F.col("t")).items())).first()
    assert got.asDict() == {
        "today": "2024-01-01 00:00:00", "yesterday": "2023-12-31 01:30:00", "month": "2024-01",
        "previous_month": "2023-12", "next_month": "2024-02", "first_of_month": True}


def test_period_before():
    as_of = datetime(2024, 3, 1, 1, 30)
    day = lambda *d: datetime(*d, tzinfo=timezone.utc)
    assert times.period_before(as_of, "day") == (day(2024, 2, 29), day(2024, 3, 1))
    assert times.period_before(as_of, "month") == (day(2024, 2, 1), day(2024, 3, 1))
    east = datetime(2024, 3, 1, 1, 30, tzinfo=timezone(timedelta(hours=2)))
    assert times.period_before(east, "day") == (day(2024, 2, 28), day(2024, 2, 29))
    whole = times.whole_periods
    assert whole(datetime(2024, 1, 1), as_of, "month") == (day(2024, 1, 1), day(2024, 3, 1))
    assert whole(datetime(2024, 1, 1, 1), as_of, "month") == (day(2024, 2, 1), day(2024, 3, 1))
    assert whole(datetime(2024, 1, 1, 1), as_of, "day") == (day(2024, 1, 2), day(2024, 3, 1))


@pytest.mark.parametrize("text, expected", [
    ("", 0), (None, 0), ("  ", 0), ("17", 17), (" 17 ", 17), ("x", None), ("1.5", None)])
def test_blank_to(spark, text, expected):
    assert one(spark, times.blank_to(F.col("x"), 0), x=text) == expected


def test_epochs(spark):
    df = spark.createDataFrame([(1585740119001, 1585740119)], "ms long, s long")
    got = df.select(times.from_epoch(F.col("ms")), times.from_epoch(F.col("s"), "s")).first()
    assert got == (datetime(2020, 4, 1, 11, 21, 59, 1000), datetime(2020, 4, 1, 11, 21, 59))
