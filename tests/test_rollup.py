from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wirecount.operators import rollup


def hours(spark, data):
    return spark.createDataFrame(data, "hour string, keyword string, count long")


@pytest.fixture
def january(spark):
    return hours(spark, [
        ("2024-01-15 00", "a", 1), ("2024-01-15 01", "a", 2), ("2024-01-15 02", "a", 4),
        ("2024-01-15 23", "a", 8), ("2024-01-16 00", "a", 16), ("2024-01-16 01", "a", 32)])


def test_calendar_day(spark, january):
    assert rows(rollup.roll_up(january, "day", as_of=datetime(2024, 1, 16, 1, 30))) == [
        ("2024-01-15 00:00:00", "a", 15)]


def test_labels_at_the_end(spark, january):
    got = rows(rollup.roll_up(january, "day", label_at="end", as_of=datetime(2024, 1, 16, 1, 30)))
    assert got == [("2024-01-16 00:00:00", "a", 2 + 4 + 8 + 16)]


def test_all_days_at_once(spark, january):
    assert rows(rollup.roll_up(january, "day")) == [
        ("2024-01-15 00:00:00", "a", 15), ("2024-01-16 00:00:00", "a", 48)]


def test_text_compared_day_skips_hours_before_the_run_and_takes_the_next_midnight(spark, january):
    as_of = datetime(2024, 1, 16, 1, 30)
    assert rows(rollup.roll_up_scheduled(january, "day", as_of=as_of)) == [
        ("2024-01-16 00:00:00", "a", 4 + 8 + 16)]
    assert ("2024-01-16 00:00:00", "a", 28) in rows(rollup.roll_up_scheduled(january, "day"))


def test_scheduled_label_of_every_hour(spark):
    df = hours(spark, [(f"2024-01-15 {h:02d}", "a", 1) for h in range(24)])
    got = dict(rows(df.select("hour", rollup.scheduled_day(F.col("hour")).alias("d"))))
    assert got["2024-01-15 00"] == "2024-01-15 00:00:00"
    assert got["2024-01-15 01"] is None
    assert {got[f"2024-01-15 {h:02d}"] for h in range(2, 24)} == {"2024-01-16 00:00:00"}


@pytest.fixture
def days(spark):
    return spark.createDataFrame([
        ("2023-12-31 00:00:00", "a", 1), ("2024-01-01 00:00:00", "a", 2),
        ("2024-01-31 00:00:00", "a", 4), ("2024-02-01 00:00:00", "a", 8),
    ], "day string, keyword string, count long")


def test_calendar_month(spark, days):
    as_of = datetime(2024, 2, 1, 1, 30)
    assert rows(rollup.roll_up(days, "month", as_of=as_of)) == [("2024-01", "a", 6)]
    assert rows(rollup.roll_up(days, "month", label_at="end", as_of=as_of)) == [
        ("2024-02", "a", 4 + 8)]


def test_text_compared_month_takes_labels_that_begin_with_it(spark, days):
    assert rows(rollup.roll_up_scheduled(days, "month", as_of=datetime(2024, 2, 1, 1, 30))) == [
        ("2024-01", "a", 6)]


def test_cascade_loses_what_exact_keeps(spark):
    always_21st = [(f"2024-01-15 {h:02d}", "steady", 5) for h in range(24)]
    others = [(f"2024-01-15 {h:02d}", f"h{h:02d}k{i:02d}", 9) for h in range(24) for i in range(20)]
    counts = hours(spark, always_21st + others)
    from wirecount.operators.keywords import top_k

    cascade = rollup.roll_up(top_k(counts, 20, by=["hour"]), "day")
    exact = rollup.roll_up(counts, "day")
    assert "steady" not in [r["keyword"] for r in cascade.collect()]
    assert exact.where("keyword = 'steady'").first()["count"] == 120
    month = rollup.roll_up(counts, "month", source="hour")
    assert month.where("keyword = 'steady'").first()["count"] == 120


def test_straight_from_headlines(spark):
    df = spark.createDataFrame([
        ("rates rise", datetime(2024, 1, 15, 13, 5)), ("rates", datetime(2024, 1, 15, 13, 55)),
        ("rates", datetime(2024, 1, 15, 14, 0)), ("lost", None)],
        "title string, published timestamp")
    assert rows(rollup.keywords_per(df, "hour", k=1)) == [
        ("2024-01-15 13", "rates", 2), ("2024-01-15 14", "rates", 1)]
    assert rows(rollup.keywords_per(df, "hour", k=1, label_at="end"))[0][0] == "2024-01-15 14"
