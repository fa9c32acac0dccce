from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from wirecount.operators import metrics, series

T = [datetime(2020, 4, 1, 11, m, 59, 1000) for m in (21, 22, 23)]


@pytest.fixture
def points(spark):
    data = [("k", T[0], 18, "kitchen"), ("k", T[1], 19, "kitchen"), ("k", T[2], 20, "kitchen"),
            ("b", T[1], 15, "bedroom")]
    return spark.createDataFrame(data, "sensor_id string, registered_at timestamp, "
                                       "temperature int, location string")


def test_bounds_are_strict(points):
    got = series.series_range(points, "sensor_id", "registered_at", "temperature", T[0], T[2])
    assert rows(got) == [("b", 15, T[1]), ("k", 19, T[1])]


def test_chosen_series(spark, points):
    args = (points, "sensor_id", "registered_at", "temperature", datetime(2020, 1, 1),
            datetime(2021, 1, 1))
    listed = series.series_range(*args, ids=["b"], extra=["location"])
    assert rows(listed) == [("b", 15, T[1], "bedroom")]
    many = spark.createDataFrame([("b",), ("b",), ("nowhere",)], "id string")
    assert rows(series.series_range(*args, ids=many)) == [("b", 15, T[1])]
    assert series.series_range(*args, ids=["nowhere"]).count() == 0


def test_latest(points):
    got = series.latest_per_series(points, "sensor_id", "registered_at")
    assert rows(got.select("sensor_id", "temperature")) == [("b", 15), ("k", 20)]
    assert series.newest_points(points, "registered_at").first()["temperature"] == 20
    assert "TakeOrderedAndProject" in plan(series.newest_points(points, "registered_at"))


def test_latest_breaks_ties(spark):
    df = spark.createDataFrame([("a", 1, 5, "x"), ("a", 1, 7, "y")],
                               "id string, t int, n int, v string")
    assert rows(series.latest_per_series(df, "id", "t", ["n"])) == [("a", 1, 7, "y")]


def test_wide(points):
    got = series.wide(points, "sensor_id", "registered_at", "temperature", ["k", "b", "none"])
    assert got.columns == ["registered_at", "k", "b", "none"]
    assert sorted(tuple(r) for r in got.where("b is not null").collect()) == [(T[1], 19, 15, None)]
    twice = points.union(points.withColumn("temperature", F.col("temperature") - 1))
    args = (twice, "sensor_id", "registered_at", "temperature", ["k", "b"])
    low, high = (series.wide(*args, of_several=f).where("b is not null").first()["b"]
                 for f in (F.min, F.max))
    assert (low, high) == (14, 15)
    assert series.wide(*args).where("b is not null").first()["b"] == 15


def test_labels_and_alias(points):
    got = series.with_labels(points, "registered_at", "temperature", ["sensor_id", "location"])
    assert got.where("temperature = 15").first()["labels"] == {
        "location": "bedroom", "sensor_id": "b"}
    named = series.with_alias(points, "{{ location }}/{{sensor_id}}: {{ nothing }}")
    assert {r["alias"] for r in named.collect()} == {"kitchen/k: {{ nothing }}",
                                                     "bedroom/b: {{ nothing }}"}


@pytest.mark.parametrize("unit, scale", [("ms", 1000), ("s", 1)])
def test_epoch_columns(spark, unit, scale):
    start = int((datetime(2020, 4, 1) - datetime(1970, 1, 1)).total_seconds()) * scale
    df = spark.createDataFrame([(start,), (start + 1,), (start + 60 * scale,)], "t long")
    got = series.time_range(df, "t", datetime(2020, 4, 1), datetime(2020, 4, 1, 0, 1), epoch=unit)
    assert rows(got) == [(start + 1,)]


def test_buckets_touched_are_the_buckets_read(spark, tmp_path):
    df = spark.range(240).select(
        (F.lit(datetime(2024, 1, 1)) + F.make_dt_interval(hours=F.col("id"))).alias("t"), "id")
    path = str(tmp_path / "p")
    df.withColumn("date", F.to_date("t")).write.partitionBy("date").parquet(path)
    start, end = datetime(2024, 1, 2, 22), datetime(2024, 1, 3, 3)
    got = series.bucket_range(spark.read.parquet(path), "date", "t", start, end)
    assert sorted(r["id"] for r in got.collect()) == [47, 48, 49, 50]
    pruned = plan(got).split("PartitionFilters: [")[1].split("]")[0]
    assert "date" in pruned and "2024-01-02" in pruned and "2024-01-03" in pruned


def test_buckets_go_by_utc_and_by_unit(spark, tmp_path):
    """Bounds of another zone, and buckets longer than a day, lose no rows."""
    df = spark.createDataFrame([(1, datetime(2024, 1, 31, 22, 45, tzinfo=timezone.utc)),
                                (2, datetime(2024, 2, 1, 0, 30, tzinfo=timezone.utc))],
                               "id int, t timestamp")
    east = timezone(timedelta(hours=2))
    start, end = datetime(2024, 2, 1, 0, 30, tzinfo=east), datetime(2024, 2, 1, 3, tzinfo=east)
    for unit in ("day", "week", "month", "year"):
        bucket = F.to_date("t") if unit == "day" else F.trunc("t", unit)
        rows_of = series.bucket_range(df.withColumn("d", bucket), "d", "t", start, end, unit)
        assert sorted(r["id"] for r in rows_of.collect()) == [1, 2]
    with pytest.raises(ValueError):
        series.bucket_range(df, "d", "t", start, end, "hour")


def test_panel_query(spark, points):
    points.createOrReplaceTempView("temperature_points")
    got = series.panel_sql(
        spark, "SELECT temperature FROM temperature_points WHERE sensor_id = :id AND "
               "registered_at > $__timeFrom AND registered_at < $__timeTo", T[0], T[2], id="k")
    assert rows(got) == [(19,)]


def test_variables(points):
    values = series.variable_values(points, "sensor_id").collect()
    assert [r[0] for r in values] == ["b", "k"]


@pytest.fixture
def samples(spark):
    t = [datetime(2024, 1, 1, 0, m) for m in range(4)]
    data = [(t[0], "channels_total", "gauge", "1"), (t[2], "channels_total", "gauge", "3"),
            (t[1], "channels_total", "gauge", "2"), (t[0], "errors", "counter", None),
            (t[1], "errors", "counter", "-3"), (t[0], "run", "timing", "1.5"),
            (t[1], "run", "timing", "2.5"), (t[0], "visitors", "set", "x"),
            (t[1], "visitors", "set", "x"), (t[2], "visitors", "set", "y")]
    return spark.createDataFrame(data, "ts timestamp, name string, kind string, value string")


def test_metric_kinds(samples):
    of = lambda kind: samples.where(samples.kind == kind)
    assert rows(metrics.gauges(of("gauge"))) == [("channels_total", "3")]
    assert rows(metrics.counters(of("counter"))) == [("errors", -2.0, 0)]
    assert rows(metrics.timings(of("timing"))) == [("run", 1.5, 2.0, 2.5, 2.5, 0)]
    unread = of("counter").withColumn("value", F.lit("n/a"))
    assert rows(metrics.counters(unread)) == [("errors", None, 2)]
    assert rows(metrics.timings(unread)) == [("errors", None, None, None, None, 2)]
    assert rows(metrics.sets(of("set"))) == [("visitors", 2)]
    assert rows(metrics.sets(of("set"), approximate=True)) == [("visitors", 2)]
    every = {r["name"]: r for r in metrics.metric_rollup(samples).collect()}
    assert every["channels_total"]["last_value"] == "3"
    assert every["errors"]["total"] == -2.0
    run = every["run"]
    assert (run["shortest"], run["mean"], run["longest"]) == (1.5, 2, 2.5)
    assert every["visitors"]["members"] == 2


def test_samples_and_observation(spark):
    made = metrics.samples(spark, datetime(2024, 1, 1), "gauge", channels_new=3)
    assert rows(made) == [(datetime(2024, 1, 1), "channels_new", "gauge", "3")]
    with pytest.raises(ValueError):
        metrics.samples(spark, datetime(2024, 1, 1), "meter", x=1)
    df, seen = metrics.observed(spark.range(10), n=F.count(F.lit(1)), top=F.max("id"))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"n": 10, "top": 9}
