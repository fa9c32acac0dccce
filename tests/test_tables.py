import os
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from wirecount.plans import channels as channel_plan, ingest as ingest_plan, rollups
from wirecount.schemas import ENTRY, REGISTRY
from wirecount.sources import entries, snapshots, tables, topic


def hourly(spark, data):
    return spark.createDataFrame(data, "hour string, keyword string, count long")


@pytest.fixture
def made(spark, database):
    tables.create_tables(spark)
    tables.create_tables(spark)
    return database


def read(spark, table):
    unit = tables.KEYWORD_TABLES[table]
    return rows(spark.table(table).select(unit, "keyword", "count"))


def test_a_label_is_replaced_and_the_others_stay(spark, made):
    tables.overwrite_labels(hourly(spark, [("2024-01-01 05", "a", 1), ("2024-01-01 06", "a", 2)]),
                            "keywords_hour")
    tables.overwrite_labels(hourly(spark, [("2024-01-01 06", "b", 3)]), "keywords_hour")
    assert read(spark, "keywords_hour") == [("2024-01-01 05", "a", 1), ("2024-01-01 06", "b", 3)]


def test_stored_highest_first(spark, made):
    data = [("2024-01-01 05", k, n) for k, n in [("b", 2), ("c", 9), ("a", 2)]]
    tables.overwrite_labels(hourly(spark, data), "keywords_hour")
    assert [r["keyword"] for r in spark.table("keywords_hour").collect()] == ["c", "a", "b"]


def test_range_prunes_labels(spark, made):
    tables.overwrite_labels(hourly(spark, [(f"2024-01-01 {h:02d}", "a", h) for h in range(24)]),
                            "keywords_hour")
    some = tables.read_labels(spark, "keywords_hour", "2024-01-01 05", "2024-01-01 07")
    assert sorted(r["count"] for r in some.collect()) == [5, 6]
    pruned = plan(some).split("PartitionFilters: [")[1].split("]")[0]
    assert ">= 2024-01-01 05" in pruned and "< 2024-01-01 07" in pruned


def test_delete_and_expire(spark, made):
    tables.overwrite_labels(hourly(spark, [(f"2024-01-0{d} 05", "a", d) for d in range(1, 6)]),
                            "keywords_hour")
    tables.delete_label(spark, "keywords_hour", "2024-01-05 05")
    assert tables.labels(spark, "keywords_hour") == [f"2024-01-0{d} 05" for d in range(1, 5)]
    gone = tables.expire(spark, "keywords_hour", datetime(2024, 1, 5, 5), timedelta(seconds=172800))
    assert gone == ["2024-01-01 05", "2024-01-02 05"]
    assert tables.labels(spark, "keywords_hour") == ["2024-01-03 05", "2024-01-04 05"]


def test_upsert_by_either_key(spark, made):
    first = hourly(spark, [("2024-01-01 05", "a", 1), ("2024-01-01 05", "b", 1),
                           ("2024-01-01 06", "z", 1)])
    second = hourly(spark, [("2024-01-01 05", "a", 1), ("2024-01-01 05", "b", 7)])
    tables.overwrite_labels(first, "keywords_hour")
    tables.upsert(second, "keywords_hour", ["hour", "keyword"])
    assert read(spark, "keywords_hour") == [
        ("2024-01-01 05", "a", 1), ("2024-01-01 05", "b", 7), ("2024-01-01 06", "z", 1)]
    tables.upsert(hourly(spark, [("2024-01-01 05", "a", 1), ("2024-01-01 05", "b", 1)]),
                  "keywords_hour", ["hour", "count", "keyword"])
    assert read(spark, "keywords_hour") == [
        ("2024-01-01 05", "a", 1), ("2024-01-01 05", "b", 1), ("2024-01-01 05", "b", 7),
        ("2024-01-01 06", "z", 1)]


def test_rollup_job_replaces_its_label(spark, made):
    data = [(f"2024-01-31 {h:02d}", k, 1) for h in range(24) for k in "ab"]
    tables.overwrite_labels(hourly(spark, data), "keywords_hour")
    as_of = datetime(2024, 2, 1, 1, 30)
    cascade = {"exact": False}
    assert rollups.run_rollups(spark, as_of, **cascade) == ["keywords_day", "keywords_month"]
    assert read(spark, "keywords_day") == [("2024-01-31 00:00:00", "a", 24),
                                           ("2024-01-31 00:00:00", "b", 24)]
    tables.overwrite_labels(hourly(spark, [("2024-01-31 05", "a", 10)]), "keywords_hour")
    rollups.run_rollups(spark, as_of, **cascade)
    assert read(spark, "keywords_day") == [("2024-01-31 00:00:00", "a", 33),
                                           ("2024-01-31 00:00:00", "b", 23)]
    assert read(spark, "keywords_month") == [("2024-01", "a", 33), ("2024-01", "b", 23)]
    assert rollups.run_rollups(spark, datetime(2024, 2, 2, 1, 30)) == ["keywords_day"]
    rollups.run_rollups(spark, as_of, scheduled=True)
    assert ("2024-02-01 00:00:00", "a", 31) in read(spark, "keywords_day")


def test_rerun_without_rows_clears_the_label(spark, made):
    as_of = datetime(2024, 2, 1, 1, 30)
    tables.overwrite_labels(hourly(spark, [("2024-01-31 05", "a", 1)]), "keywords_hour")
    for options in ({"exact": False}, {"scheduled": True}):
        rollups.run_rollups(spark, as_of, **options)
    assert tables.labels(spark, "keywords_day") == ["2024-01-31 00:00:00", "2024-02-01 00:00:00"]
    tables.delete_label(spark, "keywords_hour", "2024-01-31 05")
    for options in ({"exact": False}, {"scheduled": True}):
        rollups.run_rollups(spark, as_of, **options)
    assert read(spark, "keywords_day") == [] and read(spark, "keywords_month") == []


def test_exact_end_labels_take_the_next_midnight(spark, made):
    data = [("2024-01-31 00", "a", 1), ("2024-01-31 01", "a", 2), ("2024-02-01 00", "a", 4)]
    tables.write_batch_counts(hourly(spark, data), 0)
    rollups.run_rollups(spark, datetime(2024, 2, 1, 1, 30), exact=True, label_at="end")
    assert read(spark, "keywords_day") == [("2024-02-01 00:00:00", "a", 6)]
    days = tables.batch_counts(spark, datetime(2024, 1, 31), datetime(2024, 1, 31, 5))
    assert "day" in plan(days).split("PartitionFilters: [")[1].split("]")[0]
    assert days.count() == 2


def test_exact_rollup_and_backfill(spark, made):
    data = [("2024-01-30 05", "a", 5), ("2024-01-31 05", "a", 7), ("2024-01-31 06", "b", 1)]
    tables.write_batch_counts(hourly(spark, data), 0)
    rollups.run_rollups(spark, datetime(2024, 2, 1, 1, 30))
    assert read(spark, "keywords_month") == [("2024-01", "a", 12), ("2024-01", "b", 1)]
    rollups.backfill(spark, "day", datetime(2024, 1, 30), datetime(2024, 2, 1))
    assert read(spark, "keywords_day") == [
        ("2024-01-30 00:00:00", "a", 5), ("2024-01-31 00:00:00", "a", 7),
        ("2024-01-31 00:00:00", "b", 1)]
    rollups.backfill(spark, "month", datetime(2024, 1, 1), datetime(2024, 2, 1), exact=False)
    assert read(spark, "keywords_month") == [("2024-01", "a", 12), ("2024-01", "b", 1)]


def test_backfill_leaves_periods_alone_that_are_not_whole(spark, made):
    data = [(f"2024-01-30 {h:02d}", "a", 5) for h in range(24)]
    tables.write_batch_counts(hourly(spark, data), 0)
    rollups.backfill(spark, "day", datetime(2024, 1, 30), datetime(2024, 1, 31))
    whole = [("2024-01-30 00:00:00", "a", 120)]
    assert read(spark, "keywords_day") == whole
    spark.sql(f"TRUNCATE TABLE {tables.BATCH_COUNTS}")
    tables.write_batch_counts(hourly(spark, data[6:]), 0)
    # Complete from 06:00 on only, and the clock stands at noon of the next day.
    rollups.backfill(spark, "day", datetime(2024, 1, 30, 6), datetime(2024, 1, 31, 12))
    assert read(spark, "keywords_day") == whole


def test_a_static_overwrite_is_refused(spark, made):
    tables.overwrite_labels(hourly(spark, [("2024-01-01 05", "a", 1)]), "keywords_hour")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        with pytest.raises(RuntimeError, match="dynamic"):
            tables.overwrite_labels(hourly(spark, [("2024-01-01 06", "a", 1)]), "keywords_hour")
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    assert read(spark, "keywords_hour") == [("2024-01-01 05", "a", 1)]


def test_batches_of_two_runs_are_kept_apart(spark, made):
    for run in ("a", "b", "a"):
        tables.write_batch_counts(hourly(spark, [("2024-01-01 05", "x", 3)]), 0, run)
    assert rows(tables.hour_counts(spark, ["2024-01-01 05"])) == [("2024-01-01 05", "x", 6)]
    assert tables.batch_hours(spark, 0, "a") == ["2024-01-01 05"]
    assert tables.batch_hours(spark, 0, "c") == []


def test_expiry_job(spark, made):
    data = [("2024-01-01 05", "a", 1), ("2024-03-30 05", "a", 2), ("2024-03-31 05", "a", 3)]
    tables.overwrite_labels(hourly(spark, data), "keywords_hour")
    tables.write_batch_counts(hourly(spark, data), 3)
    rollups.expire(spark, datetime(2024, 4, 1, 6))
    assert read(spark, "keywords_hour") == [("2024-03-31 05", "a", 3)]
    assert sorted(r["count"] for r in spark.table(tables.BATCH_COUNTS).collect()) == [2, 3]


def test_channel_job(spark, made, tmp_path):
    root, csv = str(tmp_path / "state"), tmp_path / "feeds.csv"
    csv.write_text("title,url,last_updated\nA,ua,\nB,ub,5\nbad,uc,x\n")
    inserted, total, bad = channel_plan.add_channels(spark, str(csv), root, datetime(2024, 1, 1))
    assert (inserted, total, bad.count()) == (2, 2, 1)
    csv.write_text("title,url,last_updated\nA again,ua,9\nC,uc,\n")
    assert channel_plan.add_channels(spark, str(csv), root, datetime(2024, 1, 2))[:2] == (1, 3)
    assert rows(snapshots.load_registry(spark, root)) == [
        (1, "A", "ua", 0), (2, "B", "ub", 5), (3, "C", "uc", 0)]
    seen = spark.table(tables.METRICS).where("day = '2024-01-02'")
    assert rows(seen.select("name", "kind", "value")) == [
        ("channels_new", "gauge", "1"), ("channels_total", "gauge", "3")]


def test_strict_channel_list(spark, tmp_path):
    twice = spark.createDataFrame([(1, "a", "u", 0), (2, "b", "u", 0)], REGISTRY)
    with pytest.raises(ValueError, match="url repeated"):
        snapshots.publish_channels(twice, str(tmp_path))
    snapshots.publish_channels(twice, str(tmp_path), strict=False)
    snapshots.reset_channels(spark, str(tmp_path))
    assert snapshots.load_registry(spark, str(tmp_path)).count() == 0


def test_ingest_runs(spark, made, tmp_path):
    root = str(tmp_path / "state")
    snapshots.publish_channels(spark.createDataFrame([(1, "A", "ua", 0), (2, "B", "ub", 0)],
                                                     REGISTRY), root)
    send = ingest_plan.to_folder(str(tmp_path / "out"))
    first = spark.createDataFrame([(1, "x", "2024-01-01T00:00:00Z"), (2, "y", "someday"),
                                   (1, "z", "2024-01-01T01:00:00Z")], ENTRY)
    sent = ingest_plan.ingest(first, root, send, run="one", rejects_path=str(tmp_path / "bad"),
                              as_of=datetime(2024, 1, 1))
    assert sent == 2
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
    second = spark.createDataFrame([(1, "z", "2024-01-01T01:00:00Z"),
                                    (2, "late start", "2023-01-01T00:00:00Z")], ENTRY)
    assert ingest_plan.ingest(second, root, send) == 1
    before = rows(spark.read.parquet(str(tmp_path / "out")))
    # The first run again, as after a failure: same marks, same messages.
    assert ingest_plan.ingest(first, root, send, run="one") == 2
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == before
    marks = dict(rows(snapshots.load_registry(spark, root).select("id", "last_updated")))
    assert marks == {1: 1704070800000, 2: 1672531200000}
    assert rows(spark.table(tables.METRICS).select("name", "value")) == [
        ("kafka_messages_new", "2")]


def test_topic_size_gauge(spark, made):
    held = spark.createDataFrame([(0, 1), (0, 2), (2, 9)], "partition int, offset long")
    assert ingest_plan.record_topic_size(held, datetime(2024, 1, 1)) == 3
    assert spark.table(tables.METRICS).first()["name"] == "kafka_messages_total"


RSS = """<?xml version="1.0"?><rss><channel><title>Feed</title>
<item><title>One &amp; only</title><pubDate>Mon, 13 Nov 2023 23:43:15 GMT</pubDate></item>
<item><title>Undated</title></item>
<item><pubDate>Mon, 13 Nov 2023 23:43:15 GMT</pubDate></item>
</channel></rss>"""
ATOM = """<feed><title>Feed</title><entry><title>Atomic</title>
<published>2023-11-13T23:43:15Z</published></entry></feed>"""


def test_landed_feeds(spark, tmp_path):
    for name, body, channel in (("rss", RSS, 7), ("atom", ATOM, 8)):
        folder = tmp_path / name / f"channel_id={channel}"
        folder.mkdir(parents=True)
        (folder / "a.xml").write_text(body)
    got = entries.read_entries_xml(spark, str(tmp_path / "rss")).collect()
    assert {tuple(r) for r in got} == {
        (7, "One & only", "Mon, 13 Nov 2023 23:43:15 GMT"), (7, "Undated", None),
        (7, None, "Mon, 13 Nov 2023 23:43:15 GMT")}
    assert rows(entries.read_entries_xml(spark, str(tmp_path / "atom"), "atom")) == [
        (8, "Atomic", "2023-11-13T23:43:15Z")]


def test_documents_that_landed_before_are_left_out(spark, tmp_path):
    folder = tmp_path / "rss" / "channel_id=7"
    folder.mkdir(parents=True)
    for name, age in (("old", 7200), ("new", 0)):
        (folder / f"{name}.xml").write_text(RSS.replace("One", name))
        then = time.time() - age
        os.utime(folder / f"{name}.xml", (then, then))
    hour_ago = datetime.now(timezone.utc) - timedelta(hours=1)
    got = entries.read_entries_xml(spark, str(tmp_path / "rss"), landed_after=hour_ago)
    titles = {r["title"] for r in got.collect()}
    assert "new &amp; only".replace("&amp;", "&") in titles and len(titles) == 3
    assert got.count() == 3


def test_file_backed_topic(spark, tmp_path):
    sent = spark.range(50).select(F.concat(F.lit("m"), "id").cast("binary").alias("key"),
                                  F.lit("{}").cast("binary").alias("value"),
                                  F.lit("feeds").alias("topic"))
    topic.write_topic(sent, "parquet", str(tmp_path / "t"))
    topic.write_topic(sent, "parquet", str(tmp_path / "t"))
    held = topic.topic_table(spark, "parquet", str(tmp_path / "t"))
    assert held.count() == 100 and held.select("value").distinct().count() == 1


def test_kafka_options():
    assert topic.kafka_options("broker:9092", min_partitions=64) == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "feeds",
        "startingOffsets": "latest", "failOnDataLoss": "false", "minPartitions": "64"}
