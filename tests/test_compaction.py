"""Merged days: nothing is lost, repeated or read twice, whenever a run stops."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from wirecount.plans import rollups
from wirecount.sources import compaction, coverage, partitions, tables
from wirecount.streaming.hourly import hourly_writer, publish_hours

AS_OF = datetime(2024, 1, 3, 12)
DAY = date(2024, 1, 1)


@pytest.fixture
def store(spark, database):
    tables.create_tables(spark)
    return spark


def batch(spark, batch_id, *counts, run="s"):
    tables.write_batch_counts(spark.createDataFrame(
        list(counts), "hour string, keyword string, count long"), batch_id, run)


def held(spark, first=DAY, last=date(2024, 1, 31)):
    return rows(compaction.complete(spark, first, last).groupBy("hour", "keyword").agg(
        F.sum("count")))


def fill(spark):
    batch(spark, 0, ("2024-01-01 10", "a", 1), ("2024-01-01 10", "b", 2))
    batch(spark, 1, ("2024-01-01 10", "a", 3), ("2024-01-01 23", "c", 1), ("2024-01-02 00", "c", 5))
    batch(spark, 2, ("2024-01-02 01", "a", 7))
    batch(spark, 0, ("2024-01-01 10", "a", 10), run="other")
    batch(spark, 3, ("2024-01-03 11", "a", 1))


def test_a_merged_day_holds_the_same_counts_in_one_set_of_files(store):
    fill(store)
    before = held(store)
    assert compaction.compact(store, AS_OF) == ["2024-01-01", "2024-01-02"]
    assert held(store) == before
    assert compaction.clean(store) == 5
    assert held(store) == before
    left = {(p["day"], p["batch_id"]) for p in partitions.listed(store, tables.BATCH_COUNTS)}
    assert left == {("2024-01-03", "3")}
    files = tables.hour_counts(store, ["2024-01-01 10"]).inputFiles()
    assert len({f.rsplit("/", 1)[0] for f in files if "day=2024-01-01" in f and
                "keyword_days/" in f}) == 1
    assert not any(f"/{tables.BATCH_COUNTS}/day=2024-01-01" in f for f in files)
    assert rows(tables.hour_counts(store, ["2024-01-01 10"])) == [
        ("2024-01-01 10", "a", 14), ("2024-01-01 10", "b", 2)]
    assert compaction.compact(store, AS_OF) == []


def test_a_replay_after_merging_changes_nothing_and_a_new_batch_is_added(store):
    fill(store)
    compaction.compact(store, AS_OF)
    before = held(store)
    assert tables.batch_hours(store, 1, "s") == ["2024-01-01 10", "2024-01-01 23", "2024-01-02 00"]
    compaction.clean(store)
    assert tables.batch_hours(store, 1, "s") == ["2024-01-01 10", "2024-01-01 23", "2024-01-02 00"]
    batch(store, 1, ("2024-01-01 10", "a", 3), ("2024-01-01 23", "c", 1), ("2024-01-02 00", "c", 5))
    assert held(store) == before
    batch(store, 9, ("2024-01-01 10", "a", 100))
    late = [(h, k, n + 100 * ((h, k) == ("2024-01-01 10", "a"))) for h, k, n in before]
    assert held(store) == late
    assert compaction.compact(store, AS_OF) == ["2024-01-01"]
    assert held(store) == late
    compaction.clean(store)
    assert held(store) == late
    assert compaction.generations(store) == {"2024-01-01": 2, "2024-01-02": 1}
    batch(store, 0, ("2024-01-01 10", "a", 1), ("2024-01-01 10", "b", 2))  # of generation 1
    assert held(store) == late


def test_a_run_that_stops_before_it_announces_leaves_nothing_behind(store, monkeypatch):
    fill(store)
    before = held(store)
    write = compaction.replace

    def stops(df, table):
        if table == compaction.MERGED:
            raise RuntimeError("lost")
        write(df, table)

    monkeypatch.setattr(compaction, "replace", stops)
    with pytest.raises(RuntimeError, match="lost"):
        compaction.compact(store, AS_OF)
    assert held(store) == before
    batch(store, 7, ("2024-01-02 01", "z", 1))
    monkeypatch.setattr(compaction, "replace", write)
    compaction.compact(store, AS_OF)
    compaction.clean(store)
    assert held(store) == sorted([*before, ("2024-01-02 01", "z", 1)])


def test_days_that_are_open_or_hold_one_batch_wait(store):
    fill(store)
    assert compaction.compact(store, datetime(2024, 1, 2, 1), least=2) == []
    assert compaction.compact(store, datetime(2024, 1, 2, 3), least=4) == []
    assert compaction.compact(store, datetime(2024, 1, 2, 3), least=3) == ["2024-01-01"]


def test_tops_and_rollups_are_the_same_after_merging(store):
    fill(store)
    publish_hours(store, ["2024-01-01 10", "2024-01-01 23"])
    first = rows(store.table("keywords_hour"))
    rollups.backfill(store, "day", datetime(2024, 1, 1), datetime(2024, 1, 3))
    days = rows(store.table("keywords_day"))
    compaction.compact(store, AS_OF)
    compaction.clean(store)
    publish_hours(store, ["2024-01-01 10", "2024-01-01 23"])
    rollups.backfill(store, "day", datetime(2024, 1, 1), datetime(2024, 1, 3))
    assert rows(store.table("keywords_hour")) == first
    assert rows(store.table("keywords_day")) == days == [
        ("a", 7, "2024-01-02 00:00:00"), ("a", 14, "2024-01-01 00:00:00"),
        ("b", 2, "2024-01-01 00:00:00"), ("c", 1, "2024-01-01 00:00:00"),
        ("c", 5, "2024-01-02 00:00:00")]


def test_a_replayed_batch_of_a_merged_day_keeps_its_hour(store):
    topic = store.createDataFrame(
        [(bytearray(b'{"id":"1","title":"rates rise","published":"2024-01-01T10:00:00Z"}'), None)],
        "value binary, timestamp timestamp")
    hourly_writer(clock=lambda: datetime(2024, 1, 1, 10, 30), run="s")(topic, 0)
    hourly_writer(clock=lambda: datetime(2024, 1, 1, 11, 30), run="s")(topic, 1)
    before = held(store)
    compaction.compact(store, AS_OF)
    compaction.clean(store)
    hourly_writer(clock=lambda: AS_OF, run="s")(topic, 0)
    assert held(store) == before


def test_expired_sources_are_refused_and_open_ones_reported(store):
    fill(store)
    tables.overwrite_labels(store.createDataFrame(
        [("a", 1, "2024-01-01 10")], "keyword string, count long, hour string"), "keywords_hour")
    rollups.run_rollups(store, datetime(2024, 1, 2, 1, 30))
    kept = rows(store.table("keywords_day"))
    assert kept
    rollups.expire(store, datetime(2024, 1, 5), keep_batches=timedelta(days=3))
    assert coverage.read(store, tables.BATCH_COUNTS).expired.date() == date(2024, 1, 2)
    for again in (lambda: rollups.run_rollups(store, datetime(2024, 1, 2, 1, 30)),
                  lambda: rollups.run_rollups(store, datetime(2024, 1, 2, 1, 30), exact=False),
                  lambda: rollups.backfill(store, "day", datetime(2024, 1, 1), datetime(2024, 1, 4))):
        with pytest.raises(coverage.SourceExpired):
            again()
    assert rows(store.table("keywords_day")) == kept
    rollups.run_rollups(store, datetime(2024, 1, 3, 1, 30))
    coverage.move(store, tables.BATCH_COUNTS, begun=datetime(2024, 1, 2, 6),
                  final=datetime(2024, 1, 2, 20))
    with pytest.warns(UserWarning, match="kept since") as told:
        rollups.run_rollups(store, datetime(2024, 1, 3, 1, 30))
    assert any("final up to" in str(w.message) for w in told)


def test_bounds_only_move_on(store):
    coverage.move(store, "x", begun=datetime(2024, 1, 2), final=datetime(2024, 1, 3))
    coverage.move(store, "x", begun=datetime(2024, 1, 5), final=datetime(2024, 1, 1))
    coverage.move(store, "x", begun=datetime(2024, 1, 1), final=None)
    got = coverage.read(store, "x")
    assert (got.begun.day, got.final.day, got.expired) == (1, 3, None)
    assert store.table(coverage.COVERAGE).count() == 3
    assert coverage.read(store, "y") == coverage.Coverage()


def test_old_tops_go_with_the_batches(store):
    topic = store.createDataFrame(
        [(bytearray(b'{"id":"1","title":"rates rise","published":"2024-01-01T10:00:00Z"}'), None)],
        "value binary, timestamp timestamp")
    hourly_writer(clock=lambda: datetime(2024, 1, 1, 10, 30), run="s")(topic, 0)
    hourly_writer(clock=lambda: datetime(2024, 1, 3, 9, 30), run="s")(topic, 1)
    assert len(tables.labels(store, "keywords_hour")) == 2
    hourly_writer(clock=lambda: datetime(2024, 1, 3, 11, 30), run="s")(topic, 2)
    assert tables.labels(store, "keywords_hour") == ["2024-01-03 09", "2024-01-03 11"]
    now = coverage.read(store, tables.BATCH_COUNTS)
    assert now.begun.isoformat() == "2024-01-01T11:00:00+00:00"
    assert now.final.isoformat() == "2024-01-03T11:00:00+00:00"
