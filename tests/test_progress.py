"""Offsets and gauges noted from streams, and the topic's size from them."""

import json
import time
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from wirecount.operators.messages import topic_size as counted_size
from wirecount.plans.ingest import record_noted_topic_size
from wirecount.schemas import TOPIC
from wirecount.sources import tables
from wirecount.streaming import progress
from wirecount.streaming.hourly import start_hourly


@pytest.fixture
def store(spark, database):
    tables.create_tables(spark)
    progress.create(spark)
    return spark


def report(batch, at, begun, ended, n, stream="s"):
    def offset(by):
        return None if by is None else {"feeds": {str(p): o for p, o in by.items()}}

    return {"id": stream, "name": None, "batchId": batch, "timestamp": at,
            "sources": [{"startOffset": offset(begun), "endOffset": offset(ended),
                         "numInputRows": n}],
            "observedMetrics": {"topic": {"messages": n, "empty": 0}}}


REPORTS = [
    report(0, "2024-01-01T00:00:00.000Z", None, {0: 10, 1: 5, 2: 0}, 15),
    report(1, "2024-01-01T10:00:00.000Z", {0: 10, 1: 5, 2: 0}, {0: 25, 1: 5, 2: 2}, 17),
    report(2, "2024-01-02T09:00:00.000Z", {0: 25, 1: 5, 2: 2}, {0: 30, 1: 9, 2: 2}, 9),
]


def test_size_is_newest_less_oldest_offset_kept(store):
    listener = progress.ProgressListener(store)
    for r in [*REPORTS, REPORTS[1]]:  # a report that is noted twice counts once
        listener.keep(r)
    noted = store.table(progress.OFFSETS)
    assert progress.topic_size(noted).first()["messages"] == 15 + 17 + 9
    at = lambda *when: progress.topic_size(noted, datetime(*when)).first()["messages"]
    assert at(2024, 1, 2, 9, 30) == 17 + 9   # the first batch is more than a day ago
    assert at(2024, 1, 2, 11) == 9
    assert at(2024, 1, 9) == 0
    assert record_noted_topic_size(store, datetime(2024, 1, 2, 11)) == 9
    shown = plan(progress.topic_size(noted, datetime(2024, 1, 2, 11)))
    assert "Scan parquet" in shown and "value" not in shown.split("ReadSchema")[1]
    assert "PartitionFilters: [isnotnull(day" in shown


def test_equal_to_counting_the_records(store):
    records = store.range(1000).select(
        (F.col("id") % 3).cast("int").alias("partition"), F.floor(F.col("id") / 3).alias("offset"))
    ends = {r["partition"]: r["n"] for r in records.groupBy("partition").agg(
        (F.max("offset") + 1).alias("n")).collect()}
    half = {p: n // 2 for p, n in ends.items()}
    listener = progress.ProgressListener(store)
    listener.keep(report(0, "2024-01-01T00:00:00.000Z", {p: 0 for p in ends}, half, 500))
    listener.keep(report(1, "2024-01-01T01:00:00.000Z", half, ends, 500))
    assert rows(progress.topic_size(store.table(progress.OFFSETS))) == rows(counted_size(records))


def test_offsets_as_text_and_other_sources():
    told = json.dumps({"feeds": {"0": 7}})
    source = {"startOffset": told, "endOffset": told, "numInputRows": 0}
    one = {"id": "s", "batchId": 3, "timestamp": "t", "sources": [source]}
    assert progress.offset_rows(one) == [("s", 3, "t", "feeds", 0, 7, 7, None)]
    source |= {"startOffset": {"logOffset": 0}, "endOffset": {"logOffset": 1}, "numInputRows": 4}
    assert progress.offset_rows(one) == [("s", 3, "t", None, None, None, None, 4)]
    source |= {"startOffset": None, "endOffset": "no json", "numInputRows": 0}
    assert progress.offset_rows(one) == []


def test_an_empty_table_holds_nothing(store):
    assert progress.topic_size(store.table(progress.OFFSETS)).first()["messages"] == 0


def noted(frame):
    """Rows of a table that a listener's thread writes to."""
    for _ in range(60):
        if frame.count():
            break
        time.sleep(0.5)
    return dict(frame.collect())


def test_the_listener_notes_what_a_stream_observes(store, tmp_path):
    store.range(7).write.parquet(f"{tmp_path}/in")
    listener = progress.watch(store)
    try:
        seen = store.readStream.schema("id long").parquet(f"{tmp_path}/in").observe(
            "numbers", F.count(F.lit(1)).alias("n"), F.max("id").alias("most"))
        seen.writeStream.format("noop").queryName("ids").trigger(availableNow=True).option(
            "checkpointLocation", f"{tmp_path}/checkpoint").start().awaitTermination()
        found = noted(store.table(tables.METRICS).where("name LIKE 'stream.ids.%'")
                      .select("name", "value"))
    finally:
        store.streams.removeListener(listener)
    assert found == {"stream.ids.rows": "7", "stream.ids.numbers.n": "7",
                     "stream.ids.numbers.most": "6"}
    assert progress.topic_size(store.table(progress.OFFSETS)).first()["messages"] == 7


def test_the_hourly_stream_counts_messages_and_rejects(store, tmp_path):
    value = bytearray(b'{"id":"1","title":"rates rise"}')
    sent = [(None, value if i else None, "feeds", 0, i, None) for i in range(5)]
    store.createDataFrame(sent, TOPIC).write.parquet(f"{tmp_path}/topic")
    stream = store.readStream.schema(TOPIC).parquet(f"{tmp_path}/topic")
    start_hourly(stream, f"{tmp_path}/checkpoint", every=None, name="feeds",
                 clock=lambda: datetime(2024, 1, 1, 10)).awaitTermination()
    counted = dict(store.table(tables.METRICS).select("name", "value").collect())
    assert counted == {"hourly_messages": "5", "hourly_rejected": "1"}
