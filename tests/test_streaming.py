import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan, rows
from wirecount.operators import messages as msg
from wirecount.operators.rollup import keywords_per
from wirecount.plans.ingest import to_folder
from wirecount.schemas import ENTRY, REGISTRY, TOPIC
from wirecount.sources import snapshots, tables, topic
from wirecount.streaming import dedup, hourly, ingest, updates, windows


def land(spark, folder, name, messages, arrived=datetime(2024, 1, 1, 14, 0, 1)):
    """One more file of topic rows."""
    data = [(None, m if isinstance(m, (bytes, type(None))) else json.dumps(m).encode(), "feeds", 0,
             i, arrived) for i, m in enumerate(messages)]
    spark.createDataFrame(data, TOPIC).coalesce(1).write.parquet(f"{folder}/{name}")


def source(spark, folder):
    return topic.topic_stream(spark, "parquet", f"{folder}/*", maxFilesPerTrigger=1)


def message(i, title, published="2024-01-01T13:30:00Z"):
    return {"id": str(i), "title": title, "published": published, "ChannelTitle": "c"}


@pytest.fixture
def made(spark, database, tmp_path):
    tables.create_tables(spark)
    (tmp_path / "topic").mkdir()
    return str(tmp_path / "topic"), str(tmp_path / "checkpoint"), tmp_path


def run(spark, folder, checkpoint, **options):
    query = hourly.start_hourly(source(spark, folder), checkpoint, every=None, **options)
    query.awaitTermination()


def test_batches_of_one_hour_add_up(spark, made):
    folder, checkpoint, tmp = made
    land(spark, folder, "a", [message(1, "rates rise"), b"{broken", None])
    land(spark, folder, "b", [message(2, "rates"), message(3, None)])
    run(spark, folder, checkpoint, clock=lambda: datetime(2024, 1, 1, 14, 0, 5),
        rejects_path=str(tmp / "bad"))
    got = spark.table("keywords_hour").select("hour", "keyword", "count")
    assert rows(got) == [("2024-01-01 14", "rates", 2), ("2024-01-01 14", "rates rise", 1),
                         ("2024-01-01 14", "rise", 1)]
    assert spark.read.parquet(str(tmp / "bad")).count() == 2
    # Nothing new: a restart from the checkpoint changes nothing.
    run(spark, folder, checkpoint, clock=lambda: datetime(2024, 1, 1, 15, 0, 5))
    assert got.count() == 3 and spark.table(tables.BATCH_COUNTS).count() == 4


def test_a_message_sent_again_counts_once(spark, made):
    folder, checkpoint, tmp = made
    land(spark, folder, "a", [message(1, "rates"), message(1, "rates"), b"{broken"])
    land(spark, folder, "b", [message(1, "rates"), message(2, "rise"), b"{broken"])
    run(spark, folder, checkpoint, label_from="published", dedup_within="24 hours",
        rejects_path=str(tmp / "bad"))
    assert rows(spark.table("keywords_hour").select("keyword", "count")) == [
        ("rates", 1), ("rise", 1)]
    # The unreadable value stands for its partition and offset, which both files share.
    assert spark.read.parquet(str(tmp / "bad")).count() == 1


def test_a_replayed_batch_keeps_its_hour_and_changes_nothing(spark, made):
    folder, _, _ = made
    land(spark, folder, "a", [message(1, "rates rise")])
    batch = topic.topic_table(spark, "parquet", f"{folder}/*")
    hourly.hourly_writer(clock=lambda: datetime(2024, 1, 1, 14, 59))(batch, 7)
    before = rows(spark.table("keywords_hour"))
    hourly.hourly_writer(clock=lambda: datetime(2024, 1, 1, 15, 1))(batch, 7)
    assert rows(spark.table("keywords_hour")) == before
    assert tables.batch_hours(spark, 7) == ["2024-01-01 14"]


def test_a_new_checkpoint_adds_to_what_is_there(spark, made):
    """Batch 0 of another stream is another batch: it neither takes its hour nor its counts."""
    folder, checkpoint, tmp = made
    land(spark, folder, "a", [message(1, "alpha")])
    run(spark, folder, checkpoint, clock=lambda: datetime(2024, 1, 1, 10))
    land(spark, folder, "b", [message(2, "beta")])
    run(spark, folder, str(tmp / "other"), clock=lambda: datetime(2024, 1, 1, 15))
    assert rows(spark.table("keywords_hour").select("hour", "keyword", "count")) == [
        ("2024-01-01 10", "alpha", 1), ("2024-01-01 15", "alpha", 1),
        ("2024-01-01 15", "beta", 1)]


@pytest.mark.parametrize("label_from, label_at, expected", [
    ("processing", "start", {"2024-01-01 15"}), ("processing", "end", {"2024-01-01 16"}),
    ("arrival", "start", {"2024-01-01 14"}),
    ("published", "start", {"2024-01-01 13", "2024-01-01 14"}),
])
def test_labels(spark, made, label_from, label_at, expected):
    folder, checkpoint, _ = made
    land(spark, folder, "a", [message(1, "rates"), message(2, "undated", None)])
    run(spark, folder, checkpoint, label_from=label_from, label_at=label_at, tasks=2,
        clock=lambda: datetime(2024, 1, 1, 15, 0, 5))
    assert {r["hour"] for r in spark.table("keywords_hour").collect()} == expected


def test_empty_batch(spark, made):
    hourly.hourly_writer()(spark.createDataFrame([], TOPIC), 0)
    assert spark.table("keywords_hour").count() == 0


def test_stream_equals_batch(spark, made):
    folder, checkpoint, _ = made
    sent = [message(i, f"rates rise in {'spring' if i % 3 else 'autumn'}",
                    f"2024-01-01T{10 + i % 4}:15:00Z") for i in range(40)]
    for n in range(4):
        land(spark, folder, f"f{n}", sent[n::4])
    run(spark, folder, checkpoint, label_from="published")
    parsed = msg.accepted(msg.parse_messages(topic.topic_table(spark, "parquet", f"{folder}/*")))
    assert rows(spark.table("keywords_hour").select("hour", "keyword", "count")) == rows(
        keywords_per(parsed, "hour"))


def test_event_time_windows_drop_what_is_too_late(spark, made):
    folder, checkpoint, tmp = made
    land(spark, folder, "a", [message(1, "rates", "2024-01-01T10:30:00Z")])
    land(spark, folder, "b", [message(2, "rates", "2024-01-01T14:00:00Z")])
    # A batch is judged by the mark the batch before it started from, so one lies between.
    land(spark, folder, "c", [message(3, "rise", "2024-01-01T14:10:00Z")])
    land(spark, folder, "d", [message(4, "rates", "2024-01-01T10:45:00Z"),
                              message(5, "rates", "2024-01-01T13:30:00Z")])
    parsed = msg.accepted(msg.parse_messages(source(spark, folder)))
    counted = windows.windowed_keywords(parsed, lateness="1 hour")
    updates.start_updates(counted, str(tmp / "out"), checkpoint, every=None).awaitTermination()
    assert rows(updates.read_updates(spark, str(tmp / "out"), ["hour", "keyword"])) == [
        ("2024-01-01 10", "rates", 1), ("2024-01-01 13", "rates", 1),
        ("2024-01-01 14", "rates", 1), ("2024-01-01 14", "rise", 1)]


def test_append_mode_gives_closed_windows_once(spark, made):
    folder, checkpoint, tmp = made
    land(spark, folder, "a", [message(1, "rates", "2024-01-01T10:30:00Z")])
    land(spark, folder, "b", [message(2, "rates", "2024-01-01T14:00:00Z")])
    parsed = msg.accepted(msg.parse_messages(source(spark, folder)))
    query = (
        windows.windowed_messages(parsed).writeStream.outputMode("append").format("parquet")
        .option("path", str(tmp / "out")).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp / "out"))) == [("2024-01-01 10", 1)]


@pytest.mark.parametrize("salted", [False, True])
def test_sent_twice_received_once(spark, made, salted):
    folder, checkpoint, tmp = made
    sent = [message(i % 20, f"t{i % 20}") for i in range(100)]
    land(spark, folder, "a", sent[:60])
    land(spark, folder, "b", sent[60:])
    rows_in = source(spark, folder)
    parsed = msg.accepted(msg.parse_messages(rows_in, keep=("partition", "offset")))
    spread_by = F.xxhash64("partition", "offset") if salted else None
    once = dedup.dedup_stream(parsed, spread_by=spread_by, salts=4)
    (
        once.writeStream.format("parquet").option("path", str(tmp / "out"))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        .awaitTermination()
    )
    got = [r["id"] for r in spark.read.parquet(str(tmp / "out")).collect()]
    assert sorted(got) == sorted({str(i) for i in range(20)})


def test_marks_carry_from_batch_to_batch(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "state")
    snapshots.publish_channels(spark.createDataFrame([(1, "A", "ua", 0)], REGISTRY), root)

    def put(name, data):
        spark.createDataFrame(data, ENTRY).coalesce(1).write.parquet(f"{landing}/{name}")

    def go():
        stream = spark.readStream.schema(ENTRY).option("maxFilesPerTrigger", 1).parquet(
            f"{landing}/*")
        ingest.start_ingest(stream, root, to_folder(str(tmp_path / "out")),
                            str(tmp_path / "checkpoint"), every=None).awaitTermination()
        return sorted(json.loads(r["value"])["title"] for r in
                      spark.read.parquet(str(tmp_path / "out")).collect())

    put("a", [(1, "first", "2024-01-01T10:00:00Z"), (1, "second", "2024-01-01T09:00:00Z")])
    assert go() == ["first", "second"]
    put("b", [(1, "late", "2024-01-01T09:30:00Z"), (1, "third", "2024-01-01T11:00:00Z")])
    assert go() == ["first", "second", "third"]
    assert go() == ["first", "second", "third"]


def test_batch_runs_and_a_stream_share_the_marks(spark, tmp_path):
    """A stream with a new checkpoint goes on from the marks that batch runs have left."""
    from wirecount.plans.ingest import ingest as ingest_once

    landing, root, out = (str(tmp_path / n) for n in ("landing", "state", "out"))
    snapshots.publish_channels(spark.createDataFrame([(1, "A", "ua", 0)], REGISTRY), root)
    for day in (1, 2, 3):
        ingest_once(spark.createDataFrame([(1, f"t{day}", f"2024-01-0{day}T00:00:00Z")], ENTRY),
                    root, to_folder(out))
    spark.createDataFrame([(1, "t1", "2024-01-01T00:00:00Z"), (1, "t9", "2024-01-09T00:00:00Z")],
                          ENTRY).write.parquet(f"{landing}/a")
    stream = spark.readStream.schema(ENTRY).parquet(f"{landing}/*")
    ingest.start_ingest(stream, root, to_folder(out), str(tmp_path / "checkpoint"),
                        every=None).awaitTermination()
    sent = [json.loads(r["value"])["title"] for r in spark.read.parquet(out).collect()]
    assert sorted(sent) == ["t1", "t2", "t3", "t9"]
    marks = snapshots.load_registry(spark, root).first()["last_updated"]
    assert marks == 1704758400000


@pytest.mark.parametrize("least, dealt", [(2, True), (50, False)])
def test_a_batch_of_many_hours_shuffles_titles_not_counts(spark, made, monkeypatch, least, dealt):
    """One shuffle, of titles, before counts are written; tops are taken from few sums of them."""
    folder, _, _ = made
    sent = [message(i, f"rates rise in {'spring' if i % 3 else 'autumn'} w{i}",
                    f"2024-01-01T{10 + i % 6}:15:00Z") for i in range(60)]
    land(spark, folder, "a", sent)
    batch = topic.topic_table(spark, "parquet", f"{folder}/*")
    written, real = [], tables.write_batch_counts

    def write(counts, *given, **options):
        written.append((plan(counts), given[2], options["packed"]))
        real(counts, *given, **options)

    monkeypatch.setattr(tables, "write_batch_counts", write)
    if dealt:
        monkeypatch.setattr(tables, "hour_counts", lambda *a: pytest.fail("all are summed"))
    for _ in range(2):
        hourly.hourly_writer(label_from="published", tasks=least)(batch, 0)
    assert [(p.count("Exchange ") == 1 and "rangepartitioning(_label" in p, o, s)
            for p, o, s in written] == [(dealt, True, True)] * 2
    parsed = msg.accepted(msg.parse_messages(batch))
    assert rows(spark.table("keywords_hour").select("hour", "keyword", "count")) == rows(
        keywords_per(parsed, "hour"))
    counted = spark.table("metric_samples").where("name = 'hourly_messages'").select("value")
    assert rows(counted) == [("60",), ("60",)]


def test_a_batch_with_state_is_run_once(spark, made, monkeypatch):
    folder, checkpoint, _ = made
    land(spark, folder, "a", [message(1, "rates"), message(1, "rates")])
    monkeypatch.setattr(hourly, "hour_counts", lambda *a, **b: pytest.fail("read again"))
    run(spark, folder, checkpoint, label_from="published", dedup_within="24 hours", tasks=2)
    assert rows(spark.table("keywords_hour").select("keyword", "count")) == [("rates", 1)]


def test_one_batch_of_updates_is_not_shuffled(spark, tmp_path):
    folder, key = str(tmp_path), ["hour", "keyword"]

    def put(batch, *data):
        spark.createDataFrame(data, "hour string, keyword string, count long").write.parquet(
            f"{folder}/batch={batch}")

    put(0, ("h", "a", 1), ("h", "b", 2))
    put(1)
    alone = updates.read_updates(spark, folder, key, grouped=True)
    assert "Exchange" not in plan(alone)
    assert rows(alone) == rows(updates.read_updates(spark, folder, key)) == [
        ("h", "a", 1), ("h", "b", 2)]
    put(2, ("h", "a", 5))
    assert rows(updates.read_updates(spark, folder, key, grouped=True)) == rows(
        updates.read_updates(spark, folder, key)) == [("h", "a", 5), ("h", "b", 2)]
    # Rows that are not one a key are still made one.
    put(3, ("h", "b", 7), ("h", "b", 7))
    assert rows(updates.read_updates(spark, folder, key)) == [("h", "a", 5), ("h", "b", 7)]


def test_state_and_updates_are_packed(spark, made):
    """Files of updates and the state's checkpoint are in zstd."""
    folder, checkpoint, tmp = made
    land(spark, folder, "a", [message(1, "rates")])
    parsed = msg.accepted(msg.parse_messages(source(spark, folder)))
    updates.start_updates(windows.windowed_keywords(parsed), str(tmp / "out"), checkpoint,
                          every=None).awaitTermination()
    assert list((tmp / "out").rglob("*.zstd.parquet"))
    for name in ("stateStore.compression.codec", "stateStore.rocksdb.compression"):
        assert spark.conf.get(f"spark.sql.streaming.{name}") == "zstd"
