"""Hourly job: entries newer than their channel's mark become messages."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from wirecount.functions.times import instant, utc
from wirecount.operators import messages as msg, registry as reg
from wirecount.operators.lookup import lookup_join
from wirecount.operators.metrics import observed, samples, set_samples
from wirecount.session import shared_dir, size_shuffles, small_files
from wirecount.sources import entries, snapshots, tables
from wirecount.streaming import progress

#: New documents that are read by their names.
NAMED_AT_MOST = 20_000
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


def to_folder(path: str) -> Callable[[DataFrame, int], None]:
    """A message sink that keeps each run in a folder of its own."""
    def send(rows: DataFrame, run: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/run={run}")
    return send


def to_topic(**options) -> Callable[[DataFrame, int], None]:
    """A message sink that sends to Kafka; receivers drop repeated ids."""
    def send(rows: DataFrame, run: int) -> None:
        rows.write.format("kafka").options(**options).save()
    return send


def ingest(rows: DataFrame, root: str, send: Callable[[DataFrame, int], None],
           run: str | None = None, rejects_path: str | None = None,
           as_of: datetime | None = None, channel_set: bool = False) -> int:
    """Send the new entries, then publish the moved marks; returns how many were sent.

    The marks are versions of a log. A run reads the newest version and announces the next
    one once its messages are durable. ``run`` names the run, say by stream and batch: one
    that has announced a version before is repeated from the version it began from, so with
    the same marks, entries and ids. Unreadable rows are set aside, the others proceed. With
    ``as_of`` the number sent is a gauge, with ``channel_set`` the channels are a set besides.
    """
    spark = rows.sparkSession
    marks = f"{root}/{snapshots.MARKS}"
    version = snapshots.version_of(spark, marks, run) if run else None
    if version is None:
        version = (snapshots.latest(spark, marks) or 0) + 1
    registry = snapshots.load_registry(spark, root, marks_at_most=version - 1)
    read = reg.read_entries(rows)
    fresh = reg.new_entries(read, registry)
    # What the moved marks need is kept, which is two numbers per entry, not its text.
    seen_marks = fresh.select("channel_id", "published_ms").persist()
    try:
        counted, seen = observed(reg.entry_messages(fresh), sent=F.count(F.lit(1)))
        send(msg.to_messages(counted), version)
        if rejects_path:
            (
                read.where(F.col("reject_reason").isNotNull())
                .select(*rows.columns, "reject_reason")
                .write.mode("overwrite").parquet(f"{rejects_path}/run={version}")
            )
        if as_of is not None and channel_set:
            tables.append_metrics(set_samples(
                seen_marks, "channel_id", as_of, "channels_with_news"))
        moved = reg.advance_marks(registry, seen_marks).select("id", "last_updated")
        snapshots.publish(moved, marks, version, run)
    finally:
        seen_marks.unpersist()
    sent = seen.get["sent"]
    if as_of is not None:
        tables.append_metrics(samples(spark, as_of, "gauge", kafka_messages_new=sent))
    return sent


def ingest_landed(spark: SparkSession, folder: str, root: str,
                  send: Callable[[DataFrame, int], None], dialect: str = "rss",
                  landed_after: datetime | None = None, named_at_most: int = NAMED_AT_MOST,
                  **options) -> int:
    """``ingest`` over the feed documents of a folder that no earlier run has parsed.

    Which ones were parsed is a snapshot beside the marks: path and time of change of every
    document that is still there. A changed document is parsed again, and one whose run did not
    come to its end too; its old entries are behind the marks then. Up to ``named_at_most`` new
    documents are read by name, more by the time from which on documents are new.
    """
    # Documents are small and many: a task reads, and lists, as many as it takes to be worth one.
    with small_files(spark):
        return _ingest_new(spark, folder, root, send, dialect, landed_after, named_at_most, options)


def _ingest_new(spark: SparkSession, folder: str, root: str,
                send: Callable[[DataFrame, int], None], dialect: str,
                landed_after: datetime | None, named_at_most: int, options: dict) -> int:
    parsed = f"{root}/{snapshots.PARSED}"
    there = entries.landed(spark, folder, landed_after)
    known = snapshots.read(spark, parsed)
    key = ["path", "modified", "bytes"]
    new = there if known is None else lookup_join(there, known.select(*key), key, "left_anti")
    shared_dir(spark)
    # What is new is fixed here; a document that lands while the run works waits for the next.
    new = new.checkpoint()
    facts = new.agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes"),
                    F.unix_micros(F.min("modified")).alias("first")).first()
    if not facts["n"]:
        return 0
    size_shuffles(spark, facts["bytes"])
    if facts["n"] <= named_at_most:
        read = entries.read_entries_xml(
            spark, folder, dialect, documents=[r["path"] for r in new.select("path").collect()])
    else:
        since = EPOCH + timedelta(microseconds=facts["first"]) - timedelta(seconds=1)
        read = entries.read_entries_xml(spark, folder, dialect, landed_after=since)
    sent = ingest(read, root, send, **options)
    still = new if known is None else new.unionByName(
        lookup_join(known.select(*key), there, key, "left_semi"))
    snapshots.publish(still, parsed, (snapshots.latest(spark, parsed) or 0) + 1)
    return sent


def record_topic_size(topic: DataFrame, as_of: datetime) -> int:
    """Gauge of the messages the topic holds."""
    return _record(msg.topic_size(topic), as_of)


def record_noted_topic_size(spark: SparkSession, as_of: datetime) -> int:
    """The same gauge from the offsets that the hourly stream has noted; no message is read.

    A source without offsets of its own holds what the stream has counted since they are kept.
    """
    offsets = spark.table(progress.OFFSETS)
    if not offsets.isEmpty():
        return _record(progress.topic_size(offsets, as_of), as_of)
    since = utc(as_of) - tables.TOPIC_RETENTION
    rows = spark.table(tables.METRICS).where(
        (F.col("day") >= F.lit(since.date())) & (F.col("ts") > instant(since))
        & (F.col("name") == "hourly_messages"))
    return _record(rows.agg(F.coalesce(F.sum(F.col("value").cast("long")), F.lit(0))
                            .alias("messages")), as_of)


def _record(size: DataFrame, as_of: datetime) -> int:
    held = size.first()["messages"]
    tables.append_metrics(samples(size.sparkSession, as_of, "gauge", kafka_messages_total=held))
    return held
