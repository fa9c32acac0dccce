"""Hourly keywords from the topic, one micro-batch at a time."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from wirecount.functions import times
from wirecount.operators import messages as msg
from wirecount.operators.keywords import TOP, keyword_counts, top_k
from wirecount.operators.metrics import observed, samples
from wirecount.operators.rollup import hour_counts, top_of_sums
from wirecount.sources import coverage, tables
from wirecount.streaming.dedup import dedup_topic

LABEL_SOURCES = ("processing", "arrival", "published")
#: Groups of an hour's keywords whose sums say which of them its top can be in.
HOUR_BUCKETS = 1 << 12


def _now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def hourly_writer(label_from: str = "processing", label_at: str = "start", k: int = TOP,
                  rejects_path: str | None = None, tasks: int | None = None,
                  clock: Callable[[], datetime] = _now, run: str | None = None,
                  keep_for: timedelta | None = tables.HOUR_TTL, reread: bool = True,
                  **text) -> Callable[[DataFrame, int], None]:
    """The batch function: complete counts per batch, then the top of the hours touched.

    ``label_from`` is the clock of the batch (``processing``), the time a message reached
    the topic (``arrival``) or its own time (``published``). Counts go to a partition of
    this hour and batch, so a replay replaces them and a second batch in the same hour
    adds to them; the hour's top is then taken over all its batches. A batch goes by its
    stream and its number: the stream's identifier, which lives in its checkpoint, unless
    ``run`` names it. ``tasks`` spreads a batch whose source has few partitions. Under the clock
    of the batch, tops older than ``keep_for`` go with each batch, hours before the current one
    are noted as final, and the first hour as the one counts are kept from. Each batch leaves
    counters of its messages and of those rejected. ``text`` is passed to ``keyword_counts``.

    Under a message clock a batch of many hours is read three times, so that titles can be dealt by
    hour and no count is shuffled, unless ``reread`` says that it had better be run once only.
    """
    if label_from not in LABEL_SOURCES:
        raise ValueError(f"label_from must be one of {LABEL_SOURCES}")

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        name = run or stream_name(spark)
        if label_from == "processing":
            # A replayed batch keeps the hour its first attempt was stamped with.
            earlier = tables.batch_hours(spark, batch_id, name)
            stamp = F.lit(earlier[0]) if earlier else times.label(
                times.instant(clock()), "hour", label_at)
        elif label_from == "arrival":
            stamp = times.label(F.col("timestamp"), "hour", label_at)
        else:
            stamp = times.label(F.coalesce("published", "timestamp"), "hour", label_at)
        by_hour = reread and label_from != "processing"
        if tasks and not by_hour:
            batch = batch.repartition(tasks)
        # Seen while the counts are written; the batch is not run once more for it.
        parsed, seen = observed(
            msg.parse_messages(batch, keep=("timestamp",)), messages=F.count(F.lit(1)),
            rejected=F.count_if(F.col("reject_reason").isNotNull()))
        if rejects_path:
            (
                msg.rejected(parsed).write.mode("overwrite")
                .parquet(f"{rejects_path}/run={name}/batch_id={batch_id}")
            )
        titles = msg.accepted(parsed).select(stamp.alias("hour"), "title")
        counts, in_order = hour_counts(titles, tasks, **text) if by_hour else (
            keyword_counts(titles, by=["hour"], **text), False)
        tables.write_batch_counts(counts, batch_id, name, in_order, packed=in_order)
        tables.append_metrics(samples(spark, clock(), "counter", **{
            f"hourly_{k}": v for k, v in seen.get.items()}))
        hours = tables.batch_hours(spark, batch_id, name)
        publish_hours(spark, hours, k, tasks)
        if label_from == "processing" and hours:
            now = clock()
            this_hour = times.utc(now).replace(minute=0, second=0, microsecond=0)
            # An hour that has begun already is not whole, so counts are kept from the next one.
            coverage.move(spark, tables.BATCH_COUNTS, final=this_hour,
                          begun=this_hour + timedelta(hours=1) if not earlier else None)
            if keep_for is not None:
                tables.expire(spark, "keywords_hour", now, keep_for)

    return write


def stream_name(spark: SparkSession) -> str:
    """The identifier of the stream whose batch this thread works on, or nothing."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or ""


def publish_hours(spark: SparkSession, hours: list[str], k: int = TOP,
                  tasks: int | None = None) -> None:
    """The top of the given hours, over all their batches.

    Of as many hours as there are tasks few keywords are summed for it, in more and smaller steps.
    """
    if not hours:
        return
    if len(hours) < (tasks or spark.sparkContext.defaultParallelism):
        tops = top_k(tables.hour_counts(spark, hours), k, by=["hour"])
    else:
        kept = tables.stored_counts(spark, hours).select(
            F.col("hour").alias("_period"), "keyword", "count")
        tops = top_of_sums(kept, k, HOUR_BUCKETS).withColumnRenamed("_period", "hour")
    tables.overwrite_labels(tops, "keywords_hour")


def start_hourly(stream: DataFrame, checkpoint: str, every: str | None = "1 hour",
                 dedup_within: str | None = None, name: str | None = None,
                 **options) -> StreamingQuery:
    """Run ``hourly_writer`` on the topic; ``every=None`` takes what is there and stops.

    ``dedup_within`` counts a message once that was sent again within that time.
    """
    if dedup_within:
        stream = dedup_topic(stream, dedup_within)
        # Its state is worked through whenever a batch is run.
        options = {"reread": False, **options}
    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    writer = stream.writeStream.queryName(name) if name else stream.writeStream
    return (
        writer.outputMode("append")
        .foreachBatch(hourly_writer(**options))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
