"""What running streams say of themselves, kept as rows: offsets, row counts, observed figures.

A listener on the driver writes a few rows per micro-batch. The size of a topic is then a sum over
these rows, without reading a record, and gauges of a stream are samples like any others.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from wirecount.functions.times import instant
from wirecount.sources import tables

#: A row per batch, source and partition; of a source without partitions one with its rows.
OFFSETS = "topic_offsets"
LAYOUT = ("stream STRING, batch_id BIGINT, noted TIMESTAMP, topic STRING, partition INT, "
          "begun BIGINT, ended BIGINT, rows BIGINT")


def create(spark: SparkSession) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {OFFSETS} ({LAYOUT}, day DATE) USING parquet "
              "PARTITIONED BY (day)")


def _by_partition(offset) -> dict[tuple[str, int], int]:
    """Offsets by topic and partition; nothing for a source that counts in another way."""
    if isinstance(offset, str):
        try:
            offset = json.loads(offset)
        except ValueError:
            return {}
    if not isinstance(offset, Mapping):
        return {}
    return {(topic, int(p)): int(at) for topic, parts in offset.items()
            if isinstance(parts, Mapping) for p, at in parts.items()}


def offset_rows(progress: Mapping) -> list[tuple]:
    """Rows of the offsets table from one progress report."""
    head = (progress["id"], progress["batchId"], progress["timestamp"])
    # A batch that a function works on may be run several times, and is counted each time.
    counted = "ForeachBatch" not in (progress.get("sink") or {}).get("description", "")
    rows = []
    for source in progress["sources"]:
        begun, ended = (_by_partition(source.get(k)) for k in ("startOffset", "endOffset"))
        for (topic, partition), at in ended.items():
            rows.append((*head, topic, partition, begun.get((topic, partition)), at, None))
        # What no offset counts: another kind of source, or the first batch, which starts at none.
        if counted and source["numInputRows"] and (not ended or not begun):
            rows.append((*head, None, None, None, None, source["numInputRows"]))
    return rows


def observed_samples(progress: Mapping) -> list[tuple]:
    """Gauges of one progress report: rows read, rows a second, and what the stream observes."""
    name = progress.get("name") or progress["id"]
    values = {}
    if "ForeachBatch" not in (progress.get("sink") or {}).get("description", ""):
        values["rows"] = sum(s["numInputRows"] for s in progress["sources"])
    for seen, figures in (progress.get("observedMetrics") or {}).items():
        values |= {f"{seen}.{k}": v for k, v in figures.items()}
    return [(progress["timestamp"], f"stream.{name}.{k}", "gauge", str(v))
            for k, v in values.items() if v is not None]


class ProgressListener(StreamingQueryListener):
    """Keeps the progress of all streams of a session in the current database's tables."""

    def __init__(self, spark: SparkSession):
        self.spark, self.database = spark, spark.catalog.currentDatabase()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.keep(json.loads(event.progress.json))

    def keep(self, progress: Mapping) -> None:
        noted = F.to_timestamp("noted")
        names = [c.split()[0] for c in LAYOUT.split(", ")]
        if rows := offset_rows(progress):
            (
                self.spark.createDataFrame(rows, LAYOUT.replace("noted TIMESTAMP", "noted STRING"))
                .coalesce(1).withColumn("noted", noted).withColumn("day", F.to_date("noted"))
                .select(*names, "day")
                .write.mode("append").insertInto(f"{self.database}.{OFFSETS}")
            )
        if samples := observed_samples(progress):
            (
                self.spark.createDataFrame(
                    samples, "noted string, name string, kind string, value string")
                .coalesce(1).select(noted.alias("ts"), "name", "kind", "value",
                                    F.to_date("noted").alias("day"))
                .write.mode("append").insertInto(f"{self.database}.{tables.METRICS}")
            )


def watch(spark: SparkSession) -> ProgressListener:
    """Start keeping progress; give the listener to ``spark.streams.removeListener`` to stop."""
    listener = ProgressListener(spark)
    spark.streams.addListener(listener)
    return listener


def topic_size(offsets: DataFrame, as_of: datetime | None = None,
               keep_for: timedelta = tables.TOPIC_RETENTION) -> DataFrame:
    """Messages the topic holds, from offsets alone: newest less oldest kept, over partitions.

    With ``as_of``, batches noted longer than ``keep_for`` before it are taken as gone from the
    topic. A batch noted twice counts once. Messages from before the first batch are not known.
    """
    if as_of is not None:
        bound = instant(as_of - keep_for)
        offsets = offsets.where(F.col("noted") > bound)
        if "day" in offsets.columns:
            offsets = offsets.where(F.col("day") >= F.lit((as_of - keep_for).date()))
    spans = (
        offsets.where("partition IS NOT NULL").groupBy("topic", "partition")
        .agg((F.max("ended") - F.coalesce(F.min("begun"), F.min("ended"))).alias("held"))
    )
    counted = (
        offsets.where("partition IS NULL").groupBy("stream", "batch_id")
        .agg(F.max("rows").alias("held"))
    )
    return spans.select("held").unionByName(counted.select("held")).agg(
        F.coalesce(F.sum("held"), F.lit(0)).cast("long").alias("messages"))
