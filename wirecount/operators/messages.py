"""Topic messages: decode, encode, dedup, count, keep for a while."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F, types as T

from wirecount.functions import times
from wirecount.functions.pin import pinned
from wirecount.schemas import MESSAGE

CORRUPT = "_corrupt"


def parse_messages(topic: DataFrame, schema: T.StructType = MESSAGE,
                   keep: tuple[str, ...] = ()) -> DataFrame:
    """Message columns, the ``keep`` columns of the topic, and ``reject_reason``.

    A row is never lost: one that is no JSON object, has a field of the wrong type, or
    has no value at all comes out with a reason instead of null.
    """
    layout = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    value = F.col("value").cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = pinned(topic.select(*keep, value.alias("_value")),
                    _data=F.from_json("_value", layout, options))
    reason = (
        F.when(F.col("_value").isNull(), "no value")
        .when(F.trim("_value") == "", "no value")
        .when(F.col(f"_data.{CORRUPT}").isNotNull() | F.col("_data").isNull(), "malformed")
    )
    return parsed.select(
        *keep, *(F.col(f"_data.{f.name}").alias(f.name) for f in schema.fields),
        reason.alias("reject_reason"))


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).drop("reject_reason")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull())


def to_messages(rows: DataFrame, topic: str = "feeds") -> DataFrame:
    """Rows as a topic sink wants them: ``key``, JSON ``value``, ``topic``."""
    names = [f.name for f in MESSAGE.fields]
    shaped = [times.iso_utc(F.col(c)).alias(c) if c == "published" else F.col(c) for c in names]
    return rows.select(
        F.col("id").alias("key"), F.to_json(F.struct(*shaped)).alias("value"),
        F.lit(topic).alias("topic"))


def dedup(messages: DataFrame, key: tuple[str, ...] = ("id",)) -> DataFrame:
    """One row per id. Copies are dropped on the map side before the shuffle."""
    return messages.dropDuplicates(list(key))


def topic_size(topic: DataFrame) -> DataFrame:
    """Messages held by the topic: newest less oldest offset, summed over partitions."""
    held = topic.groupBy("partition").agg(
        (F.max("offset") - F.min("offset") + 1).alias("held"))
    return held.agg(F.coalesce(F.sum("held"), F.lit(0)).cast("long").alias("messages"))


def messages_per_hour(messages: DataFrame, ts: str = "published") -> DataFrame:
    return (
        messages.where(F.col(ts).isNotNull())
        .groupBy(F.window(ts, "1 hour").alias("_w"))
        .agg(F.count("*").alias("messages"))
        .select(times.label(F.col("_w.start")).alias("hour"), "messages")
    )


def newer_than(rows: DataFrame, ts: Column, as_of: datetime, keep_for: timedelta) -> DataFrame:
    """Retention as a filter with a literal bound, which reaches the scan."""
    return rows.where(ts > times.instant(as_of - keep_for))


def newest(rows: DataFrame, ts: str) -> datetime:
    """Newest time in ``rows`` in UTC, as the ``as_of`` of a retention filter."""
    micros = rows.agg(F.unix_micros(F.max(ts).cast("timestamp")).alias("t")).first()["t"]
    return datetime.fromtimestamp(0, timezone.utc) + timedelta(microseconds=micros or 0)
