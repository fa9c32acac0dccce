"""Messages sent more than once, received once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def dedup_stream(messages: DataFrame, ts: str = "published", within: str = "24 hours",
                 key: str = "id", spread_by: Column | None = None,
                 salts: int = 16) -> DataFrame:
    """First message of every id, as long as copies come ``within`` that time.

    ``spread_by`` is a number that differs between copies, such as a hash of topic
    partition and offset. With it, copies of an id are first reduced in ``salts`` places
    and only the survivors meet in one, so an id with very many copies is no hot task.
    """
    marked = messages.withWatermark(ts, within)
    if spread_by is None:
        return marked.dropDuplicatesWithinWatermark([key])
    return (
        marked.withColumn("_salt", F.pmod(spread_by, F.lit(salts)).cast("int"))
        .dropDuplicatesWithinWatermark([key, "_salt"])
        .dropDuplicatesWithinWatermark([key])
        .drop("_salt")
    )


def dedup_topic(topic: DataFrame, within: str = "24 hours") -> DataFrame:
    """``dedup_stream`` for raw topic rows, by the id inside the JSON value.

    A value without an id, readable or not, is kept: it stands for its own offset.
    """
    place = F.concat_ws("-", "topic", "partition", "offset")
    inside = F.get_json_object(F.col("value").cast("string"), "$.id")
    return dedup_stream(
        topic.withColumn("_id", F.coalesce(inside, place)), "timestamp", within, "_id",
        spread_by=F.xxhash64("partition", "offset"),
    ).drop("_id")
