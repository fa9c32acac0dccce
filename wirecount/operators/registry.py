"""The channel registry and what is new since a channel was last read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wirecount.functions import ids, times
from wirecount.functions.pin import pinned
from wirecount.operators.lookup import MAX_BROADCAST_BYTES, lookup_join


def first_per_url(candidates: DataFrame, position: list[str]) -> DataFrame:
    """One row per url, the earliest by ``position``; combined on the map side."""
    rest = [c for c in candidates.columns if c != "url"]
    return (
        candidates.groupBy("url")
        .agg(F.min_by(F.struct(*rest), F.struct(*position)).alias("_first"))
        .select("url", "_first.*")
    )


def new_channels(candidates: DataFrame, registry: DataFrame, position: list[str]) -> DataFrame:
    """Candidates whose url is not registered, numbered on from the highest id."""
    absent = first_per_url(candidates, position).join(
        registry.select("url"), "url", "left_anti")
    last = registry.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]
    return (
        ids.number_rows(absent, position, "id", start=last)
        .select("id", "title", "url", F.coalesce("last_updated", F.lit(0)).cast("long")
                .alias("last_updated"))
    )


def insert_channels(candidates: DataFrame, registry: DataFrame, position: list[str]) -> DataFrame:
    """The registry with the new channels added."""
    return registry.unionByName(new_channels(candidates, registry, position))


def registry_faults(registry: DataFrame) -> DataFrame:
    """Rows against the strict rules: title, url and mark present, url and id unique."""
    missing = [F.when(F.col(c).isNull(), F.lit(f"{c} missing"))
               for c in ("id", "title", "url", "last_updated")]
    rows = registry.select("id", "url", F.explode_outer(F.array_compact(F.array(*missing)))
                           .alias("fault")).where(F.col("fault").isNotNull())
    repeated = [
        registry.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("_n"))
        .where(F.col("_n") > 1)
        .select(F.col("id") if c == "id" else F.lit(None).cast("long").alias("id"),
                F.col("url") if c == "url" else F.lit(None).cast("string").alias("url"),
                F.lit(f"{c} repeated").alias("fault"))
        for c in ("id", "url")
    ]
    return rows.unionByName(repeated[0]).unionByName(repeated[1])


def entry_fault(published_at: Column, title: Column) -> Column:
    """Why an entry with a date cannot be used, or null."""
    return F.when(published_at.isNull(), "unreadable date").when(title.isNull(), "no title")


def read_entries(entries: DataFrame) -> DataFrame:
    """Dated entries with ``published_at``, ``published_ms`` and ``reject_reason``."""
    dated = entries.where(F.col("published").isNotNull())
    return (
        pinned(dated, published_at=times.parse_published(F.col("published")))
        .withColumn("published_ms", F.unix_millis("published_at"))
        .withColumn("reject_reason", entry_fault(F.col("published_at"), F.col("title")))
    )


def new_entries(entries: DataFrame, registry: DataFrame, at_mark: bool = False,
                max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Good entries later than their channel's mark, with the channel's title.

    ``at_mark`` also takes entries equal to the mark, for use with id dedup. Entries of
    unregistered channels are not taken. A channel holding much of the input is spread
    when the registry is larger than ``max_bytes`` and so not broadcast.
    """
    channels = registry.select(
        F.col("id").alias("channel_id"), F.col("title").alias("ChannelTitle"),
        F.coalesce("last_updated", F.lit(0)).alias("_mark"))
    later = F.col("published_ms") >= F.col("_mark") if at_mark else (
        F.col("published_ms") > F.col("_mark"))
    return (
        lookup_join(entries.where(F.col("reject_reason").isNull()).drop("reject_reason"),
                    channels, ["channel_id"], "inner",
                    spread_by=["title", "published_ms"], max_bytes=max_bytes)
        .where(later).drop("_mark")
    )


def entry_messages(fresh: DataFrame) -> DataFrame:
    """New entries in message layout, with ids that survive a replay."""
    published = times.iso_utc(F.col("published_at"))
    return fresh.select(
        ids.message_id(F.col("channel_id"), F.col("title"), published).alias("id"),
        "title", F.col("published_at").alias("published"), "ChannelTitle")


def advance_marks(registry: DataFrame, fresh: DataFrame) -> DataFrame:
    """The registry with every channel's mark moved to its latest new entry.

    A mark never goes back, and one without new entries stays as it is, also null.
    """
    latest = fresh.groupBy(F.col("channel_id").alias("id")).agg(
        F.max("published_ms").alias("_latest"))
    moved = F.greatest(F.coalesce("last_updated", F.lit(0)), F.col("_latest"))
    return (
        registry.join(latest, "id", "left")
        .withColumn("last_updated", F.when(F.col("_latest").isNull(), F.col("last_updated"))
                    .otherwise(moved))
        .drop("_latest")
    )
