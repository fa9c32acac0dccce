"""Channel marks as keyed state of a stream, beside the snapshot that ``ingest`` joins.

The state's key is a block of ``CHANNELS`` neighbouring channel ids and a salt from the entry itself,
so the entries of a busy channel are spread over ``salts`` tasks; each holds the latest time it has
seen of each channel, and a channel's mark is the highest of its salts. Python is called once a
block and salt, not for every channel, and a block's state has a bounded size. A batch passes on
only marks that have moved. State of channels that have been silent for ``forget_after`` goes;
their marks are in what was passed on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from wirecount.operators.lookup import MAX_BROADCAST_BYTES, lookup_join
from wirecount.operators.registry import new_entries, read_entries

SALTS = 8
#: Channel ids whose marks are one value of the state; ids are numbered on from one another.
CHANNELS = 1000
MOVED = "channel_id long, salt int, mark long"


class LatestTime(StatefulProcessor):
    """The latest time seen of each channel of a block, as rows of channel, mark and when it moved."""

    def __init__(self, forget_after_ms: int | None = None):
        self.forget_after_ms = forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.marks = handle.getValueState("marks", "packed binary", self.forget_after_ms)

    def _known(self, now: int) -> pd.DataFrame:
        packed = self.marks.get()[0] if self.marks.exists() else b""
        held = np.frombuffer(packed, dtype="<i8").reshape(-1, 3)
        if self.forget_after_ms:
            held = held[held[:, 2] + self.forget_after_ms > now]
        return pd.DataFrame(held[:, 1:], index=held[:, 0], columns=["mark", "moved"])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> \
            Iterator[pd.DataFrame]:
        now = timerValues.getCurrentProcessingTimeInMs() if self.forget_after_ms else 0
        seen = pd.concat([part.groupby("channel_id")["published_ms"].max() for part in rows])
        latest = seen.groupby(level=0).max().astype("int64")
        known = self._known(now)
        # Compared as whole numbers: a missing one would turn the others into doubles.
        same = known.index.intersection(latest.index)
        behind = same[known.loc[same, "mark"].to_numpy() >= latest.loc[same].to_numpy()]
        moved = latest.drop(behind)
        if len(moved):
            fresh = pd.DataFrame({"mark": moved, "moved": np.int64(now)})
            held = pd.concat([known.drop(known.index.intersection(moved.index)), fresh])
            packed = np.column_stack([held.index, held["mark"], held["moved"]]).astype("<i8")
            self.marks.update((packed.tobytes(),))
            yield pd.DataFrame({"channel_id": moved.index, "salt": key[1], "mark": moved.to_numpy()})

    def close(self) -> None:
        pass


def moved_marks(entries: DataFrame, registry: DataFrame, salts: int = SALTS,
                forget_after_ms: int | None = None,
                max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """Marks that a stream of entries moves: ``channel_id, salt, mark``.

    Entries are those that ``registry`` takes as new; its marks are where the state begins.
    """
    fresh = new_entries(read_entries(entries), registry, max_bytes=max_bytes)
    salt = F.pmod(F.xxhash64("title", "published_ms"), F.lit(salts)).cast("int")
    block = F.floor(F.col("channel_id") / CHANNELS)
    timed = fresh.select(block.alias("block"), salt.alias("salt"), "channel_id", "published_ms")
    mode = {"timeMode": "processingTime"} if forget_after_ms else {"timeMode": "none"}
    return timed.groupBy("block", "salt").transformWithStateInPandas(
        LatestTime(forget_after_ms), MOVED, "update", **mode)


def advanced(registry: DataFrame, moved: DataFrame) -> DataFrame:
    """The registry with its marks raised to the highest that any salt has passed on."""
    latest = moved.groupBy(F.col("channel_id").alias("id")).agg(F.max("mark").alias("_latest"))
    raised = F.greatest(F.coalesce("last_updated", F.lit(0)), F.col("_latest"))
    return lookup_join(registry, latest, ["id"], "left").withColumn(
        "last_updated", F.when(F.col("_latest").isNull(), F.col("last_updated"))
        .otherwise(raised)).drop("_latest")
