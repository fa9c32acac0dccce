"""Ingest as a stream over landed feed documents.

A channel's mark is state that one batch reads and the next one continues from. It is
kept as a versioned snapshot joined in each batch rather than as keyed operator state:
a join spreads the entries of a busy channel, keyed state would send them all to one task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from wirecount.plans.ingest import ingest
from wirecount.streaming.hourly import stream_name


def start_ingest(entries: DataFrame, root: str, send: Callable[[DataFrame, int], None],
                 checkpoint: str, every: str | None = "1 hour",
                 rejects_path: str | None = None) -> StreamingQuery:
    """A batch is a run named by its stream and number: replayed, it reads the same marks
    again, and a batch of another checkpoint goes on from the marks that are there."""
    def run(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            name = f"{stream_name(batch.sparkSession)}-{batch_id}"
            ingest(batch, root, send, run=name, rejects_path=rejects_path)

    trigger = {"availableNow": True} if every is None else {"processingTime": every}
    return (
        entries.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
