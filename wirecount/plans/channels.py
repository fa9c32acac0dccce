"""Daily job: add the channels of a list to the registry."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from wirecount.operators.metrics import samples
from wirecount.operators.registry import new_channels
from wirecount.sources import snapshots, tables
from wirecount.sources.channels import POSITION, read_channels


def add_channels(spark: SparkSession, csv_path: str, root: str, as_of: datetime,
                 metrics: bool = True) -> tuple[int, int, DataFrame]:
    """Insert what is absent by url; returns (inserted, total, rejected rows)."""
    listed = read_channels(spark, csv_path)
    good = listed.where("reject_reason IS NULL").drop("reject_reason")
    registry = snapshots.read(spark, f"{root}/{snapshots.CHANNELS}")
    if registry is None:
        registry = snapshots.load_registry(spark, root)
    added = new_channels(good, registry, POSITION)
    snapshots.publish_channels(registry.unionByName(added), root, strict=False)
    # Counted from the written lists: a row count of a parquet file reads no column.
    total = snapshots.read(spark, f"{root}/{snapshots.CHANNELS}").count()
    inserted = total - registry.count()
    if metrics:
        tables.append_metrics(samples(
            spark, as_of, "gauge", channels_new=inserted, channels_total=total))
    return inserted, total, listed.where("reject_reason IS NOT NULL")
