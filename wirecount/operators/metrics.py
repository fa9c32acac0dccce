"""Metric samples by kind, and metrics taken while a job runs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from wirecount.functions.times import instant, utc
from wirecount.schemas import METRIC

KINDS = ("gauge", "counter", "timing", "set")


def samples(spark: SparkSession, ts: datetime, kind: str, **values) -> DataFrame:
    """Samples taken now, ready to append to the metrics table."""
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    rows = [(utc(ts), name, kind, str(value)) for name, value in values.items()]
    return spark.createDataFrame(rows, METRIC)


def set_samples(rows: DataFrame, column: str, ts: datetime, name: str) -> DataFrame:
    """A sample of kind ``set`` for every different value of a column; nulls are no members."""
    members = rows.select(F.col(column).cast("string").alias("value")).where("value IS NOT NULL")
    return members.distinct().select(
        instant(ts).alias("ts"), F.lit(name).alias("name"), F.lit("set").alias("kind"), "value")


def observed(df: DataFrame, **exprs: Column) -> tuple[DataFrame, Observation]:
    """Count things while ``df`` is written, instead of running it a second time."""
    seen = Observation()
    return df.observe(seen, *(e.alias(name) for name, e in exprs.items())), seen


def gauges(rows: DataFrame, tie: list[str] = []) -> DataFrame:
    """Last value per name."""
    return rows.groupBy("name").agg(
        F.max_by("value", F.struct("ts", *tie)).alias("last_value"))


def counters(rows: DataFrame) -> DataFrame:
    """Sum per name; a sample without a value counts one, an unreadable one is ``unread``."""
    number = F.col("value").try_cast("double")
    unread = F.col("value").isNotNull() & number.isNull()
    return rows.groupBy("name").agg(
        F.sum(F.when(~unread, F.coalesce(number, F.lit(1.0)))).alias("total"),
        F.count_if(unread).alias("unread"))


def timings(rows: DataFrame) -> DataFrame:
    value = F.col("value").try_cast("double")
    return rows.groupBy("name").agg(
        F.min(value).alias("shortest"), F.avg(value).alias("mean"),
        F.max(value).alias("longest"),
        F.percentile_approx(value, 0.95).alias("p95"),
        F.count_if(F.col("value").isNotNull() & value.isNull()).alias("unread"))


def sets(rows: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of different values per name."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return rows.groupBy("name").agg(count("value").alias("members"))


def metric_rollup(rows: DataFrame, tie: list[str] = []) -> DataFrame:
    """All kinds at once: ``name, kind`` and the figure each kind is read by.

    ``(name, kind)`` is spread over its values by the distinct count, and every other
    figure is combined on the map side, so a hot metric name needs no special care.
    """
    number = F.col("value").try_cast("double")
    of = lambda kind, column: F.when(F.col("kind") == kind, column)
    return rows.groupBy("name", "kind").agg(
        F.max_by("value", F.struct("ts", *tie)).alias("last_value"),
        F.sum(of("counter", F.coalesce(number, F.lit(1.0)))).alias("total"),
        F.min(of("timing", number)).alias("shortest"),
        F.avg(of("timing", number)).alias("mean"),
        F.max(of("timing", number)).alias("longest"),
        F.count_distinct(of("set", F.col("value"))).alias("members"),
    )
