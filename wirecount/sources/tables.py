"""Keyword tables in the catalog, partitioned by label.

A label is written by replacing its partition, so a rerun replaces and a replay changes
nothing. Counts are BIGINT: a frequent word passes the range of INT at scale.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from wirecount.functions.times import PYTHON_FORMATS, utc
from wirecount.operators.rollup import label_range
from wirecount.operators.series import latest_by
from wirecount.sources import compaction, coverage, partitions

# Table names and their label columns.
KEYWORD_TABLES = {"keywords_hour": "hour", "keywords_day": "day", "keywords_month": "month"}
BATCH_COUNTS = compaction.BATCHES
METRICS = "metric_samples"

# How long hourly rows and topic messages are kept.
HOUR_TTL = timedelta(seconds=172800)
TOPIC_RETENTION = timedelta(hours=24)


def create_tables(spark: SparkSession) -> None:
    for table, unit in KEYWORD_TABLES.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (keyword STRING, count BIGINT, "
                  f"{unit} STRING) USING parquet PARTITIONED BY ({unit})")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {BATCH_COUNTS} (hour STRING, keyword STRING, "
              "count BIGINT, day DATE, run STRING, batch_id BIGINT) USING parquet "
              "OPTIONS (compression 'zstd') PARTITIONED BY (day, run, batch_id)")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {METRICS} (ts TIMESTAMP, name STRING, kind STRING, "
              "value STRING, day DATE) USING parquet PARTITIONED BY (day)")
    compaction.create(spark)
    coverage.create(spark)


def overwrite_labels(rows: DataFrame, table: str) -> None:
    """Replace exactly the labels that occur in ``rows``.

    The rows are rebalanced by label at run time: small labels share a task, a label with
    more rows than fit one is split over several. Files have the highest counts first.
    """
    label = KEYWORD_TABLES[table]
    partitions.replace(
        rows.select(*rows.sparkSession.table(table).columns)
        .hint("rebalance", label)
        .sortWithinPartitions(label, F.desc("count"), F.asc("keyword")), table)


def write_batch_counts(counts: DataFrame, batch_id: int, run: str = "",
                       in_order: bool = False, packed: bool = False) -> None:
    """Keep the complete hourly counts of a batch; a replay replaces them.

    ``run`` names the stream that the batch number belongs to, so batches of another stream,
    or of a new checkpoint, are others. Rows are rebalanced by day, so a batch over many days
    leaves a file per day and not one per day and task. Those of ``keywords_per`` without a top
    lie ``in_order`` of their hours and are written where they lie: a file has few hours. Where they
    are ``packed``, each task sorts them by keyword too, which makes files far smaller.
    """
    rows = (
        counts.withColumn("day", F.to_date(F.substr("hour", F.lit(1), F.lit(10))))
        .withColumn("run", F.lit(run or "none"))
        .withColumn("batch_id", F.lit(batch_id).cast("long"))
        .select("hour", "keyword", "count", "day", "run", "batch_id")
    )
    if not in_order:
        rows = rows.hint("rebalance", "day").sortWithinPartitions("day", "hour")
    elif packed:
        # With the partition columns first, or the writer would sort once more.
        rows = rows.sortWithinPartitions("day", "run", "batch_id", "hour", "keyword")
    partitions.replace(rows, BATCH_COUNTS)


def batch_hours(spark: SparkSession, batch_id: int, run: str = "") -> list[str]:
    """The hours a batch has counts for, merged or not; one column of the batch's own files."""
    run = run or "none"
    rows = spark.table(BATCH_COUNTS).where((F.col("batch_id") == batch_id) & (F.col("run") == run))
    hours = rows.select("hour").unionByName(compaction.merged_hours(spark, batch_id, run))
    return sorted(r["hour"] for r in hours.distinct().collect())


def stored_counts(spark: SparkSession, hours: Sequence[str]) -> DataFrame:
    """``hour, keyword, count, day`` of the given hours as they are kept: not summed over batches."""
    days = sorted({datetime.strptime(h[:10], "%Y-%m-%d").date() for h in hours})
    return compaction.complete(spark, days[0], days[-1]).where(
        F.col("day").isin(days) & F.col("hour").isin(list(hours)))


def hour_counts(spark: SparkSession, hours: Sequence[str]) -> DataFrame:
    """Complete counts of the given hours, over all batches."""
    return stored_counts(spark, hours).groupBy("hour", "keyword").agg(
        F.sum("count").alias("count"))


def batch_counts(spark: SparkSession, start: datetime, end: datetime) -> DataFrame:
    """Complete counts of the days a time range touches; other days are not read."""
    return compaction.complete(spark, utc(start).date(), utc(end).date())


def read_labels(spark: SparkSession, table: str, low: str | None = None,
                high: str | None = None) -> DataFrame:
    """Rows of the half-open label range, reading only those partitions."""
    return label_range(spark.table(table), KEYWORD_TABLES[table], low, high)


def delete_label(spark: SparkSession, table: str, *labels: str) -> None:
    column = KEYWORD_TABLES[table]
    partitions.drop(spark, table, [{column: label} for label in labels])


def labels(spark: SparkSession, table: str) -> list[str]:
    """Labels present, from the catalog alone."""
    return sorted(p[KEYWORD_TABLES[table]] for p in partitions.listed(spark, table))


def expire(spark: SparkSession, table: str, as_of: datetime, keep_for: timedelta) -> list[str]:
    """Drop labels that are older than ``keep_for``; whole partitions, no rewrite.

    That they have gone is noted before they go.
    """
    unit = KEYWORD_TABLES[table]
    moment = utc(as_of) - keep_for
    bound = moment.strftime(PYTHON_FORMATS[unit])
    old = [label for label in labels(spark, table) if label < bound]
    if old:
        coverage.move(spark, table, expired=moment)
        delete_label(spark, table, *old)
    return old


def expire_batches(spark: SparkSession, as_of: datetime, keep_for: timedelta) -> list[str]:
    """Drop the days of batch counts, merged ones too, that ended before ``keep_for`` ago."""
    moment = utc(as_of) - keep_for
    bound = moment.strftime("%Y-%m-%d")
    gone: set[str] = set()
    noted = False
    # The sums go before the list of what is in them, so no batch comes to light again.
    for table in (BATCH_COUNTS, compaction.DAYS, compaction.MERGED):
        old = [p for p in partitions.listed(spark, table) if p["day"] < bound]
        if old and not noted:
            coverage.move(spark, BATCH_COUNTS, expired=moment.replace(
                hour=0, minute=0, second=0, microsecond=0))
            noted = True
        partitions.drop(spark, table, old)
        gone |= {p["day"] for p in old}
    return sorted(gone)


def merged(existing: DataFrame, incoming: DataFrame, key: Sequence[str],
           order: Sequence[str] = ()) -> DataFrame:
    """Upsert: one row per ``key``, an incoming row before an existing one.

    The key is the caller's: ``(label, keyword)`` keeps one count per keyword, while
    ``(label, count, keyword)`` keeps one row per different count.
    """
    both = existing.withColumn("_new", F.lit(0)).unionByName(incoming.withColumn("_new", F.lit(1)))
    return latest_by(both, list(key), ["_new", *order]).drop("_new")


def upsert(incoming: DataFrame, table: str, key: Sequence[str]) -> None:
    """Merge rows into the labels they carry; other labels are not read."""
    spark = incoming.sparkSession
    label = KEYWORD_TABLES[table]
    touched = [r[0] for r in incoming.select(label).distinct().collect()]
    existing = spark.table(table).where(F.col(label).isin(touched))
    overwrite_labels(merged(existing, incoming.select(*existing.columns), key), table)


def append_metrics(samples: DataFrame) -> None:
    (
        samples.withColumn("day", F.to_date("ts"))
        .write.mode("append").insertInto(METRICS)
    )
