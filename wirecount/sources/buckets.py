"""Large keyword tables in buckets by keyword, sorted: an upsert moves the incoming rows only.

Every label is a partition of ``buckets`` files, the same keyword always in the same one. Rows that
come in are dealt to the same buckets once; existing and incoming rows of a bucket then meet in
the task that reads and writes it. What is there already is not shuffled, however large it is.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from wirecount.operators.series import latest_by
from wirecount.sources import partitions

#: Buckets by keyword serve a join by label and keyword.
PLANNING = {"spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
            "spark.sql.requireAllClusterKeysForCoPartition": "false"}


def create(spark: SparkSession, table: str, unit: str = "hour", buckets: int = 64) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} (keyword STRING, count BIGINT, {unit} STRING) "
              f"USING parquet PARTITIONED BY ({unit}) "
              f"CLUSTERED BY (keyword) SORTED BY (keyword) INTO {buckets} BUCKETS")


def layout(spark: SparkSession, table: str) -> tuple[str, int]:
    """The label column and the number of buckets, from the catalog."""
    told = {r["col_name"]: r["data_type"] for r in spark.sql(
        f"DESCRIBE TABLE EXTENDED {table}").collect()}
    return spark.table(table).columns[-1], int(told["Num Buckets"])


@contextmanager
def _planned(spark: SparkSession):
    before = {name: spark.conf.get(name) for name in PLANNING}
    for name, value in PLANNING.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def merged(incoming: DataFrame, table: str) -> DataFrame:
    """The rows of the labels that come in after an upsert: one per label and keyword, an incoming
    one before an existing one, of several the highest."""
    spark = incoming.sparkSession
    label, buckets = layout(spark, table)
    incoming = incoming.select("keyword", "count", label)
    labels = [p[label] for p in partitions.listed(spark, table)]
    there = spark.table(table)
    if labels:
        touched = incoming.select(label).where(F.col(label).isin(labels)).distinct()
        there = there.where(F.col(label).isin([r[0] for r in touched.collect()]))
    # One row per key, combined before it moves, then dealt as the table is.
    dealt = latest_by(incoming, [label, "keyword"], ["count"]).select(
        label, "keyword", F.struct("count").alias("_new")).repartition(buckets, "keyword")
    return there.join(dealt, [label, "keyword"], "full_outer").select(
        "keyword", F.when(F.col("_new").isNull(), F.col("count"))
        .otherwise(F.col("_new.count")).alias("count"), label)


def upsert(incoming: DataFrame, table: str) -> None:
    """Merge rows into the labels they carry; other labels are not read."""
    with _planned(incoming.sparkSession):
        label = layout(incoming.sparkSession, table)[0]
        rows = merged(incoming, table)
        partitions.replace(rows.sortWithinPartitions(label, "keyword"), table)
