"""Channel lists in CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wirecount.functions.times import blank_to

POSITION = ["file_path", "block_start", "row_order"]


def read_channels(spark: SparkSession, path: str) -> DataFrame:
    """Channels of CSV files with a header, in UTF-8.

    Columns are found by their names, in any order; quoted fields may hold line breaks. Adds
    where each row stood (``POSITION``; files are ordered by path) and ``reject_reason``.
    Empty lines are no rows; a blank mark is 0. Files of one folder share one header.
    """
    raw = (
        spark.read.option("header", True).option("encoding", "UTF-8").option("escape", '"')
        .option("multiLine", True).option("enforceSchema", False).csv(path)
    )
    named = {c.strip().lower(): c for c in raw.columns}

    def field(name: str):
        return raw[f"`{named[name]}`"] if name in named else F.lit(None).cast("string")

    marked = raw.select(
        field("title").alias("title"), field("url").alias("url"),
        blank_to(field("last_updated"), 0).alias("last_updated"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_order"))
    reason = (
        F.when(F.col("last_updated").isNull(), "mark is no number")
        .when(F.col("title").isNull(), "no title")
        .when(F.col("url").isNull(), "no url")
    )
    return marked.withColumn("reject_reason", reason)
