"""Feed documents that a downloader has landed, as entries.

Documents lie in ``<folder>/channel_id=<id>/*.xml``, so the channel comes from the path.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from wirecount.functions.times import utc

# Element names of the two feed dialects.
DIALECTS = {
    "rss": ("item", "title STRING, pubDate STRING, published STRING"),
    "atom": ("entry", "title STRING, pubDate STRING, published STRING"),
}


def _shaped(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("channel_id").cast("long").alias("channel_id"), "title",
        F.coalesce("published", "pubDate").alias("published"))


def landed(spark: SparkSession, folder: str, landed_after: datetime | None = None) -> DataFrame:
    """``path, modified, bytes`` of the documents in the folder, from its listing alone."""
    reader = _after(spark.read.format("binaryFile").option("recursiveFileLookup", "true"),
                    landed_after)
    return reader.load(folder).select(
        "path", F.col("modificationTime").alias("modified"), F.col("length").alias("bytes"))


def _after(reader, moment: datetime | None):
    if moment is None:
        return reader
    return reader.option("modifiedAfter", utc(moment).strftime("%Y-%m-%dT%H:%M:%S")).option(
        "timeZone", "UTC")


def read_entries_xml(spark: SparkSession, folder: str, dialect: str = "rss",
                     landed_after: datetime | None = None,
                     documents: list[str] | None = None) -> DataFrame:
    """Entries ``(channel_id, title, published)``; ``published`` is null where absent.

    With ``landed_after`` only documents written after that moment are read, with ``documents``
    only these, so an hourly run does not parse again what earlier runs have seen.
    """
    tag, fields = DIALECTS[dialect]
    reader = spark.read.format("xml").option("rowTag", tag).schema(fields + ", channel_id LONG")
    if documents is not None:
        return _shaped(reader.option("basePath", folder).load(documents))
    return _shaped(_after(reader, landed_after).load(folder))


def stream_entries_xml(spark: SparkSession, folder: str, dialect: str = "rss",
                       **options) -> DataFrame:
    """The same as a stream over the landing folder."""
    tag, fields = DIALECTS[dialect]
    raw = (
        spark.readStream.format("xml").option("rowTag", tag).options(**options)
        .schema(fields + ", channel_id LONG").load(folder)
    )
    return _shaped(raw)
