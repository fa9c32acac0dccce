"""The given tables seen as headlines, channels, entries, messages and samples.

``oracle.py`` states the same views in SQL.
"""

from __future__ import annotations

import os
import uuid
from itertools import groupby

from pyspark.sql import DataFrame, SparkSession, functions as F

from wirecount.functions import ids, times
from wirecount.functions.pin import pinned
from wirecount.session import configure

STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "for", "he", "in", "is", "it", "of",
    "on", "or", "that", "the", "this", "to", "was", "with",
    "der", "die", "das", "ein", "nicht", "und",
    "de", "des", "du", "en", "et", "la", "le", "les", "un", "une",
    "el", "los", "que", "y",
)
SUFFIX = "(ing|ed|ly|s)$"
#: The engine's name for a partition without value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def shaped_headlines(docs: DataFrame) -> DataFrame:
    """Every document's whole text is a title; its number spreads it over ten days."""
    minute = F.col("doc_id") * 7919 % 14400
    published = F.timestamp_seconds(F.lit(1706313600) + minute * 60)
    return docs.select(
        "doc_id", F.col("text").alias("title"), published.alias("published"),
        F.col("source").alias("ChannelTitle"))


def headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped_headlines(documents(spark, sf_dir).select("doc_id", "text", "source"))


def messages(heads: DataFrame) -> DataFrame:
    published = times.iso_utc(F.col("published"))
    return heads.select(
        ids.message_id(F.col("ChannelTitle"), F.col("title"), published).alias("id"),
        "title", "published", "ChannelTitle")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", times.as_instant(F.col("ts")))


def stop_words(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(w,) for w in STOP_WORDS], "word string")


def lemmas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary made of the benchmark's words that carry a common ending."""
    from wirecount.operators.keywords import token_rows

    words = token_rows(table(spark, sf_dir, "benchmark"), title="text").distinct()
    base = F.regexp_replace("token", SUFFIX, "")
    return words.select("token", base.alias("lemma")).where(
        (F.col("lemma") != F.col("token")) & (F.length("lemma") >= 2))


def channel_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as registered channels."""
    return table(spark, sf_dir, "supplier").select(
        (F.col("s_suppkey") + 1).alias("id"), F.col("s_name").alias("title"),
        F.concat(F.lit("u"), F.col("s_suppkey")).alias("url"),
        (F.col("s_suppkey") * 1000).alias("last_updated"))


def channel_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a channel list in which urls come up more than once."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("position"), F.col("c_name").alias("title"),
        F.concat(F.lit("u"), F.col("c_custkey") % 1000).alias("url"),
        F.lit(None).cast("long").alias("last_updated"))


def reader_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as channels whose marks lie on different days; some have none."""
    day = F.lit(1704067200000) + F.col("c_nationkey").cast("long") * 86400000
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("title"),
        F.concat(F.lit("u"), F.col("c_custkey")).alias("url"),
        F.when(F.col("c_nationkey") != 0, day).alias("last_updated"))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shaped_entries(table(spark, sf_dir, "events"))


def shaped_entries(rows: DataFrame) -> DataFrame:
    """Events as feed entries: three date spellings, unreadable and missing dates, and
    missing titles among them."""
    ts = times.as_instant(F.col("ts"))
    kind = F.col("event_id") % 11
    published = (
        F.when(kind == 0, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'EST'"))
        .when(kind == 1, F.lit(None).cast("string"))
        .when(kind == 2, F.date_format(ts, "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(kind == 3, F.concat(F.date_format(ts + F.expr("INTERVAL 2 HOURS"),
                                                "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    )
    title = F.concat_ws(" ", "event_type", "props")
    return pinned(
        rows, channel_id=F.col("user_id"), published=published,
        entry_title=F.when(F.col("event_id") % 13 != 0, title),
    ).select("channel_id", F.col("entry_title").alias("title"), "published")


def feed_documents(rows: DataFrame, size: int = 100) -> DataFrame:
    """Entries as feed documents ``channel_id, value``: a channel's entries are in one document,
    those of a busy one in as many of about ``size`` entries as it takes."""
    def element(name, value):
        escaped = F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.when(value.isNotNull(), F.concat(
            F.lit(f"<{name}>"), escaped, F.lit(f"</{name}>"))).otherwise("")

    items = rows.select("channel_id", F.concat(
        F.lit("<item>"), element("title", F.col("title")),
        element("pubDate", F.col("published")), F.lit("</item>")).alias("item"))
    parts = items.groupBy("channel_id").agg(F.ceil(F.count("*") / size).alias("parts"))
    dealt = items.join(parts, "channel_id").withColumn(
        "part", F.pmod(F.xxhash64("item"), F.col("parts")))
    return dealt.groupBy("channel_id", "part").agg(F.concat(
        F.lit("<rss><channel>"), F.array_join(F.collect_list("item"), ""),
        F.lit("</channel></rss>")).alias("value")).select("channel_id", "value")


def land(documents: DataFrame, folder: str) -> None:
    """Leave every document ``channel_id, value`` as a file of its own below its channel's folder.

    The documents of a channel lie in one partition, one after another. On a file system of this
    machine files are written by the tasks themselves, as a downloader does: the engine's writer
    starts two processes there for each. A task that is run again replaces its files.
    """
    spark = documents.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if place.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() != "file":
        documents.write.mode("append").option("maxRecordsPerFile", 1).partitionBy(
            "channel_id").text(folder)
        return
    name, at = uuid.uuid4().hex, place.toUri().getPath()

    def write(rows):
        for channel, held in groupby(rows, key=lambda r: r["channel_id"]):
            own = f"{at}/channel_id={NO_VALUE if channel is None else channel}"
            os.makedirs(own, exist_ok=True)
            for number, row in enumerate(held):
                with open(f"{own}/{name}-{number}.xml", "w", encoding="utf-8") as f:
                    f.write(row["value"])

    documents.foreachPartition(write)


def topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as JSON messages, and documents as values that are no JSON."""
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    good = events(spark, sf_dir).select(
        F.concat(F.lit("e"), F.col("event_id")).alias("key"),
        F.to_json(F.struct(
            F.col("event_id").cast("string").alias("id"), F.col("event_type").alias("title"),
            ts.alias("published"), F.col("props").alias("ChannelTitle"),
        )).cast("binary").alias("value"))
    bad = documents(spark, sf_dir).select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("key"),
        F.concat(F.lit("text: "), F.col("text")).cast("binary").alias("value"))
    return good.unionByName(bad)


def offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as topic positions."""
    return events(spark, sf_dir).select(
        (F.col("event_id") % 3).cast("int").alias("partition"),
        F.floor(F.col("event_id") / 3).cast("long").alias("offset"),
        F.col("ts").alias("timestamp"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as metric samples of all kinds."""
    from wirecount.operators.metrics import KINDS

    kind = F.element_at(F.array(*(F.lit(k) for k in KINDS)),
                        (F.col("user_id") % 4 + 1).cast("int"))
    return events(spark, sf_dir).select(
        "ts", "event_id", F.col("event_type").alias("name"), kind.alias("kind"),
        F.col("value").cast("string").alias("value"))
