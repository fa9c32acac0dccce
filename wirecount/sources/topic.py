"""The message topic, read as a stream or a table and written in bulk.

The Kafka connector comes with ``--packages`` on a cluster. Every other format a
DataFrame can be read from serves the same layout, as long as it has a ``value`` column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wirecount.schemas import TOPIC

DEFAULT_TOPIC = "feeds"


def kafka_options(servers: str, topic: str = DEFAULT_TOPIC, starting: str = "latest",
                  fail_on_data_loss: bool = False,
                  min_partitions: int | None = None) -> dict[str, str]:
    """Source options; ``min_partitions`` reads a topic of few partitions in more tasks."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    return options


def topic_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                 **options) -> DataFrame:
    """The topic as a stream: from Kafka, or from files in ``path``."""
    reader = spark.readStream.format(fmt).options(**options)
    return reader.load() if fmt == "kafka" else reader.schema(TOPIC).load(path)


def topic_table(spark: SparkSession, fmt: str = "kafka", path: str | None = None,
                **options) -> DataFrame:
    """What the topic holds now, as a batch."""
    if fmt == "kafka":
        options = {**options, "startingOffsets": "earliest"}
        return spark.read.format(fmt).options(**options).load()
    return spark.read.schema(TOPIC).format(fmt).options(**options).load(path)


def write_topic(messages: DataFrame, fmt: str = "kafka", path: str | None = None,
                mode: str = "append", **options) -> None:
    """Send ``key, value, topic`` rows: one bulk write, acknowledged as a whole."""
    writer = messages.write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode(mode).save(path)
