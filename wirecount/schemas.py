"""Column layouts shared by the jobs."""

from pyspark.sql import types as T

# The JSON message and the tables keep these names.
MESSAGE = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("published", T.TimestampType()),
    T.StructField("ChannelTitle", T.StringType()),
])

TOPIC = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

REGISTRY = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("last_updated", T.LongType()),
])

ENTRY = T.StructType([
    T.StructField("channel_id", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("published", T.StringType()),
])

METRIC = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("name", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("value", T.StringType()),
])
