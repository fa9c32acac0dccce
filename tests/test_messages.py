import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tests.conftest import rows
from wirecount.functions import ids
from wirecount.operators import messages as msg, registry as reg

SAMPLE = json.dumps({
    "id": "0d5f2c1e-7a44-4f0b-9c1d-2b6f7e8a9b10",
    "title": "Markets today: the lender’s upgrade was no surprise",
    "published": "2024-03-05T08:15:30Z", "ChannelTitle": "Markets"}, ensure_ascii=False)


def topic(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "value string")
    return df.select(F.lit(None).cast("binary").alias("key"),
                     F.col("value").cast("binary").alias("value"))


def test_sample_message(spark):
    got = msg.accepted(msg.parse_messages(topic(spark, [SAMPLE]))).collect()
    assert [tuple(r) for r in got] == [(
        "0d5f2c1e-7a44-4f0b-9c1d-2b6f7e8a9b10",
        "Markets today: the lender’s upgrade was no surprise",
        datetime(2024, 3, 5, 8, 15, 30), "Markets")]


def test_nothing_is_lost(spark):
    values = [SAMPLE, "{broken", None, "", '{"id": "1", "extra": 2}', '{"published": "soon"}', "[]"]
    parsed = msg.parse_messages(topic(spark, values))
    assert parsed.count() == len(values)
    assert sorted(r["reject_reason"] for r in msg.rejected(parsed).collect()) == [
        "malformed", "malformed", "malformed", "no value", "no value"]
    assert {r["id"] for r in msg.accepted(parsed).collect()} == {
        "0d5f2c1e-7a44-4f0b-9c1d-2b6f7e8a9b10", "1"}


def test_there_and_back(spark):
    parsed = msg.accepted(msg.parse_messages(topic(spark, [SAMPLE])))
    again = msg.accepted(msg.parse_messages(msg.to_messages(parsed)))
    assert rows(again) == rows(parsed)
    value = msg.to_messages(parsed).first()["value"]
    assert json.loads(value) == json.loads(SAMPLE)


def test_same_parts_same_id(spark):
    given = [("a", "b", None), ("a", "b", None), ("ab", "", None), ("a", None, "b"), ("a", "", "b"),
             ("a", "-", "b"), ("1:a", "b", None)]
    df = spark.createDataFrame(given, "x string, y string, z string").coalesce(1)
    made = [r[0] for r in df.select(ids.message_id(F.col("x"), F.col("y"), F.col("z"))).collect()]
    assert made[0] == made[1] and len(set(made)) == 6


def test_channels_of_one_title_keep_their_messages(spark):
    registry = spark.createDataFrame([(1, "News", "ua", 0), (2, "News", "ub", 0)],
                                     "id long, title string, url string, last_updated long")
    entries = spark.createDataFrame([(i, "One", "2024-01-01T00:00:00Z") for i in (1, 2)],
                                    "channel_id long, title string, published string")
    sent = reg.entry_messages(reg.new_entries(reg.read_entries(entries), registry))
    assert msg.dedup(sent.unionByName(sent)).count() == 2


def test_dedup(spark):
    df = spark.createDataFrame([("1", "x")] * 500 + [("2", "y")], "id string, title string")
    assert rows(msg.dedup(df)) == [("1", "x"), ("2", "y")]


def test_topic_size(spark):
    offsets = [(0, o) for o in range(5, 12)] + [(1, 3)]
    df = spark.createDataFrame(offsets, "partition int, offset long")
    assert msg.topic_size(df).first()[0] == 8
    assert msg.topic_size(df.limit(0)).first()[0] == 0


def test_retention_is_strict(spark):
    as_of = datetime(2024, 1, 3)
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 1, 0, 0, 1),)],
                               "ts timestamp")
    kept = msg.newer_than(df, F.col("ts"), as_of, timedelta(days=2))
    assert rows(kept) == [(datetime(2024, 1, 1, 0, 0, 1),)]


def test_per_hour(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 5, 59, 59),), (datetime(2024, 1, 1, 6),),
                                (datetime(2024, 1, 1, 6, 30),), (None,)], "published timestamp")
    assert rows(msg.messages_per_hour(df)) == [("2024-01-01 05", 1), ("2024-01-01 06", 2)]
