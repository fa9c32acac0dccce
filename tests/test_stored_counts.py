"""Complete counts that lie by label, and tops of what is stored without summing everything."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL, plan, rows
from wirecount.operators import keywords as kw, rollup
from workload import inputs


@pytest.fixture(scope="module")
def named(spark):
    return inputs.headlines(spark, SMALL).select(
        F.date_format("published", "yyyy-MM-dd").alias("_label"), "title")


# All labels small, the larger ones hot, all hot.
@pytest.mark.parametrize("label_bytes", [64 << 20, 50_000, 1])
def test_labels_of_any_size_are_counted(named, label_bytes):
    sizes = [r[0] for r in named.groupBy("_label").agg(F.sum(F.octet_length("title"))).select(
        F.col("sum(octet_length(title))")).collect()]
    if label_bytes == 50_000:
        assert min(sizes) <= label_bytes < max(sizes)
    columns = ["_label", "keyword", "count"]
    got = rollup._counted(named, label_bytes=label_bytes, task_bytes=10_000).select(*columns)
    assert rows(got) == rows(kw.keyword_counts(named, by=["_label"]).select(*columns))


def test_titles_are_shuffled_instead_of_their_counts(spark):
    """One shuffle, of titles by label; a label's counts are in one partition."""
    got = rollup.keywords_per(inputs.headlines(spark, SMALL), "hour", k=None)
    assert plan(got).count("Exchange ") == 1 and "rangepartitioning(_label" in plan(got)
    held = got.withColumn("p", F.spark_partition_id()).groupBy("hour").agg(F.count_distinct("p"))
    assert {r[1] for r in held.collect()} == {1}


@pytest.mark.parametrize("k, buckets", [(1, 1 << 15), (3, 1 << 15), (3, 4), (20, 1 << 15)])
def test_the_top_of_stored_sums(spark, k, buckets):
    # Keywords that come up in one hour and in all, several times in one; null, negative and few.
    data = [(p, f"w{i}", 1 + i * i * (h + p) % 97) for p in (1, 2) for h in range(24)
            for i in range(60) if (i + h) % (1 + i % 5) == 0]
    data += [(1, "w7", 500), (1, "w7", 400), (1, None, 5), (3, "a", 2), (3, "b", None),
             (4, "up", 9), (4, "up", -9), *((4, f"v{i}", i) for i in range(1, 30)), (5, "x", 0)]
    counts = spark.createDataFrame(data, "_period int, keyword string, count long")
    whole = kw.top_k(counts.groupBy("_period", "keyword").agg(F.sum("count").alias("count")), k,
                     by=["_period"])
    got = rollup.top_of_sums(counts, k, buckets)
    assert sorted(map(str, got.select(*whole.columns).collect())) == sorted(
        map(str, whole.collect()))


def test_a_stored_rollup_sums_few_keywords(spark):
    """What meets its sum: keywords of buckets that a top can be in, and the same top."""
    counts = rollup.keywords_per(inputs.headlines(spark, SMALL), "hour", k=None).checkpoint()
    got = rollup.roll_up(counts, "day", k=3, stored=True)
    assert rows(got) == rows(rollup.roll_up(counts, "day", k=3))
    assert "LeftSemi" in plan(got)
