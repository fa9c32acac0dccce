"""Physical plans that have to hold at any size."""

import re

import pytest

from tests.conftest import SMALL, plan
from workload.queries import QUERIES

BATCH = [n for n in QUERIES if not n.startswith("stream_")]
#: Queries that read back what a job has stored.
STORED = ("stored_rollup", "daily_exact", "two_batches_of_one_hour", "channel_file",
          "bucketed_range", "bucketed_by_month")


def read_columns(shown):
    """The columns that each scan of a plan reads."""
    return [set(re.findall(r"(\w+):", part.split(">")[0]))
            for part in shown.split("ReadSchema: struct<")[1:]]


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_products(spark, name):
    shown = plan(QUERIES[name](spark, SMALL))
    for bad in ("EvalPython", "InPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in shown


@pytest.mark.parametrize("name", [n for n in BATCH if n not in STORED])
def test_only_needed_columns_are_read(spark, name):
    """No scan of documents or customers takes in a column that no query looks at."""
    for columns in read_columns(plan(QUERIES[name](spark, SMALL))):
        assert not columns & {"n_chars", "lang", "c_acctbal", "s_acctbal", "s_nationkey"}


@pytest.mark.parametrize("name", ["keyword_counts_cleaned_by_shuffle",
                                  "incremental_new_by_shuffle"])
def test_a_side_beyond_the_bound_is_shuffled(spark, name):
    shown = plan(QUERIES[name](spark, SMALL))
    assert "BroadcastHashJoin" not in shown and "SortMergeJoin" in shown


@pytest.mark.parametrize("name, operator", [
    ("keyword_top20", "TakeOrderedAndProject"), ("latest_hour_top20", "TakeOrderedAndProject"),
    ("newest_point", "TakeOrderedAndProject"), ("hourly_top20", "WindowGroupLimit"),
    ("daily_rollup", "WindowGroupLimit"), ("monthly_exact", "WindowGroupLimit"),
    ("keyword_counts_cleaned", "BroadcastHashJoin"), ("unigram_counts", "partial_count"),
    ("keyword_counts_cleaned", "partial_count"), ("daily_rollup", "partial_sum"),
    ("latest_per_series", "partial_max_by"), ("message_dedup", "partial_first"),
    ("registry_advance", "partial_max"), ("topic_size", "partial_max"),
])
def test_operator(spark, name, operator):
    assert operator in plan(QUERIES[name](spark, SMALL))


def test_stages_of_the_ml_pipeline_run_once(spark):
    shown = plan(QUERIES["ml_bigrams"](spark, SMALL))
    assert "Generate" in shown and "Filter (isnotnull(ngrams" not in shown
    assert shown.count("UDF(") == 3


def test_first_url_is_combined_on_the_map_side(spark):
    from wirecount.operators.registry import first_per_url
    from workload.inputs import channel_candidates

    assert "partial_min_by" in plan(
        first_per_url(channel_candidates(spark, SMALL), ["position"]))


@pytest.mark.parametrize("name, pushed", [
    ("ttl_filter", "GreaterThan(ts"), ("series_range", "In(event_type"),
    ("series_range", "LessThan(ts"), ("bucketed_range", "GreaterThan(ts"),
    ("retained_messages", "GreaterThan(ts"), ("series_range_listed", "EqualTo(c_mktsegment"),
])
def test_filter_reaches_the_scan(spark, name, pushed):
    assert pushed in plan(QUERIES[name](spark, SMALL))


@pytest.mark.parametrize("name", BATCH)
def test_no_window_or_sort_in_one_task(spark, name):
    """All rows meet in one task only as the partial results of an aggregate or a top-k."""
    lines = plan(QUERIES[name](spark, SMALL)).split("\n")
    for at, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = next(x for x in lines[at + 1:] if not re.search(r"\* ?\(|Project", x) or
                         re.search("partial_|Limit|keys=", x))
            assert re.search("partial_|Limit|Aggregate|LocalTableScan|Range", below), line


def test_only_the_buckets_touched_are_read(spark):
    for name in ("bucketed_range", "bucketed_by_month"):
        shown = plan(QUERIES[name](spark, SMALL))
        assert "date" in shown.split("PartitionFilters: [")[1].split("]")[0]
