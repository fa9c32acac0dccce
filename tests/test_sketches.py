"""Merged sketches and summaries against exact figures."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan
from wirecount.operators import sketches, summaries
from wirecount.operators.keywords import top_k


def samples(spark, n=6000):
    start = datetime(2024, 1, 30)
    rng = random.Random(5)
    rows = [(start + timedelta(minutes=rng.randrange(6000)), rng.choice(["a", "b"]),
             str(rng.choice([rng.gauss(100, 20), rng.randrange(500)]))) for _ in range(n)]
    rows += [(start, "a", "no number"), (start, "a", None), (None, "a", "1"), (start, "words", "x")]
    return spark.createDataFrame(rows, "ts timestamp, name string, value string")


@pytest.mark.parametrize("unit", ["day", "month"])
def test_merged_sketches_keep_to_their_error(spark, unit):
    rows = samples(spark)
    hourly = sketches.sketched(rows)
    once = {(r["period"], r["name"]): r for r in sketches.figures(
        sketches.merged(hourly, unit), [0.05, 0.5, 0.95]).collect()}
    twice = sketches.figures(sketches.merged(sketches.merged(hourly, "day"), unit), [0.5])
    assert {(r["period"], r["name"]): r["n"] for r in twice.collect()} == {
        k: r["n"] for k, r in once.items()}
    number = F.col("value").try_cast("double")
    exact = rows.where("ts IS NOT NULL").groupBy(F.date_trunc(unit, "ts").alias("p"), "name").agg(
        F.count("*").alias("n"), F.count_distinct("value").alias("m"), F.min(number).alias("lo"),
        F.max(number).alias("hi"), F.sum(number).alias("t"),
        F.sort_array(F.collect_list(number)).alias("all")).collect()
    assert len(exact) == len(once)
    for e in exact:
        r = once[(e["p"], e["name"])]
        assert (r["n"], r["shortest"], r["longest"]) == (e["n"], e["lo"], e["hi"])
        assert abs(r["members"] - e["m"]) <= max(1, 0.04 * e["m"])
        if not e["all"]:
            assert r["p50"] is None and r["total"] is None and r["unread"] == 1
            continue
        assert r["total"] == pytest.approx(e["t"])
        n = len(e["all"])
        for q, name in ((0.05, "p5"), (0.5, "p50"), (0.95, "p95")):
            low, high = (e["all"][min(max(int((q + d) * n), 0), n - 1)] for d in (-0.03, 0.03))
            assert low <= r[name] <= high


def test_months_are_merged_without_the_samples(spark):
    hourly = sketches.sketched(samples(spark, 50))
    shown = plan(sketches.merged(hourly.select("*"), "month"))
    assert "partial_hll_union_agg" in shown and "partial_kll_merge_agg_double" in shown
    assert sketches.merged(hourly.where("false"), "month").count() == 0


def counts(spark, seed, hours=30, words=60, skew=1.3):
    rng = random.Random(seed)
    rows = []
    for h in range(hours):
        for w in range(words):
            n = int(1000 / (w + 1) ** skew * rng.random()) + rng.randrange(3)
            if n:
                rows.append((f"2024-01-{1 + h // 24:02} {h % 24:02}", f"w{w:02}", n))
    return spark.createDataFrame(rows, "hour string, keyword string, count long")


@pytest.mark.parametrize("seed, m, k", [(1, 5, 3), (2, 10, 5), (3, 60, 20), (4, 3, 10), (5, 1, 1)])
def test_a_top_from_summaries_holds_the_true_one_or_says_so(spark, seed, m, k):
    hourly = counts(spark, seed)
    day = F.substr("hour", F.lit(1), F.lit(10))
    exact = hourly.groupBy(day.alias("day"), "keyword").agg(F.sum("count").alias("count"))
    true = {(r["day"], r["keyword"]): r["count"] for r in exact.collect()}
    merged = summaries.merged(summaries.summarized(hourly, "hour", m), "hour", "day", day, m)
    for r in merged.collect():
        assert r["low"] <= true[(r["day"], r["keyword"])] <= r["high"]
    kept = {(r["day"], r["keyword"]) for r in merged.collect()}
    bound = {r["day"]: r["bound"] for r in merged.collect()}
    assert all(n <= bound[d] for (d, w), n in true.items() if (d, w) not in kept)
    found = summaries.top(merged, "day", k).collect()
    held = {(r["day"], r["keyword"]) for r in found}
    whole = {r["day"]: r["whole"] for r in found}
    best = {(r["day"], r["keyword"]) for r in top_k(exact, k, by=["day"]).collect()}
    assert all(key in held or not whole[key[0]] for key in best)
    assert all((r["day"], r["keyword"]) in best for r in found if r["settled"])
    if m == 60:
        assert all(whole.values()) and any(r["settled"] for r in found)


def test_summaries_of_summaries(spark):
    hourly = counts(spark, 7, hours=48)
    day, month = F.substr("hour", F.lit(1), F.lit(10)), F.substr("day", F.lit(1), F.lit(7))
    daily = summaries.merged(summaries.summarized(hourly, "hour", 20), "hour", "day", day, 20)
    monthly = summaries.merged(daily, "day", "month", month, 20)
    true = dict(hourly.groupBy("keyword").agg(F.sum("count")).collect())
    got = monthly.collect()
    assert len(got) == 20
    assert all(r["low"] <= true[r["keyword"]] <= r["high"] for r in got)
    names = {r["keyword"] for r in got}
    assert all(n <= got[0]["bound"] for w, n in true.items() if w not in names)
    empty = summaries.summarized(hourly.where("false"))
    assert summaries.top(summaries.merged(empty, "hour", "day", day), "day").count() == 0
