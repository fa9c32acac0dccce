"""Heavy hitters per period with error bounds, between all counts and tops alone.

A summary holds the ``m`` highest counts of a period as counters, and the bound: no keyword without
a counter has a higher count. Summaries are merged by adding counters. A keyword that has no counter
in some of them may have up to their bounds more, so every merged counter is a range, ``low`` to
``high``, and the merged bound is the sum of the bounds. Cutting a merged summary to ``m`` counters
raises its bound to the highest ``high`` that went.

A top taken from merged summaries is every keyword that may be in the true one, and says whether
a keyword without a counter may be in it too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from wirecount.operators.keywords import TOP

COUNTERS = 1000


def _ranked(rows: DataFrame, period: str, column: str) -> DataFrame:
    order = Window.partitionBy(period).orderBy(F.desc(column), F.asc("keyword"))
    return rows.withColumn("_rank", F.row_number().over(order))


def _cut(rows: DataFrame, period: str, m: int) -> DataFrame:
    """The ``m`` counters with the highest ``high``, and what no other one exceeds.

    Only ``m + 1`` rows a period are passed on by any task; the last one leaves its bound.
    """
    ranked = _ranked(rows, period, "high").where(F.col("_rank") <= m + 1)
    over = F.max(F.when(F.col("_rank") > m, F.col("high"))).over(Window.partitionBy(period))
    return (
        ranked.withColumn("bound", F.greatest(F.coalesce(over, F.lit(0)), "bound").cast("long"))
        .where(F.col("_rank") <= m).drop("_rank")
    )


def summarized(counts: DataFrame, period: str = "hour", m: int = COUNTERS) -> DataFrame:
    """``period, keyword, low, high, bound`` from complete counts of every period."""
    return _cut(counts.select(
        period, "keyword", F.col("count").alias("low"), F.col("count").alias("high"),
        F.lit(0).cast("long").alias("bound")), period, m)


def merged(summaries: DataFrame, period: str, into: str, label, m: int | None = COUNTERS) \
        -> DataFrame:
    """Summaries of ``period`` put together by ``label``, a column named ``into``."""
    rows = summaries.withColumn(into, label)
    bounds = (
        rows.groupBy(into, period).agg(F.max("bound").alias("bound"))
        .groupBy(into).agg(F.sum("bound").cast("long").alias("bound"))
    )
    added = rows.groupBy(into, "keyword").agg(
        F.sum("low").cast("long").alias("low"),
        F.sum(F.col("high") - F.col("bound")).cast("long").alias("_over"))
    # A period without a counter of the keyword may hold up to that period's bound of it.
    out = added.join(bounds, into).select(
        into, "keyword", "low", (F.col("_over") + F.col("bound")).alias("high"), "bound")
    return out if m is None else _cut(out, into, m)


def top(summaries: DataFrame, period: str, k: int = TOP) -> DataFrame:
    """Every keyword that may be among the ``k`` highest of its period.

    ``settled``: it certainly is; ``whole``: no keyword without a counter can be among them.
    """
    least = (
        _ranked(summaries, period, "low").where(F.col("_rank") <= k)
        .groupBy(period).agg(F.min("low").alias("_least"), F.count("*").alias("_n"))
    )
    # With fewer counters than k everything that has one may be in.
    bar = F.when(F.col("_n") == k, F.col("_least")).otherwise(F.lit(0))
    may = summaries.join(least, period).where(F.col("high") >= bar).withColumn(
        "whole", (F.col("bound") < bar) | (F.col("bound") == 0))
    rivals = Window.partitionBy(period)
    return may.withColumn("_may", F.count("*").over(rivals)).select(
        period, "keyword", "low", "high",
        ((F.col("_may") <= k) & F.col("whole")).alias("settled"), "whole")
