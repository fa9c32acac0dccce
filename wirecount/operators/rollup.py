"""Hourly counts to days, daily counts to months."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType

from wirecount.functions import times
from wirecount.operators.keywords import TOP, keyword_counts, top_k, top_keywords
from wirecount.operators.lookup import lookup_join
from wirecount.session import shared_dir

#: Text of one label that a task counts alone, and text that a task gets of smaller labels.
LABEL_BYTES, TASK_BYTES = 64 << 20, 2 << 20
#: Groups of keywords whose sums say which of them a top can be in.
BUCKETS = 1 << 15

FINER = {"day": "hour", "month": "day"}
HOUR, DAY = timedelta(hours=1), timedelta(days=1)


def label_range(counts: DataFrame, column: str, low: str | None, high: str | None) -> DataFrame:
    """Rows with ``low <= label < high``, compared as text; prunes label partitions."""
    if low is not None:
        counts = counts.where(F.col(column) >= low)
    if high is not None:
        counts = counts.where(F.col(column) < high)
    return counts


def keywords_per(headlines: DataFrame, unit: str = "hour", k: int | None = TOP,
                 ts: str = "published", label_at: str = "start", **text) -> DataFrame:
    """``(label, keyword, count)`` straight from headlines, the top ``k`` of each label.

    Exact for any unit: nothing is cut before it is counted. ``text`` goes to
    ``keyword_counts``.
    """
    timed = headlines.where(F.col(ts).isNotNull()).withColumn("_period", F.date_trunc(unit, ts))
    if k is None:
        # Labels are made once a title: there are nearly as many different n-grams as n-grams.
        named = timed.withColumn("_label", times.label(F.col("_period"), unit, label_at))
        return _counted(named, **text).select(F.col("_label").alias(unit), "keyword", "count")
    return _labelled(top_keywords(timed, k, ["_period"], **text), unit, None, label_at)


def _counted(named: DataFrame, title: str = "title", label_bytes: int = LABEL_BYTES,
             task_bytes: int = TASK_BYTES, least: int = 0, tasks: int | None = None,
             **text) -> DataFrame:
    """``keyword_counts`` by ``_label``, in the order of labels where that can be.

    Titles are smaller than their counts, so they are shuffled: every label goes to one task, which
    counts it as a whole and has few others to hold beside it. Labels measured at more than
    ``label_bytes`` of titles are counted by all tasks, as everything is whose rows would not stay
    where they are, and as all is where no ``least`` labels are left to be dealt. ``tasks`` spreads
    titles that are counted by all tasks.
    """
    plain = dict(title=title, by=["_label"], **text)

    def spread(titles):
        return keyword_counts(titles.repartition(tasks) if tasks else titles, **plain)

    if not _dealt_by_label(named, title, **text):
        return spread(named)
    shared_dir(named.sparkSession)
    sizes = named.groupBy("_label").agg(
        F.coalesce(F.sum(F.octet_length(title)), F.lit(0)).alias("_bytes")).checkpoint()
    large = F.col("_bytes") > label_bytes
    found = sizes.agg(F.count_if(large).alias("large"), F.count_if(~large).alias("small"),
                      F.sum(F.when(~large, F.col("_bytes"))).alias("bytes")).first()

    def dealt(titles):
        parts = max(2, min(found["small"], -(-(found["bytes"] or 0) // task_bytes)))
        return keyword_counts(titles.repartitionByRange(parts, "_label"), **plain)

    needed = named.select(*dict.fromkeys(["_label", title, *text.get("row_id", ())]))
    if found["small"] < least:
        return spread(needed).hint("rebalance", "_label")
    if not found["large"]:
        return dealt(needed)
    hot = sizes.where(large).select("_label")
    counted = spread(lookup_join(needed, hot, ["_label"], "left_semi"))
    if not found["small"]:
        return counted
    return dealt(lookup_join(needed, hot, ["_label"], "left_anti")).unionByName(
        counted.hint("rebalance", "_label"))


def _dealt_by_label(named: DataFrame, title: str = "title", **text) -> bool:
    """Whether the counts of titles can stay in the task their label is in."""
    return not (named.isStreaming or isinstance(named.schema[title].dataType, ArrayType)
                or text.get("dedupe_titles") or text.get("lemmas") is not None)


def hour_counts(titles: DataFrame, tasks: int | None = None, **text) -> tuple[DataFrame, bool]:
    """``hour, keyword, count`` of titles with their ``hour``, and whether they lie by hour.

    The titles are read three times, to measure the hours, to place them and to count them; where
    there are fewer hours than tasks all tasks count all.
    """
    least = tasks or titles.sparkSession.sparkContext.defaultParallelism
    counts = _counted(titles.withColumnRenamed("hour", "_label"), least=least, tasks=tasks, **text)
    return counts.withColumnRenamed("_label", "hour"), _dealt_by_label(titles, **text)


def roll_up(counts: DataFrame, unit: str, k: int | None = TOP, label_at: str = "start",
            as_of: datetime | None = None, source: str | None = None,
            stored: bool = False) -> DataFrame:
    """Sum ``(label, keyword, count)`` of a finer unit into ``unit``.

    The input is labelled by ``source``, the next finer unit unless given: complete hourly
    counts can go into a month directly, which the daily tops cannot replace. With
    ``as_of`` only the last whole period before it is summed; without, every period in
    the input, in one plan. ``label_at`` says whether labels, read and written, name a
    period by its start or by its end. ``k=None`` keeps all keywords. Counts that are ``stored``,
    so that they can be read several times, are not all summed for a top (``top_of_sums``).
    """
    finer = source or FINER[unit]
    if as_of is not None:
        low, high = times.period_before(as_of, unit)
        if label_at == "end":
            step = HOUR if finer == "hour" else DAY
            low, high = low + step, high + step
        shape = times.PYTHON_FORMATS[finer]
        counts = label_range(counts, finer, low.strftime(shape), high.strftime(shape))
    period = F.date_trunc(unit, times.label_start(F.col(finer), finer, label_at))
    if stored and k is not None:
        # A label is read as a time once, not once for every count it has.
        shared_dir(counts.sparkSession)
        named = counts.select(finer).where(F.col(finer).isNotNull()).distinct().select(
            finer, period.alias("_period")).checkpoint()
        placed = lookup_join(counts.select(finer, "keyword", "count"), named, [finer])
        tops = top_of_sums(placed.drop(finer), k)
        return _labelled(tops, unit, None, label_at)
    return _summed(counts, period, unit, k, label_at)


def _kth(rows: DataFrame, column: str, k: int) -> DataFrame:
    """``_period, _bar``: the ``k``-th highest of a column, for periods that have as many."""
    order = Window.partitionBy("_period").orderBy(F.desc(column))
    return (
        rows.where(F.col(column).isNotNull()).withColumn("_rank", F.row_number().over(order))
        .where(F.col("_rank") <= k).where(F.col("_rank") == k)
        .select("_period", F.col(column).alias("_bar"))
    )


def top_of_sums(counts: DataFrame, k: int, buckets: int = BUCKETS) -> DataFrame:
    """``top_k`` by ``_period`` of the sums of ``_period, keyword, count``, exactly, without summing
    every keyword.

    Keywords are hashed into buckets. A bucket's highest single count is no more than the sum of
    some keyword of it, so the ``k``-th highest of these is no more than the ``k``-th sum of its
    period. Counts from there on, summed, give a closer such bar. A keyword with a sum from the bar
    on is in a bucket with a sum from the bar on: only those are summed whole. A period with fewer
    than ``k`` buckets, or with negative counts, has no bar and is summed whole. Reads the counts
    three times.
    """
    shared_dir(counts.sparkSession)
    at = F.pmod(F.xxhash64("keyword"), F.lit(buckets)).cast("int")
    rows = counts.withColumn("_at", at)
    held = rows.groupBy("_period", "_at").agg(
        F.sum("count").alias("_sum"), F.max("count").alias("_peak"),
        F.min("count").alias("_least")).checkpoint()
    negative = held.where("_least < 0").select("_period").distinct()
    first = _kth(held.join(negative, "_period", "left_anti"), "_peak", k).checkpoint()
    # The lowest bar as a number, so that the scan drops most counts; null where there is none.
    least = first.agg(F.min("_bar")).first()[0]
    heavy = lookup_join(counts.where(F.col("count") >= F.lit(least).cast("long")), first,
                        ["_period"]).where(F.col("count") >= F.col("_bar"))
    bars = _kth(heavy.groupBy("_period", "keyword").agg(F.sum("count").alias("_low")), "_low", k)
    wanted = held.join(bars, "_period", "left").where(
        F.col("_bar").isNull() | (F.col("_sum") >= F.col("_bar"))).select(
        "_period", "_at").checkpoint()
    # By bucket alone first: most rows are in none of any period.
    near = lookup_join(rows, wanted.select("_at").distinct(), ["_at"], "left_semi")
    sums = (
        lookup_join(near, wanted, ["_period", "_at"], "left_semi")
        .groupBy("_period", "keyword").agg(F.sum("count").cast("long").alias("count"))
    )
    return top_k(sums, k, by=["_period"])


def _summed(counts: DataFrame, period: Column, unit: str, k: int | None,
            label_at: str) -> DataFrame:
    # Grouped by the timestamp, a fixed-width key; the text label is made at the end.
    totals = (
        counts.groupBy(period.alias("_period"), "keyword")
        .agg(F.sum("count").cast("long").alias("count"))
    )
    return _labelled(totals, unit, k, label_at)


def _labelled(totals: DataFrame, unit: str, k: int | None, label_at: str) -> DataFrame:
    if k is not None:
        totals = top_k(totals, k, by=["_period"])
    return totals.select(
        times.label(F.col("_period"), unit, label_at).alias(unit), "keyword", "count")


def scheduled_day(hour: Column, run_time: str = "01:30:00") -> Column:
    """The day label an hour label ends up under when days are cut by text comparison.

    A run at ``run_time`` sums the labels from yesterday's run time up to today's
    midnight, both written with seconds, and files them under that midnight. A shorter
    label sorts before a longer one it begins, so ``D 00`` still belongs to the run of
    day D, and hours before the run time are in no run at all (null).
    """
    day = F.substr(hour, F.lit(1), F.lit(10))
    midnight = F.concat(day, F.lit(" 00:00:00"))
    tomorrow = F.date_format(F.date_add(day.cast("date"), 1), times.LABEL_FORMATS["day"])
    return (
        F.when(hour < midnight, midnight)
        .when(hour >= F.concat(day, F.lit(f" {run_time}")), tomorrow)
    )


def scheduled_month(day: Column) -> Column:
    """The month a day label is summed into by text comparison: the one it begins with."""
    return F.substr(day, F.lit(1), F.lit(7))


def roll_up_scheduled(counts: DataFrame, unit: str, k: int = TOP, run_time: str = "01:30:00",
                      as_of: datetime | None = None) -> DataFrame:
    """Rollup with the label arithmetic of a text-compared schedule, for parity.

    Days carry the label of the midnight that ends them; a month takes the days whose
    labels begin with it, so it starts with the day before the 1st and lacks its last.
    """
    if unit == "day":
        if as_of is not None:
            run_time = as_of.strftime("%H:%M:%S")
            midnight = as_of.strftime("%Y-%m-%d 00:00:00")
            low = (as_of - DAY).strftime(times.PYTHON_FORMATS["day"])
            counts = label_range(counts, "hour", low, midnight)
        key = scheduled_day(F.col("hour"), run_time)
    else:
        if as_of is not None:
            low, high = times.period_before(as_of, "month")
            shape = times.PYTHON_FORMATS["month"]
            counts = label_range(counts, "day", low.strftime(shape), high.strftime(shape))
        key = scheduled_month(F.col("day"))
    totals = (
        counts.withColumn(unit, key) if unit not in counts.columns else counts)
    totals = (
        totals.where(F.col(unit).isNotNull())
        .groupBy(unit, "keyword").agg(F.sum("count").cast("long").alias("count"))
    )
    return top_k(totals, k, by=[unit])
