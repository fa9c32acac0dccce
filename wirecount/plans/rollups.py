"""Daily job: yesterday's keywords, and last month's on the first of a month."""

from __future__ import annotations

import warnings
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from wirecount.functions import times
from wirecount.operators.keywords import TOP
from wirecount.operators.rollup import label_range, roll_up, roll_up_scheduled
from wirecount.sources import compaction, coverage, tables


def check_source(spark: SparkSession, source: str, start: datetime, end: datetime) -> None:
    """Refuse a period of which counts have been dropped; warn of one that is not whole."""
    kept = coverage.read(spark, source)
    kept.require(source, times.utc(start))
    for fault in kept.faults(times.utc(start), times.utc(end)):
        warnings.warn(f"rollup of {start} to {end}: {fault}", stacklevel=3)


def run_rollups(spark: SparkSession, as_of: datetime, k: int = TOP, label_at: str = "start",
                exact: bool = True, scheduled: bool = False) -> list[str]:
    """Write the day before ``as_of``, and the month before it on the 1st.

    The complete counts of every batch are summed. ``exact=False`` sums the hourly and
    daily tops instead, as a job does that keeps nothing else, so a keyword that is never
    quite in a top is lost. ``scheduled``, which is of that kind too, reproduces the label
    arithmetic of text-compared schedules. Each label written is replaced, so a rerun
    corrects it. A period whose source has been dropped since is refused
    (``coverage.SourceExpired``), one that is not whole or not final gives a warning. Returns the
    tables written.
    """
    exact = exact and not scheduled
    as_of = times.utc(as_of)
    units = ["day", "month"] if as_of.day == 1 else ["day"]
    for unit in units:
        start, end = times.period_before(as_of, unit)
        check_source(spark, _source(unit, exact), start, end)
        if exact:
            counts = tables.batch_counts(spark, start, end + timedelta(hours=1))
            rows = roll_up(counts, unit, k, label_at, as_of, source="hour", stored=True)
        else:
            counts = spark.table(_source(unit, exact))
            rows = (roll_up_scheduled(counts, unit, k, as_of=as_of) if scheduled
                    else roll_up(counts, unit, k, label_at, as_of))
        named_by = end if label_at == "end" or (scheduled and unit == "day") else start
        _replace(rows, f"keywords_{unit}", named_by.strftime(times.PYTHON_FORMATS[unit]))
    return [f"keywords_{u}" for u in units]


def _source(unit: str, exact: bool) -> str:
    return tables.BATCH_COUNTS if exact else "keywords_hour" if unit == "day" else "keywords_day"


def _replace(rows: DataFrame, table: str, label: str) -> None:
    """Write a label's top; a label that has lost all its rows goes."""
    rows = rows.persist()
    try:
        if rows.isEmpty():
            tables.delete_label(rows.sparkSession, table, label)
        else:
            tables.overwrite_labels(rows, table)
    finally:
        rows.unpersist()


def backfill(spark: SparkSession, unit: str, start: datetime, end: datetime, k: int = TOP,
             label_at: str = "start", exact: bool = True) -> None:
    """Every whole day or month inside ``[start, end)``, in one plan.

    Only what lies wholly in the range is written. A range that begins before what has been
    dropped is refused, one that counts do not cover gives a warning.
    """
    first, last = times.whole_periods(start, end, unit)
    if first >= last:
        return
    check_source(spark, _source(unit, exact), first, last)
    source = tables.batch_counts(spark, first, last) if exact else spark.table(
        _source(unit, exact))
    found = "hour" if exact or unit == "day" else "day"
    low, high = (t.strftime(times.PYTHON_FORMATS[found]) for t in (first, last))
    rows = label_range(source, found, low, high)
    tables.overwrite_labels(
        roll_up(rows, unit, k, label_at, source=found, stored=exact), f"keywords_{unit}")


def expire(spark: SparkSession, as_of: datetime,
           keep_batches: timedelta = timedelta(days=62)) -> None:
    """Drop hourly tops past their time, and batch counts no exact rollup needs any more; merge
    the batches of days that have ended."""
    tables.expire(spark, "keywords_hour", as_of, tables.HOUR_TTL)
    tables.expire_batches(spark, as_of, keep_batches)
    compaction.compact(spark, as_of)
