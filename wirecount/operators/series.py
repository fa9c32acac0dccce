"""Time-series reads for dashboards."""

from __future__ import annotations

import re
from collections.abc import Sequence
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from wirecount.functions.times import instant, utc
from wirecount.operators.lookup import lookup_join

# Placeholders a dashboard puts into its queries.
MACROS = {
    "$__timeFrom": ":timeFrom",
    "$__timeTo": ":timeTo",
    "$__unixEpochFrom": ":unixEpochFrom",
    "$__unixEpochTo": ":unixEpochTo",
}
# Units of date buckets.
BUCKET_UNITS = ("day", "week", "month", "quarter", "year")


def _literal(bound: datetime, epoch: str | None):
    if epoch is None:
        return instant(bound)
    millis = round(utc(bound).timestamp() * 1000)
    return F.lit(millis if epoch == "ms" else millis / 1000)


def time_range(df: DataFrame, time_col: str, start: datetime, end: datetime,
               epoch: str | None = None) -> DataFrame:
    """Rows strictly inside ``(start, end)``; ``epoch`` is ``ms`` or ``s`` for long times.

    Bounds are converted, never the column, so they reach the scan.
    """
    return df.where((F.col(time_col) > _literal(start, epoch))
                    & (F.col(time_col) < _literal(end, epoch)))


def series_range(df: DataFrame, id_col: str, time_col: str, value_col: str, start: datetime,
                 end: datetime, ids: Sequence | DataFrame | None = None,
                 extra: Sequence[str] = (), epoch: str | None = None) -> DataFrame:
    """``id, value, time`` and ``extra`` columns of the chosen series in a time range.

    ``ids`` is a list, or a one-column frame when there are too many to list.
    """
    rows = time_range(df, time_col, start, end, epoch).select(id_col, value_col, time_col, *extra)
    if ids is None:
        return rows
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).alias(id_col)).distinct()
        return lookup_join(rows, wanted, [id_col], "left_semi", spread_by=[time_col])
    return rows.where(F.col(id_col).isin(list(ids)))


def bucket_range(df: DataFrame, bucket_col: str, time_col: str, start: datetime,
                 end: datetime, unit: str = "day") -> DataFrame:
    """``time_range`` on data kept in buckets named by the date a ``unit`` begins with, in UTC:
    only the buckets touched are read."""
    if unit not in BUCKET_UNITS:
        raise ValueError(f"unit must be one of {BUCKET_UNITS}")
    first, last = (F.trunc(F.lit(utc(bound).date()), unit) if unit != "day"
                   else F.lit(utc(bound).date()) for bound in (start, end))
    return time_range(df, time_col, start, end).where(F.col(bucket_col).between(first, last))


def latest_by(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row with the greatest ``order`` per key.

    An aggregate rather than a window: each task passes on one row per key, so a key
    with most of the rows is no heavier than the others.
    """
    rest = [c for c in df.columns if c not in key]
    return (
        df.groupBy(*key)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
        .select(*key, "_row.*")
        .select(*df.columns)
    )


def latest_per_series(df: DataFrame, id_col: str, time_col: str,
                      tie: Sequence[str] = ()) -> DataFrame:
    """The most recent point of every series."""
    return latest_by(df, [id_col], [time_col, *tie])


def newest_points(df: DataFrame, time_col: str, n: int = 1,
                  tie: Sequence[str] = ()) -> DataFrame:
    """The ``n`` most recent points overall; equal times go by the greater ``tie``."""
    return df.orderBy(F.desc(time_col), *(F.desc(c) for c in tie)).limit(n)


def wide(df: DataFrame, id_col: str, time_col: str, value_col: str, ids: Sequence,
         of_several: Callable[[str], Column] = F.max) -> DataFrame:
    """One column per series, one row per time. The series are listed, never discovered.

    ``of_several`` says what stands for several points of a series at one time.
    """
    chosen = df.where(F.col(id_col).isin(list(ids)))
    return chosen.groupBy(time_col).pivot(id_col, list(ids)).agg(of_several(value_col))


def with_labels(df: DataFrame, time_col: str, value_col: str,
                labels: Sequence[str]) -> DataFrame:
    """``time, value, labels``: the other columns become a label map, one series each."""
    pairs = [x for c in sorted(labels) for x in (F.lit(c), F.col(c).cast("string"))]
    return df.select(time_col, value_col, F.create_map(*pairs).alias("labels"))


def with_alias(df: DataFrame, template: str, name: str = "alias") -> DataFrame:
    """Fill ``{{ column }}`` places of ``template`` from each row; unknown ones stay."""
    parts = []
    for i, piece in enumerate(re.split(r"\{\{\s*(\w+)\s*\}\}", template)):
        known = i % 2 and piece in df.columns
        if known:
            parts.append(F.coalesce(F.col(piece).cast("string"), F.lit("")))
        elif i % 2:
            parts.append(F.lit("{{ " + piece + " }}"))
        elif piece:
            parts.append(F.lit(piece))
    return df.withColumn(name, F.concat(*parts) if parts else F.lit(""))


def panel_args(start: datetime, end: datetime) -> dict:
    """Arguments of a parameterised query for a panel's time range."""
    return {
        "timeFrom": utc(start), "timeTo": utc(end),
        "unixEpochFrom": int(utc(start).timestamp()),
        "unixEpochTo": int(utc(end).timestamp()),
    }


def panel_sql(spark: SparkSession, query: str, start: datetime, end: datetime,
              **args) -> DataFrame:
    """Run a Spark SQL panel query; its time placeholders become query parameters."""
    for macro, parameter in MACROS.items():
        query = query.replace(macro, parameter)
    given = {**panel_args(start, end), **args}
    used = {n: v for n, v in given.items() if re.search(rf":{n}\b", query)}
    return spark.sql(query, args=used)


def variable_values(df: DataFrame, column: str) -> DataFrame:
    """The pick list of a dashboard variable."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
