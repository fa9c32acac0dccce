"""Metric figures that can be merged: per hour once, then per day and month from the hours alone.

A set's members are an HLL sketch, a timing's quantiles a KLL sketch; counts, sums and extremes
are kept as they are. A merged row is what a row over all samples would be, within the sketches'
error, so months need neither samples nor a second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

#: Size of the sketches: about 0.8 % (one standard error) of a set's members, and 1 % of the rank
#: of a quantile.
HLL_SIZE, KLL_SIZE = 14, 400


def sketched(samples: DataFrame, by: Sequence[str] = ("name",), ts: str = "ts",
             unit: str = "hour") -> DataFrame:
    """One row per period and ``by`` columns: ``period, n, total, shortest, longest, unread`` and
    the sketches ``members`` and ``spread``. Values that are no numbers count as ``unread`` and
    are in ``members`` only; a sample without a time is left out."""
    number = F.col("value").try_cast("double")
    return (
        samples.where(F.col(ts).isNotNull())
        .groupBy(F.date_trunc(unit, ts).alias("period"), *by).agg(
            F.count("*").alias("n"), F.sum(number).alias("total"),
            F.min(number).alias("shortest"), F.max(number).alias("longest"),
            F.count_if(F.col("value").isNotNull() & number.isNull()).alias("unread"),
            F.hll_sketch_agg("value", HLL_SIZE).alias("members"),
            F.kll_sketch_agg_double(number, KLL_SIZE).alias("spread"))
    )


def merged(rows: DataFrame, unit: str, by: Sequence[str] = ("name",)) -> DataFrame:
    """Rows of ``sketched``, or of an earlier merge, put together into longer periods."""
    return rows.groupBy(F.date_trunc(unit, "period").alias("period"), *by).agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"),
        F.min("shortest").alias("shortest"), F.max("longest").alias("longest"),
        F.sum("unread").alias("unread"), F.hll_union_agg("members").alias("members"),
        F.kll_merge_agg_double("spread").alias("spread"))


def figures(rows: DataFrame, quantiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """The sketches read off: ``members`` estimated, and a column such as ``p95`` per quantile.

    A quantile of no numbers is null.
    """
    numbers = F.col("longest").isNotNull()
    return rows.select(
        *(c for c in rows.columns if c not in ("members", "spread")),
        F.hll_sketch_estimate("members").alias("members"),
        *(F.when(numbers, F.kll_sketch_get_quantile_double("spread", F.lit(float(q))))
          .alias(f"p{100 * q:g}") for q in quantiles))
