"""What counts can still be trusted: since when they are kept, up to when final, what has gone.

The hourly and the expiry job write a row each time a bound moves; the rows are few and are read
as one aggregate. A rollup asks here before it replaces a label by less than it held.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession, functions as F

from wirecount.functions.times import utc

COVERAGE = "keyword_coverage"
BEGUN, FINAL, EXPIRED = "begun", "final", "expired"
EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)


class SourceExpired(RuntimeError):
    """The counts of a period are not there any more, or not all of them."""


@dataclass(frozen=True)
class Coverage:
    """Bounds of one source, in UTC; None where nothing is known."""

    begun: datetime | None = None    # counts are kept since
    final: datetime | None = None    # counts before do not change any more
    expired: datetime | None = None  # counts before have been dropped

    def faults(self, start: datetime, end: datetime) -> list[str]:
        """Why counts of ``[start, end)`` are not complete, apart from what has gone."""
        out = []
        if self.begun and self.begun > start:
            out.append(f"counts are kept since {self.begun} only")
        if self.final and self.final < end:
            out.append(f"counts are final up to {self.final} only")
        return out

    def require(self, source: str, start: datetime) -> None:
        if self.expired and self.expired > start:
            raise SourceExpired(f"{source} before {self.expired} has been dropped, so the period "
                                f"from {start} cannot be summed again")


def create(spark: SparkSession) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {COVERAGE} (source STRING, bound STRING, "
              "moment TIMESTAMP) USING parquet")


def read(spark: SparkSession, source: str) -> Coverage:
    moments = spark.table(COVERAGE).where(F.col("source") == source).groupBy("bound").agg(
        F.unix_micros(F.min("moment")).alias("least"),
        F.unix_micros(F.max("moment")).alias("most"))
    found = {r["bound"]: r for r in moments.collect()}

    def moment(bound: str, which: str) -> datetime | None:
        return EPOCH + timedelta(microseconds=found[bound][which]) if bound in found else None

    return Coverage(moment(BEGUN, "least"), moment(FINAL, "most"), moment(EXPIRED, "most"))


def move(spark: SparkSession, source: str, **bounds: datetime | None) -> None:
    """Note bounds that have moved on; those known already leave no row."""
    now = read(spark, source)
    rows = []
    for bound, moment in bounds.items():
        if moment is None:
            continue
        known, moment = getattr(now, bound), utc(moment)
        if known is None or (moment < known if bound == BEGUN else moment > known):
            rows.append((source, bound, (utc(moment) - EPOCH) // timedelta(microseconds=1)))
    if rows:
        (
            spark.createDataFrame(rows, "source string, bound string, micros long").coalesce(1)
            .select("source", "bound", F.timestamp_micros("micros").alias("moment"))
            .write.mode("append").insertInto(COVERAGE)
        )
