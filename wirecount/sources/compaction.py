"""Batch counts of past days merged into one set of files a day.

A day starts with a partition per stream and batch. ``compact`` sums those of days that have
ended into a partition of ``keyword_days`` and lists them, with their hours, in
``keyword_days_batches``. The list is written last and is what announces the sums: readers take the
newest listed generation of a day, and beside it only batches that it does not list. So a batch
that is sent again after its day was merged changes nothing, a new late one is added, and a run
that stops half-way leaves nothing that is read. What a run supersedes is dropped by the next one,
after its readers have ended.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from wirecount.functions.times import utc
from wirecount.operators.lookup import lookup_join
from wirecount.sources.partitions import drop, listed, replace

BATCHES, DAYS, MERGED = "keyword_batches", "keyword_days", "keyword_days_batches"
KEY = ["day", "run", "batch_id"]


def create(spark: SparkSession) -> None:
    spark.sql(f"CREATE TABLE IF NOT EXISTS {DAYS} (hour STRING, keyword STRING, count BIGINT, "
              "day DATE, generation BIGINT) USING parquet PARTITIONED BY (day, generation)")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {MERGED} (run STRING, batch_id BIGINT, "
              "hours ARRAY<STRING>, day DATE, generation BIGINT) USING parquet "
              "PARTITIONED BY (day, generation)")


def generations(spark: SparkSession) -> dict[str, int]:
    """The newest announced generation of every merged day, from the catalog alone."""
    newest: dict[str, int] = {}
    for p in listed(spark, MERGED):
        newest[p["day"]] = max(newest.get(p["day"], 0), int(p["generation"]))
    return newest


def _of_generations(rows: DataFrame, newest: dict[str, int]) -> DataFrame:
    """Rows of the given generations; a filter on partition columns."""
    name = F.concat_ws("/", F.col("day").cast("string"), F.col("generation").cast("string"))
    return rows.where(name.isin([f"{d}/{g}" for d, g in newest.items()]))


def complete(spark: SparkSession, first: date, last: date) -> DataFrame:
    """``hour, keyword, count, day`` of the days between, every batch once; other days are not
    read. An hour and keyword can come up several times."""
    within = F.col("day").between(F.lit(first), F.lit(last))
    columns = ["hour", "keyword", "count", "day"]
    rows = spark.table(BATCHES).where(within)
    newest = {d: g for d, g in generations(spark).items() if str(first) <= d <= str(last)}
    if not newest:
        return rows.select(*columns)
    merged = _of_generations(spark.table(MERGED), newest).select(*KEY)
    late = lookup_join(rows, merged, KEY, "left_anti").select(*columns)
    return _of_generations(spark.table(DAYS), newest).select(*columns).unionByName(late)


def merged_hours(spark: SparkSession, batch_id: int, run: str) -> DataFrame:
    """The hours of a batch that has been merged already."""
    return (
        spark.table(MERGED).where((F.col("run") == run) & (F.col("batch_id") == batch_id))
        .select(F.explode("hours").alias("hour"))
    )


def compact(spark: SparkSession, as_of: datetime, grace: timedelta = timedelta(hours=2),
            least: int = 2) -> list[str]:
    """Merge the batches of days that ended ``grace`` ago; returns these days.

    A day is left as it is with fewer than ``least`` batches that are not merged yet, unless it
    has been merged before. All days go in one plan.
    """
    clean(spark)
    newest = generations(spark)
    bound = (utc(as_of) - grace).strftime("%Y-%m-%d")
    waiting: dict[str, list[dict[str, str]]] = {}
    for p in listed(spark, BATCHES):
        if p["day"] < bound:
            waiting.setdefault(p["day"], []).append(p)
    waiting = {d: parts for d, parts in waiting.items() if len(parts) >= least or d in newest}
    if not waiting:
        return []
    # Exactly the batches listed now: one that arrives meanwhile waits for the next run.
    wanted = spark.createDataFrame(
        [(date.fromisoformat(p["day"]), p["run"], int(p["batch_id"]))
         for parts in waiting.values() for p in parts], "day date, run string, batch_id long")
    rows = lookup_join(
        spark.table(BATCHES).where(F.col("day").isin([date.fromisoformat(d) for d in waiting])),
        wanted, KEY, "left_semi")
    before = {d: newest[d] for d in waiting if d in newest}
    sums = rows.select("hour", "keyword", "count", "day")
    names = rows.groupBy(*KEY).agg(F.array_sort(F.collect_set("hour")).alias("hours"))
    if before:
        sums = sums.unionByName(
            _of_generations(spark.table(DAYS), before).select(*sums.columns))
        names = names.unionByName(
            _of_generations(spark.table(MERGED), before).select(*names.columns))
    next_one = F.element_at(F.create_map(*(
        x for d in waiting for x in (F.lit(d), F.lit(newest.get(d, 0) + 1)))),
        F.col("day").cast("string")).cast("long")
    sums = sums.groupBy("day", "hour", "keyword").agg(F.sum("count").alias("count"))
    replace(
        sums.withColumn("generation", next_one)
        .select("hour", "keyword", "count", "day", "generation")
        .hint("rebalance", "day").sortWithinPartitions("day", "hour", F.desc("count"), "keyword"),
        DAYS)
    replace(names.withColumn("generation", next_one)
            .select("run", "batch_id", "hours", "day", "generation").hint("rebalance", "day"),
            MERGED)
    return sorted(waiting)


def clean(spark: SparkSession) -> int:
    """Drop merged batches and superseded generations; returns how many partitions."""
    newest = generations(spark)
    if not newest:
        return 0
    known = {(str(r["day"]), r["run"], r["batch_id"]) for r in
             _of_generations(spark.table(MERGED), newest).select(*KEY).toLocalIterator()}
    done = [p for p in listed(spark, BATCHES)
            if (p["day"], p["run"], int(p["batch_id"])) in known]
    drop(spark, BATCHES, done)
    count = len(done)
    for table in (DAYS, MERGED):
        old = [p for p in listed(spark, table)
               if int(p["generation"]) < newest.get(p["day"], 0)]
        drop(spark, table, old)
        count += len(old)
    return count
