"""Identifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from wirecount.session import shared_dir

def message_id(*parts: Column) -> Column:
    """Same parts, same id: an entry sent again after a failure is recognised.

    Every part goes in with its length, a null one as a dash, so no two lists of parts
    make one text.
    """
    def told(part: Column) -> Column:
        text = part.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    return F.sha2(F.concat(*map(told, parts)), 256)


def number_rows(df: DataFrame, order: list[str], name: str, start: int = 0) -> DataFrame:
    """Dense numbers ``start+1, start+2, ...`` in ``order``, without a one-task sort.

    Rows are range-partitioned and sorted in place, each partition is counted, and a
    row's number is its partition's offset plus its place inside. The sorted rows go to
    the shared folder first: numbers and counts must come from the same partitioning,
    also after an executor is lost.
    """
    spark = df.sparkSession
    shared_dir(spark)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .checkpoint()
    )
    # The upper bits of the id are the partition, the lower 33 the place inside it.
    part = F.shiftright("_at", 33)
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition, whatever the number of rows.
    counts = sorted((r["part"], r["n"]) for r in
                    placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect())
    offsets, running = [], start
    for number, n in counts:
        offsets.append((number, running))
        running += n
    lookup = spark.createDataFrame(offsets, "_part long, _offset long")
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(lookup), "_part")
        .withColumn(name, F.col("_offset") + place + 1)
        .drop("_at", "_part", "_offset")
    )
