"""Versioned snapshots of small state: the channel list and the channels' marks.

A version is written first and announced after it is complete, so readers never see half
of one. Each has one writer: channels are added by the list job, marks are moved by ingest.

Announcements stand in segments of ``SEGMENT`` versions, one file each. The newest version is looked
for in the newest segment. When a segment begins, all but the ``KEPT`` before it go, with the
versions that they announced: however many runs there were, a read opens a bounded number of
files, and a run that is repeated finds its version as long as it is one of the last
``KEPT * SEGMENT``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from wirecount.operators.registry import registry_faults
from wirecount.schemas import REGISTRY

CHANNELS, MARKS, PARSED = "channels", "marks", "parsed"

ANNOUNCED = "version LONG, run STRING"
#: Versions announced in one folder, and the folders kept before the newest.
SEGMENT, KEPT = 100, 2


def _numbers(spark: SparkSession, folder: str) -> list[int]:
    """Names of the numbered folders below one, from its listing."""
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(place):
        return []
    names = [found.getPath().getName() for found in system.listStatus(place)]
    return sorted(int(n) for n in names if n.isdigit())


def _announced(spark: SparkSession, path: str, segments: list[int]) -> DataFrame | None:
    if not segments:
        return None
    return spark.read.schema(ANNOUNCED).parquet(*(f"{path}/announced/{s}" for s in segments))


def _trim(spark: SparkSession, path: str, version: int) -> None:
    """At the start of a segment, remove what is too old to be asked for.

    The data go first: an announcement without data is older than any that is read.
    """
    oldest = version // SEGMENT - KEPT
    if version % SEGMENT or oldest <= 0:
        return
    configuration = spark._jsc.hadoopConfiguration()
    for folder, bound in ((f"{path}/data", oldest * SEGMENT), (f"{path}/announced", oldest)):
        for number in _numbers(spark, folder):
            if number < bound:
                place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{number}")
                place.getFileSystem(configuration).delete(place, True)


def latest(spark: SparkSession, path: str, at_most: int | None = None) -> int | None:
    """The newest announced version, or the newest not above ``at_most``."""
    segments = _numbers(spark, f"{path}/announced")
    if at_most is not None:
        segments = [s for s in segments if s <= at_most // SEGMENT]
    # A segment that has nothing up to ``at_most`` sends the search to the one before.
    for segment in reversed(segments):
        rows = _announced(spark, path, [segment])
        if at_most is not None:
            rows = rows.where(F.col("version") <= at_most)
        found = rows.agg(F.max("version").alias("v")).first()["v"]
        if found is not None:
            return found
    return None


def version_of(spark: SparkSession, path: str, run: str) -> int | None:
    """The version that a run has announced, if it has, among those kept."""
    announced = _announced(spark, path, _numbers(spark, f"{path}/announced"))
    if announced is None:
        return None
    return announced.where(F.col("run") == run).agg(F.max("version").alias("v")).first()["v"]


def publish(df: DataFrame, path: str, version: int, run: str | None = None) -> None:
    """Write and announce a version. Doing it again replaces it with the same rows."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}/data/{version}")
    (
        spark.range(version, version + 1, 1, 1)
        .select(F.col("id").alias("version"), F.lit(run).cast("string").alias("run"))
        .write.mode("append").parquet(f"{path}/announced/{version // SEGMENT}")
    )
    _trim(spark, path, version)


def read(spark: SparkSession, path: str, at_most: int | None = None) -> DataFrame | None:
    """The newest announced version, or the newest not above ``at_most``."""
    version = latest(spark, path, at_most)
    return None if version is None else spark.read.parquet(f"{path}/data/{version}")


def load_registry(spark: SparkSession, root: str, marks_at_most: int | None = None) -> DataFrame:
    """Channels with their current marks."""
    channels = read(spark, f"{root}/{CHANNELS}")
    if channels is None:
        return spark.createDataFrame([], REGISTRY)
    marks = read(spark, f"{root}/{MARKS}", marks_at_most)
    if marks is None:
        return channels
    moved = marks.select("id", F.col("last_updated").alias("_mark"))
    return (
        channels.join(moved, "id", "left")
        .withColumn("last_updated", F.coalesce("_mark", "last_updated"))
        .select(*REGISTRY.fieldNames())
    )


def publish_channels(registry: DataFrame, root: str, strict: bool = True) -> int:
    """Announce a new channel list; ``strict`` refuses missing or repeated values."""
    spark = registry.sparkSession
    path = f"{root}/{CHANNELS}"
    newest = latest(spark, path)
    version = 0 if newest is None else newest + 1
    if strict:
        fault = registry_faults(registry).first()
        if fault is not None:
            raise ValueError(f"channel list refused: {fault.asDict()}")
    publish(registry, path, version)
    return version


def reset_channels(spark: SparkSession, root: str) -> int:
    """Start over with no channels."""
    return publish_channels(spark.createDataFrame([], REGISTRY), root)
