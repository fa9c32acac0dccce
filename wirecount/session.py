"""Session settings and the shared folder every job relies on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # Labels, windows and epoch conversions are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is split at run time, even where that costs one more shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Writing a label replaces that label and leaves the others alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Dedup and window state lives off the heap and is checkpointed as a changelog.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Keys are texts and windows that repeat one another; a checkpoint keeps the codec it began with.
    "spark.sql.streaming.stateStore.compression.codec": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
}

#: Bytes of files that a task reads at most: its n-grams take many times that, and nearly all differ,
#: so that the counts of a task with more do not stay in memory.
READ = "spark.sql.files.maxPartitionBytes"
READ_BYTES = 16 << 20

#: For folders of many small files: what it counts to open one, so how many a task gets beside its
#: bytes, and the tasks that list folders at most.
SMALL_FILES = {"spark.sql.files.openCostInBytes": 64 << 10,
               "spark.sql.sources.parallelPartitionDiscovery.parallelism": 256}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the engine's settings to a running session; one that reads less a task stays so."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    if size(spark.conf.get(READ)) > READ_BYTES:
        spark.conf.set(READ, str(READ_BYTES))
    return spark


def create(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Build a session; ``master`` is normally left to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def size_shuffles(spark: SparkSession, input_bytes: int, per_task: int = 128 << 20) -> int:
    """Start shuffles with enough partitions for ``input_bytes``.

    Partitions that turn out small are merged at run time; too few to begin with cannot
    be split again by an aggregation and spill instead.
    """
    partitions = max(spark.sparkContext.defaultParallelism, -(-input_bytes // per_task))
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


@contextmanager
def small_files(spark: SparkSession) -> Iterator[None]:
    """What is read within deals small files to tasks by the hundred, and folders to be listed too.

    As the engine is set, a task opens four files and every folder is a task of its own, which takes
    longer than what is in them.
    """
    before = {name: spark.conf.get(name, None) for name in SMALL_FILES}
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    for name, most in SMALL_FILES.items():
        if before[name] is None or size(before[name]) > most:
            spark.conf.set(name, str(most))
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local session without the setting gets a folder of its own; a cluster
    without it is refused, since a machine-local folder dies with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="wirecount-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under the shared one, deleted when the application ends."""
    folder = f"{shared_dir(spark)}/run-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(place)
    system.deleteOnExit(place)
    return folder


def input_bytes(spark: SparkSession, *paths: str) -> int:
    """Bytes of files below ``paths``, as their file systems state them."""
    total = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = place.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in system.globStatus(place) or []:
            total += system.getContentSummary(found.getPath()).getLength()
    return total
