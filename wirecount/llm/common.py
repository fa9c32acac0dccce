"""What the operators of this folder share."""

from __future__ import annotations

import tempfile
import weakref
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from wirecount.session import scratch_dir

#: Rows and bytes of one Arrow batch, so that a worker holds a bounded amount of text at a time.
#: Both are read when a plan runs, so they stay set in the session.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "256",
         "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20)}


def text_of(column: str | Column) -> Column:
    """A text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


class Memory(dict):
    """What a worker remembers while it works on a task: bounded in bytes, then forgotten.

    Workers outlive their tasks and serve other stages, so nothing is kept for later.
    """

    all: list[weakref.ref] = []

    def __init__(self):
        super().__init__()
        self.spent = 0
        Memory.all.append(weakref.ref(self))

    def spend(self, entries: int, payload: int) -> None:
        """Count new entries and the bytes they hold, with what a dictionary adds to each."""
        self.spent += payload + 200 * entries

    def clear(self) -> None:
        super().clear()
        self.spent = 0

    @staticmethod
    def forget() -> None:
        for known in Memory.all:
            if (memory := known()) is not None:
                memory.clear()
        pa.default_memory_pool().release_unused()


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` over batches bounded in rows and bytes; memories end with the task."""
    prepare_workers(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            Memory.forget()

    return df.mapInArrow(run, schema)


def prepare_workers(spark: SparkSession) -> None:
    """Bound the batches that Python workers get, and send them this package, once a context."""
    for name, value in BATCH.items():
        spark.conf.set(name, value)
    context = spark.sparkContext
    if getattr(context, "_wirecount_sent", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="wirecount-")) / "wirecount.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted(package.rglob("*.py")):
            z.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._wirecount_sent = True


def free_name(df: DataFrame, name: str) -> str:
    """``name``, longer by underscores if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def stored(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends there."""
    folder = f"{scratch_dir(df.sparkSession)}/rows"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
