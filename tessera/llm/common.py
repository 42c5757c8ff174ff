"""Helpers shared by the training-data operators."""
from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import ship

#: Rows, and bytes, per Arrow batch for operators that hand whole texts to Python; keeps a worker's memory small.
ARROW_ROWS, ARROW_BYTES = 512, 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read a table of the data folder with Spark's own reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = ARROW_ROWS) -> None:
    """Bound the rows and bytes of an Arrow batch for the plans built from here on."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def give_back() -> None:
    """Hand a worker's free memory to the system: workers live on after a task, beside those of other executors' tasks."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function for mapInArrow that gives memory back when its task ends."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share; one of our own only where the session names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-checkpoint-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared folder, so that a lost executor loses nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Lets Spark remove the shuffle files of a write when the write ends.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Tables:
    """Tables in the shared folder that cut the lineage: smaller than checkpoints, and their shuffle files go at once."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder, self.made = spark, f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}", 0

    def written(self, df: DataFrame) -> DataFrame:
        """The same rows, read from a new table."""
        self.made += 1
        path, before = f"{self.folder}/{self.made}", self.spark.conf.get(_CLEAN, "false")
        self.spark.conf.set(_CLEAN, "true")
        try:
            df.write.option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(_CLEAN, before)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self, *tables: DataFrame) -> None:
        """Delete written tables that no plan reads any more."""
        for t in tables:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(t.inputFiles()[0].rsplit("/", 1)[0]) if t.inputFiles() else None
            if path is not None:
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def utf8(text: str | Column) -> Column:
    """A text's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def fresh(taken: list[str], name: str) -> str:
    """A column name that does not clash with those of the input, letter case aside."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name = "_" + name
    return name
