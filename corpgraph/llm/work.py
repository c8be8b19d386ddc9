"""Intermediate tables in the folder that the whole cluster shares, and joins that survive hot keys.

Lineage is cut by writing a Parquet table below ``spark.checkpoint.dir`` and
reading it again, so a lost executor costs a few tasks and not the job.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpgraph.sources.shared import shared_folder

#: A key with more than this share of the rows is hot: there are fewer than 1 / HOT_SHARE of them, so their rows can be broadcast.
HOT_SHARE = 1 / 2000


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder in whatever file system it lies."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def clean(spark: SparkSession) -> None:
    """Removes all work tables of this application; call it when the results that read them are written."""
    delete(spark, f"{shared_folder(spark)}/corpgraph/{spark.sparkContext.applicationId}")


class WorkArea:
    """Tables of one run of an operator. ``drop`` removes those that later steps don't read; ``clean`` all."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_folder(spark)}/corpgraph/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"

    def save(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        out = f"{self.path}/{name}"
        writer = df.write.mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(out)
        return self.spark.read.schema(df.schema).parquet(out)

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, f"{self.path}/{name}")


def left_join(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str, total: int) -> DataFrame:
    """``rows`` left-joined with ``table`` on ``keys``, which are unique in ``table``; a key may hold any share of the rows.

    ``weight`` (a column of ``table``, dropped) is the number of rows that a key has.
    Keys above ``HOT_SHARE`` of ``total`` rows go by broadcast, fewer than
    1 / ``HOT_SHARE`` whatever the data; only the rows of the others are shuffled.
    """
    most = max(1, int(total * HOT_SHARE))
    hot = table.where(F.col(weight) > most).drop(weight)
    cold = table.where(F.col(weight) <= most).drop(weight)
    found = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), list(keys), "left")
    return found.where("_hot").drop("_hot").unionByName(rows.join(F.broadcast(hot.select(*keys)), list(keys), "left_anti").join(cold, list(keys), "left"))


def release() -> None:
    """Gives memory that this process has freed back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def releasing(run: Callable, **options) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run(rows, **options)`` for mapInArrow; at the task's end the worker gives freed memory back to the system.

    Python workers outlive their tasks and sit beside the executor's heap in one budget.
    """

    def task(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(rows, **options)
        finally:
            release()

    return task
