"""The folder that the whole cluster shares."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Where that is unset: on one machine a folder of our own, on a cluster an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines share (master: {master})")
        root = tempfile.mkdtemp(prefix="corpgraph-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _place(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def mark(spark: SparkSession, path: str) -> None:
    """Makes an empty file, with its folders, in whatever file system it lies; it is there whole or not at all."""
    fs, p = _place(spark, path)
    fs.create(p, True).close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none where it doesn't exist."""
    fs, p = _place(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []
