"""Streams joined within a bound of time, and rows that come later than the watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpgraph.sources.shared import names_in


def follow_ups(first: DataFrame, second: DataFrame, key: str, *, time: str = "ts", within: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Each first row with the second rows of its key from its time on until ``within`` after it; first rows without any are kept, with nulls.

    For tables and streams alike. A stream gives a row without follow-up when both watermarks have
    passed its bound, and forgets what can't be joined any more; second rows with a null key can't,
    and don't move their watermark. Columns of the second get ``next_``.
    """
    a = first.withWatermark(time, late)
    b = second.withWatermark(time, late).withColumnsRenamed({c: f"next_{c}" for c in second.columns})
    bound = (F.col(f"next_{time}") >= F.col(time)) & (F.col(f"next_{time}") <= F.col(time) + F.expr(f"INTERVAL '{within}'"))
    return a.join(b, (F.col(key) == F.col(f"next_{key}")) & bound, "left")


def split_late(stream: DataFrame, out: str, checkpoint: str, *, time: str = "ts", late: str = "10 minutes") -> StreamingQuery:
    """Writes all rows below ``out``/rows with ``is_late``: whether they are more than ``late`` behind the latest time of earlier batches.

    So every row that a watermark would drop in silence is in a table. A batch overwrites its own
    folders when it is run again; the latest time of all batches so far lies beside it, one row a batch.
    Rows without a time are never late.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, name = batch.sparkSession, f"batch={number:09d}"
        earlier = [n for n in names_in(spark, f"{out}/reached") if n < name]
        reached = lambda n: spark.read.schema("at timestamp").parquet(f"{out}/reached/{n}")
        before = reached(earlier[-1]).first()["at"] if earlier else None
        behind = F.col(time) < F.lit(before).cast("timestamp") - F.expr(f"INTERVAL '{late}'")
        batch.withColumn("is_late", F.coalesce(behind, F.lit(False))).write.mode("overwrite").parquet(f"{out}/rows/{name}")
        now = spark.read.schema(batch.schema).parquet(f"{out}/rows/{name}").select(F.col(time).cast("timestamp").alias("at"))
        (now.unionByName(reached(earlier[-1])) if earlier else now).agg(F.max("at").alias("at")).write.mode("overwrite").parquet(f"{out}/reached/{name}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
