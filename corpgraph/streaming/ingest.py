"""Incremental mail ingestion: messages in, decoded text out, each file once."""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator
from email.utils import parsedate_to_datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, StringType, StructField, StructType, TimestampType

from corpgraph.schemas import MESSAGES, strings
from corpgraph.sources.shared import mark, names_in

PAYLOAD_HEADERS = "struct<headers array<struct<name string, value string>>>"


def _decode(data: str | None) -> str:
    raw = (data or "").encode()
    return base64.urlsafe_b64decode(raw + b"=" * (-len(raw) % 4)).decode("utf-8", "replace")


def plain_text(payload: str | None) -> str:
    """The first text/plain part in depth-first order, else the root's own body."""

    def walk(part: dict):
        if part.get("mimeType") == "text/plain" and (part.get("body") or {}).get("data"):
            yield part["body"]["data"]
        for child in part.get("parts") or []:
            yield from walk(child)

    root = json.loads(payload) if payload else {}
    return _decode(next(walk(root), (root.get("body") or {}).get("data")))


@F.pandas_udf(strings("body error"))
def message_text(payloads: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Body of each message; what goes wrong is a value, not a failed task."""
    for batch in payloads:
        rows = []
        for p in batch:
            try:
                rows.append((plain_text(p), None))
            except Exception as e:  # noqa: BLE001
                rows.append((None, f"{type(e).__name__}: {e}"))
        yield pd.DataFrame(rows, columns=["body", "error"])


@F.pandas_udf(TimestampType())
def header_date(dates: pd.Series) -> pd.Series:
    """RFC-2822 dates; null if they can't be read."""

    def one(x):
        try:
            return parsedate_to_datetime(x)
        except (TypeError, ValueError):
            return None

    return pd.to_datetime(dates.map(one), utc=True).dt.tz_localize(None)


def header(payload: Column, name: str) -> Column:
    """Value of the first header of a name, whatever its case; empty if there is none."""
    headers = F.from_json(payload, PAYLOAD_HEADERS)["headers"]
    return F.coalesce(F.get(F.filter(headers, lambda h: F.lower(h["name"]) == name.lower()), F.lit(0))["value"], F.lit(""))


def decoded(messages: DataFrame) -> DataFrame:
    """message_id, date, subject, body, error."""
    m = messages.withColumn("t", message_text("payload_json")).withColumn("d", header_date(header(F.col("payload_json"), "date")))
    date = F.coalesce("d", F.timestamp_millis(F.col("internal_date_ms").try_cast("long")))
    return m.select("message_id", date.alias("date"), header(F.col("payload_json"), "subject").alias("subject"), F.col("t.body").alias("body"), F.col("t.error").alias("error"))


def unseen(messages: DataFrame, seen: DataFrame, key: str = "message_id") -> DataFrame:
    """Messages whose id was not processed before."""
    return messages.join(seen.select(key).distinct(), key, "left_anti")


def ingest(spark: SparkSession, source: str, out: str, checkpoint: str, *, files_per_batch: int = 100) -> StreamingQuery:
    """Reads new JSON files below ``source``, writes decoded messages to ``out`` exactly once, and stops."""
    stream = spark.readStream.schema(MESSAGES).option("maxFilesPerTrigger", files_per_batch).json(source)
    return decoded(stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Buckets of the seen ids; a batch reads those that its own ids fall in.
ID_BUCKETS = 64


def _reached(step: str) -> None:
    """Called between the writes of a batch."""


def append_batch(batch: DataFrame, name: str, out: str, log: str, key: str) -> None:
    """Writes the rows with new ids as batch ``name`` of ``out``, their ids to ``log``, then commits both.

    A batch lies in folders of its own, which a repetition overwrites, and counts
    once the commit is there; a committed batch isn't written again.
    """
    spark = batch.sparkSession
    commits = names_in(spark, f"{out}/_commits")
    if name in commits:
        return
    bucket = F.pmod(F.xxhash64(key), F.lit(ID_BUCKETS)).cast("int")
    batch = batch.dropDuplicates([key])
    new, done = batch, [c for c in commits if f"batch={c}" in set(names_in(spark, log))]
    if done:
        needed = [r.bucket for r in batch.select(bucket.alias("bucket")).distinct().collect()]
        schema = StructType([batch.schema[key], StructField("batch", StringType()), StructField("bucket", IntegerType())])
        seen = spark.read.schema(schema).parquet(log).where(F.col("bucket").isin(needed) & F.col("batch").isin(done))
        new = unseen(batch, seen.select(key), key)
    new.write.mode("overwrite").parquet(f"{out}/batch={name}")
    _reached("rows")
    written = spark.read.schema(batch.schema).parquet(f"{out}/batch={name}")
    written.select(key, bucket.alias("bucket")).write.mode("overwrite").partitionBy("bucket").parquet(f"{log}/batch={name}")
    _reached("ids")
    mark(spark, f"{out}/_commits/{name}")
    _reached("commit")


def committed(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """Rows of all committed batches of ``out``."""
    done = names_in(spark, f"{out}/_commits")
    return spark.read.schema(schema).parquet(*[f"{out}/batch={c}" for c in done]) if done else spark.createDataFrame([], schema)


def append_batches(stream: DataFrame, out: str, log: str, checkpoint: str, *, key: str = "message_id") -> StreamingQuery:
    """Appends each micro-batch to ``out`` exactly once, leaves out ids that were there before, and stops; read it by ``committed``.

    A batch is named by the stream's checkpoint and its number. Where the job ends between
    any two writes, the batch that runs again overwrites its own rows and ids, which
    don't count before the commit. A new checkpoint over the same messages appends nothing.
    Rows with a null id are kept once a batch.
    """

    def write(batch: DataFrame, number: int) -> None:
        run = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        append_batch(batch, f"{run}-{number:09d}", out, log, key)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def sliding_counts(events: DataFrame, *, time: str = "ts", key: str = "event_type", size: str = "1 hour", slide: str = "15 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts in windows that start every ``slide``."""
    return events.withWatermark(time, late).groupBy(F.window(time, size, slide).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")


def session_counts(events: DataFrame, *, time: str = "ts", key: str = "user_id", gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions of each key, ended by a gap: start, end, n."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), key, "n")


def windowed_counts(events: DataFrame, *, time: str = "ts", key: str = "event_type", size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Tumbling-window counts with a watermark, for streams and tables alike."""
    return events.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), key, "n")
