"""Queries over events as streams of files; results are appended to files."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpgraph.catalog.base import ORACLES, folder, query, t
from corpgraph.streaming import ingest, joins, state

_NTZ = "timestamp_ntz"


def _in(spark, d):
    return t(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def _appended(spark, d, name, change):
    """What ``change`` of all events appends, when a last event, of user -1 and two days after all, has let every window and bound pass."""
    base, e = folder(spark, name), _in(spark, d)
    last = e.agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"))
    rest = [F.lit(None).cast(f.dataType).alias(f.name) for f in e.schema if f.name not in ("ts", "event_type", "user_id")]
    for part in (e, last.select("ts", F.lit(-1).cast(e.schema["user_id"].dataType).alias("user_id"), F.explode(F.array(F.lit("signup"), F.lit("purchase"))).alias("event_type"), *rest)):
        part.select(*e.columns).write.mode("append").parquet(f"{base}/in")
        stream = lambda: spark.readStream.schema(e.schema).parquet(f"{base}/in")
        run = change(stream).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{base}/state")
        run.trigger(availableNow=True).start(f"{base}/out").awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def stream_tumbling_counts(spark, d):
    out = _appended(spark, d, "tumbling", lambda s: ingest.windowed_counts(s()))
    return out.withColumn("start", F.col("start").cast(_NTZ))


@query(ORACLES["sliding_counts"])
def stream_sliding_counts(spark, d):
    out = _appended(spark, d, "sliding", lambda s: ingest.sliding_counts(s()))
    return out.withColumn("start", F.col("start").cast(_NTZ))


@query(ORACLES["session_counts"])
def stream_session_counts(spark, d):
    out = _appended(spark, d, "session", lambda s: ingest.session_counts(s()))
    return out.where("user_id <> -1").withColumns({c: F.col(c).cast(_NTZ) for c in ("start", "end")})


@query("""WITH s AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'signup'), p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')
SELECT s.event_id, p.event_id AS next_event_id FROM s LEFT JOIN p ON s.user_id = p.user_id AND p.ts BETWEEN s.ts AND s.ts + INTERVAL '6 hours'""")
def stream_follow_ups(spark, d):
    """Every signup with its user's purchases within six hours, and signups without any: two streams joined."""
    pick = lambda s, kind: s().where(F.col("event_type") == kind).select("event_id", "user_id", "ts")
    out = _appended(spark, d, "follow", lambda s: joins.follow_ups(pick(s, "signup"), pick(s, "purchase"), "user_id", within="6 hours"))
    return out.where("event_id is not null").select("event_id", "next_event_id")


@query("""SELECT event_id, event_type, event_id % 2 = 1 AND ts < (SELECT max(ts) - INTERVAL '10 days' FROM events WHERE event_id % 2 = 0) AS is_late FROM events""")
def stream_late_rows(spark, d):
    """All events, the odd ones a batch after the even ones: those more than ten days behind the first batch's latest are told apart, none is lost."""
    base, e = folder(spark, "late"), _in(spark, d)
    for odd in range(2):
        e.where(F.col("event_id") % 2 == odd).write.mode("append").parquet(f"{base}/in")
        joins.split_late(spark.readStream.schema(e.schema).parquet(f"{base}/in"), f"{base}/out", f"{base}/state", late="10 days").awaitTermination()
    return spark.read.parquet(f"{base}/out/rows").select("event_id", "event_type", "is_late")


@query("SELECT user_id, CAST(count(*) AS BIGINT) AS n, min(ts) AS first_seen, max(ts) AS last_seen FROM events GROUP BY 1")
def stream_seen(spark, d):
    """How often, first and last each user was seen, kept over two runs with half of the events each, and given when a third run's event, a year later, lets the state expire."""
    base, e = folder(spark, "seen"), _in(spark, d)
    last = e.agg((F.max("ts") + F.expr("INTERVAL 365 DAYS")).alias("ts")).select(F.lit(-1).cast("long").alias("user_id"), "ts")
    rows = e.select("user_id", "ts")
    for part in (rows.where(e["event_id"] % 2 == 0), rows.where(e["event_id"] % 2 == 1), last):
        part.write.mode("append").parquet(f"{base}/in")
        seen = state.seen(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), "user_id", forget="200 days", late="60 days")
        state.append(seen, f"{base}/out", f"{base}/state").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("user_id", "n", *[F.col(c).cast(_NTZ).alias(c) for c in ("first_seen", "last_seen")])
