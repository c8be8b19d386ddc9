"""State of each key in a stream, with expiry."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Count, first and last time in microseconds.
_SEEN = "n long, first_at long, last_at long"


class Seen(StatefulProcessor):
    """Count, first and last time of a key. A timer at the last time plus ``forget`` gives the row and clears the state."""

    def __init__(self, key: str, forget_ms: int):
        self.key, self.forget_ms = key, forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.seen = handle, handle.getValueState("seen", _SEEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, first, last = self.seen.get() if self.seen.exists() else (0, None, None)
        before = last
        for part in rows:
            low, high = int(part["at"].min()), int(part["at"].max())
            n, first, last = n + len(part), low if first is None else min(first, low), high if last is None else max(last, high)
        self.seen.update((n, first, last))
        if before != last:
            if before is not None:
                self.handle.deleteTimer(self._due(before))
            self.handle.registerTimer(self._due(last))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        n, first, last = self.seen.get()
        self.seen.clear()
        yield pd.DataFrame({self.key: [key[0]], "n": [n], "first_at": [first], "last_at": [last]})

    def close(self) -> None:
        pass

    def _due(self, last: int) -> int:
        return last // 1000 + self.forget_ms


def _milliseconds(df: DataFrame, interval: str) -> int:
    row = df.sparkSession.range(1).select(F.expr(f"unix_millis(timestamp'1970-01-01 00:00:00Z' + INTERVAL '{interval}')").alias("ms"))
    return row.first()["ms"]


def seen(stream: DataFrame, key: str, *, time: str = "ts", forget: str = "30 days", late: str = "10 minutes") -> DataFrame:
    """key, n, first_seen, last_seen of each key, once the watermark is ``forget`` past its last time; a key that comes again begins anew.

    Rows with a null key or time are left out, and rows behind the watermark are dropped (``joins.split_late`` keeps them).
    A key's rows of a batch pass one task, a part at a time; its state is three numbers.
    """
    known = stream.where(F.col(key).isNotNull() & F.col(time).isNotNull()).withWatermark(time, late).select(key, time, F.unix_micros(F.col(time)).alias("at"))
    kind = known.schema[key].dataType.simpleString()
    out = known.groupBy(key).transformWithStateInPandas(Seen(key, _milliseconds(stream, forget)), outputStructType=f"`{key}` {kind}, {_SEEN}", outputMode="Append", timeMode="EventTime")
    return out.select(key, "n", F.timestamp_micros("first_at").alias("first_seen"), F.timestamp_micros("last_at").alias("last_seen"))


def append(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends what the stream gives to files, with its state in RocksDB, which keyed state needs; the session's own setting stays."""
    conf = rows.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKS)
    try:
        return rows.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
    finally:
        conf.unset(_PROVIDER) if before is None else conf.set(_PROVIDER, before)
