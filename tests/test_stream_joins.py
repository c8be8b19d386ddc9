"""Interval joins of streams against the table's, rows told apart as late, and a batch that runs again."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from corpgraph.streaming import joins

START = datetime(2024, 1, 1)
ROW = "n long, k string, ts timestamp"


def at(minutes):
    return START + timedelta(minutes=minutes)


def test_follow_ups_of_a_table_keep_lonely_rows_and_null_keys(spark):
    first = spark.createDataFrame([(1, "a", at(0)), (2, "a", at(100)), (3, None, at(0))], ROW)
    second = spark.createDataFrame([(7, "a", at(0)), (8, "a", at(60)), (9, "a", at(61)), (10, None, at(1))], ROW)
    got = joins.follow_ups(first, second, "k").select("n", "next_n").collect()
    assert sorted((r.n, r.next_n or 0) for r in got) == [(1, 7), (1, 8), (2, 0), (3, 0)]


def test_every_row_is_kept_once_and_late_ones_are_marked(spark, tmp_path):
    box, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))

    def run(rows):
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(box)
        joins.split_late(spark.readStream.schema(ROW).parquet(box), out, state).awaitTermination()
        return {r.n: r.is_late for r in spark.read.parquet(f"{out}/rows").collect()}

    assert run([(1, "a", at(0)), (2, "a", at(60))]) == {1: False, 2: False}
    assert run([(3, "a", at(49)), (4, "a", at(50)), (5, "a", None)])[3] is True
    got = run([(6, "a", at(49)), (7, "a", at(90))])
    assert got == {1: False, 2: False, 3: True, 4: False, 5: False, 6: True, 7: False}
    assert spark.read.parquet(f"{out}/rows").count() == 7


def test_a_batch_that_fails_between_its_writes_runs_again(spark, tmp_path, monkeypatch):
    box, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    spark.createDataFrame([(1, "a", at(0))], ROW).write.parquet(box)
    start = lambda: joins.split_late(spark.readStream.schema(ROW).parquet(box), out, state).awaitTermination()
    with monkeypatch.context() as m:
        m.setattr(F, "max", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(Exception, match="lost"):
            start()
    start()
    assert [(r.n, r.is_late) for r in spark.read.parquet(f"{out}/rows").collect()] == [(1, False)]
