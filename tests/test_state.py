"""Keyed state over several runs, and its expiry."""

from datetime import datetime, timedelta

from corpgraph.streaming import state

START = datetime(2024, 1, 1)
ROW = "k string, ts timestamp"


def test_keys_expire_and_begin_anew(spark, tmp_path):
    box, out, place = (str(tmp_path / x) for x in ("in", "out", "state"))
    day = lambda n: START + timedelta(days=n)

    def run(rows):
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(box)
        state.append(state.seen(spark.readStream.schema(ROW).parquet(box), "k", forget="5 days"), out, place).awaitTermination()
        return sorted((r.k, r.n, r.first_seen, r.last_seen) for r in spark.read.schema("k string, n long, first_seen timestamp, last_seen timestamp").parquet(out).collect())

    assert run([("a", day(0)), ("a", day(1)), ("b", day(1)), (None, day(1)), ("a", None)]) == []
    assert run([("a", day(4)), ("b", day(2))]) == []
    first = [("b", 2, day(1), day(2))]
    assert run([("c", day(8))]) == first  # past b's day 7, not a's day 9
    both = sorted([("a", 3, day(0), day(4)), *first])
    assert run([("c", day(10))]) == both
    assert run([("b", day(11)), ("d", day(40))]) == sorted([*both, ("b", 1, day(11), day(11)), ("c", 2, day(8), day(10))])
