"""As-of and overlap joins against plain loops, with a hot key, ties, nulls, and empty tables."""

import random
from datetime import date, datetime, timedelta

import pytest

from corpgraph.operators.temporal import asof_join, overlap_join

DAY = datetime(2024, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("slices", [2, 7, 1024])
def test_asof_equals_a_loop(spark, slices):
    rng = random.Random(slices)
    key = lambda: rng.choice([None, "hot", "hot", "hot", "a", "b"])
    at = lambda: rng.choice([None, DAY, *[DAY + timedelta(minutes=rng.randrange(-300, 300)) for _ in range(9)]])
    left = [(i, key(), at()) for i in range(400)]
    right = [(key(), at(), rng.randrange(5), rng.choice([None, 1.5, 2.5])) for _ in range(120)]
    got = asof_join(spark.createDataFrame(left, "id long, k string, t timestamp"), spark.createDataFrame(right, "k string, t timestamp, n long, v double"), "k", "t", ["n", "v"], slices=slices)
    assert got.columns == ["id", "k", "t", "last_n", "last_v"] and "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)

    def want(k, t):
        before = [(rt, n, v is not None, v or 0.0) for rk, rt, n, v in right if k is not None and t is not None and rk == k and rt is not None and rt <= t]
        return (max(before)[1], max(before)[3] if max(before)[2] else None) if before else (None, None)

    assert sorted((r.id, r.last_n, r.last_v) for r in got.collect()) == sorted((i, *want(k, t)) for i, k, t in left)


def test_asof_with_ties_repeats_and_nothing_before(spark):
    rows = [("a", date(2024, 1, 2)), ("a", date(2024, 1, 2)), ("a", date(2023, 1, 1)), (None, date(2024, 1, 2))]
    right = [("a", date(2024, 1, 2), 9, "low"), ("a", date(2024, 1, 2), 10, "high"), ("a", date(2024, 1, 3), 11, "late")]
    left, states = spark.createDataFrame(rows, "k string, d date"), spark.createDataFrame(right, "k string, d date, n int, w string")
    got = asof_join(left, states, "k", "d", ["w"], ties=["n"]).collect()
    assert sorted((r.k or "", str(r.d), r.last_w or "") for r in got) == [("", "2024-01-02", ""), ("a", "2023-01-01", ""), ("a", "2024-01-02", "high"), ("a", "2024-01-02", "high")]
    assert [r.last_w for r in asof_join(left, states.limit(0), "k", "d", ["w"]).collect()] == [None] * 4
    assert asof_join(left.limit(0), states, "k", "d", ["w"]).count() == 0


@pytest.mark.parametrize("base", [2, 8])
def test_overlaps_equal_a_loop(spark, base):
    rng = random.Random(base)

    def spans(n):
        for i in range(n):
            s = rng.randrange(-2000, 2000)
            yield i, rng.choice([None, "hot", "hot", "a"]), rng.choice([None, s, s, s, s]), s + rng.choice([-1, 0, 1, 5, 40, 40, 40, 900, 5000])

    left, right = list(spans(300)), list(spans(200))
    schema = "id long, k string, s long, e long"
    got = overlap_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), "k", ("s", "e"), ("s", "e"), base=base)
    assert got.columns == ["id", "k", "s", "e", "right_id", "right_s", "right_e"] and "NestedLoop" not in plan(got) and "Cartesian" not in plan(got)
    good = lambda rows: [r for r in rows if None not in r and r[2] <= r[3]]
    want = sorted((a[0], b[0]) for a in good(left) for b in good(right) if a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3])
    assert sorted((r.id, r.right_id) for r in got.collect()) == want


def test_overlaps_of_empty_tables_and_points(spark):
    schema = "id long, k string, s date, e date"
    point = spark.createDataFrame([(1, "a", date(2024, 1, 1), date(2024, 1, 1))] * 2, schema)
    assert overlap_join(point, point, "k", ("s", "e"), ("s", "e")).count() == 4
    assert overlap_join(point, point.limit(0), "k", ("s", "e"), ("s", "e")).count() == 0
    assert overlap_join(point.limit(0), point.limit(0), "k", ("s", "e"), ("s", "e")).count() == 0


def test_keys_with_few_rows_meet_without_buckets(spark):
    rows = lambda n, m: spark.range(n).selectExpr(f"id % {m} AS k", "id AS i", "id * 7 % 1000 AS s", "id * 7 % 1000 + id % 90 AS e")
    a, b = rows(400, 9).where("k < 8 or i < 50"), rows(700, 9)
    pairs = lambda few: sorted(map(tuple, overlap_join(a, b, "k", ("s", "e"), ("s", "e"), few=few).select("i", "right_i").collect()))
    assert pairs(0) == pairs(20) == pairs(1000) and len(pairs(0)) > 1000
    plan = overlap_join(a, b, "k", ("s", "e"), ("s", "e"))._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan
