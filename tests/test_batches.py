"""Batches that crash between any two writes and run again, and names settled in rounds."""

import random

import pytest

from corpgraph.functions.similarity import token_set_ratio
from corpgraph.plans import brands
from corpgraph.schemas import strings
from corpgraph.streaming import ingest

SCHEMA = strings("message_id body")


@pytest.mark.parametrize("crash", ["rows", "ids", "commit"])
def test_a_crash_between_any_two_writes_leaves_each_id_once(spark, tmp_path, monkeypatch, crash):
    base = str(tmp_path)

    def run(checkpoint="state"):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(f"{base}/in")
        ingest.append_batches(stream, f"{base}/out", f"{base}/log", f"{base}/{checkpoint}").awaitTermination()

    def put(ids):
        spark.createDataFrame([(i, f"body {i}") for i in ids], SCHEMA).coalesce(1).write.mode("append").json(f"{base}/in")

    put(["a", "b", "b"])
    run()
    put(["b", "c", "d"])
    failed = []

    def stop(step):
        if step == crash and not failed:
            failed.append(step)
            raise RuntimeError("crash")

    monkeypatch.setattr(ingest, "_reached", stop)
    with pytest.raises(Exception, match="crash"):
        run()
    assert sorted(r.message_id for r in ingest.committed(spark, f"{base}/out", SCHEMA).collect()) == (["a", "b", "c", "d"] if crash == "commit" else ["a", "b"])
    run()
    put(["e", "a"])
    run()
    rows = ingest.committed(spark, f"{base}/out", SCHEMA).collect()
    assert sorted(map(tuple, rows)) == [(i, f"body {i}") for i in "abcde"]
    run("another")  # all files again under a new checkpoint
    assert ingest.committed(spark, f"{base}/out", SCHEMA).count() == 5


def test_nothing_committed_is_an_empty_table(spark, tmp_path):
    assert ingest.committed(spark, str(tmp_path / "none"), SCHEMA).collect() == []


@pytest.mark.parametrize("seed", [1, 2])
def test_names_in_rounds_equal_the_fold(spark, seed):
    rng = random.Random(seed)
    words = ["Acme", "ACME", "Foods", "Food", "Foodss", "Globex", "Globexx", "Globexxx", "Inc", "Holi", "Hooli", "Umbrella"]
    pool = [" ".join(rng.choices(words, k=rng.randint(1, 3))) for _ in range(60)] + [f"chain {'x' * i}{'y' * (14 - i)}" for i in range(15)]
    rows = [(f"m{i:03}", 0, rng.choice(pool), i) for i in range(150)]
    want = []
    for *_, brand, _ in sorted(rows, key=lambda r: r[3]):
        if not any(brand.lower() == n.lower() or token_set_ratio(brand, n) >= 90 for n in want):
            want.append(brand)
    found = spark.createDataFrame(rows, "message_id string, position int, brand_clean string, date long")
    assert sorted(r.name for r in brands.canonical_names(found).collect()) == sorted(want)
