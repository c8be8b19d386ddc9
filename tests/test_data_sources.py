"""The mailbox source and the store writer: parallel reading, offsets, commits, attempts that die, and aborts."""

import json

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from corpgraph.sources import mailbox


def page(path, number, ids):
    box = mailbox.FolderMailbox(str(path))
    box.write((json.dumps({"id": i, "internalDate": "1", "payload": {"n": i}}) for i in ids), f"page={number}", "part.json")


def test_mailbox_as_a_table_is_read_in_ranges(spark, tmp_path):
    mailbox.register(spark)
    for n in range(5):
        page(tmp_path, n, [f"m{n}a", f"m{n}b"])
    box = spark.read.format("mailbox").option("path", str(tmp_path)).option("pagesATask", "2").load()
    assert box.rdd.getNumPartitions() == 3
    assert sorted((r.page, r.message_id, json.loads(r.payload_json)["n"]) for r in box.collect()) == sorted((n, f"m{n}{x}", f"m{n}{x}") for n in range(5) for x in "ab")
    assert spark.read.format("mailbox").option("path", str(tmp_path / "none")).load().count() == 0


def test_mailbox_stream_goes_on_from_its_offset(spark, tmp_path):
    mailbox.register(spark)
    box, out, state = (str(tmp_path / x) for x in ("box", "out", "state"))

    def run():
        q = spark.readStream.format("mailbox").option("path", box).load().writeStream.format("parquet").option("checkpointLocation", state).start(out)
        q.processAllAvailable()
        q.stop()
        return sorted(r.message_id for r in spark.read.schema("message_id string").parquet(out).collect())

    page(box, 0, ["a", "b"])
    assert run() == ["a", "b"]
    assert run() == ["a", "b"]
    page(box, 1, ["c"])
    page(box, 2, [])
    assert run() == ["a", "b", "c"]


def test_store_shows_last_commit_of_a_path(spark, tmp_path):
    mailbox.register(spark)
    put = lambda rows: spark.createDataFrame(rows, "path string, json string").repartition(3).write.format("documentstore").mode("append").option("path", str(tmp_path)).save()
    assert mailbox.stored(spark, str(tmp_path)).count() == 0
    put([("x", '{"v": 1}'), ("y", '{"v": 1}')])
    put([("y", '{"v": 2}'), ("z", "two\nlines")])
    put([("x", '{"v": 1}')])
    assert {r.path: r.json for r in mailbox.stored(spark, str(tmp_path)).collect()} == {"x": '{"v": 1}', "y": '{"v": 2}', "z": "two\nlines"}


def test_attempts_that_die_and_jobs_that_fail_show_nothing(spark, tmp_path):
    mailbox.register(spark)
    path = str(tmp_path)
    writer = mailbox.StoreWriter({"path": path, "folder_client": "FolderStore"})
    rows = [Row(path="x", json="1"), Row(path="y", json="2")]

    def dies():
        yield rows[0]
        raise OSError("lost")

    with pytest.raises(OSError):
        writer.write(dies())
    writer.write(iter(rows))  # an attempt whose answer got lost
    assert mailbox.stored(spark, path).count() == 0
    writer.commit([writer.write(iter(rows))])
    assert sorted((r.path, r.json) for r in mailbox.stored(spark, path).collect()) == [("x", "1"), ("y", "2")]
    held = writer.write(iter([Row(path="z", json="3")]))
    writer.abort([held, None])
    writer.abort([held])
    bad = spark.range(0, 40, 1, 4).select(F.concat(F.lit("p"), "id").alias("path"), F.when(F.col("id") < 39, "ok").otherwise(F.raise_error(F.lit("no"))).alias("json"))
    with pytest.raises(Exception, match="no"):
        bad.write.format("documentstore").mode("append").option("path", path).save()
    assert sorted(r.path for r in mailbox.stored(spark, path).collect()) == ["x", "y"]


def test_a_mailbox_page_is_one_file(spark, tmp_path):
    from corpgraph.catalog.temporal import _mail

    docs = tmp_path / "in" / "documents.parquet"
    spark.range(900).selectExpr("id AS doc_id", "5 AS n_chars", "'hello' AS text").repartition(6).write.parquet(str(docs))
    for rest in range(2):
        _mail(spark, str(tmp_path / "in"), str(tmp_path / "box"), rest)
    files = [len(list(p.glob("part-*"))) for p in (tmp_path / "box").glob("page=*")]
    assert len(files) > 6 and max(files) == 1
