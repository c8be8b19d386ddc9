"""WARC archives: round trips, segments, framing, and pages that contain record separators."""

import base64
import gzip
import hashlib
import random

import pytest

from corpgraph.llm import warc

SCHEMA = "page_id long, url string, html string, type string"


def digest(raw):
    return base64.b32encode(hashlib.sha1(raw).digest()).decode()


def expected(rows, least=0):
    raw = [(i, (h or "").encode()) for i, _, h, _ in rows]
    out = []
    for i, b in raw:
        same = [j for j, c in raw if c == b]
        best = max((j for j in same if j is not None), default=None)
        revisit = len(same) > 1 and len(b) >= least and best is not None and i != best
        out.append((i, len(b), digest(b), "revisit" if revisit else "response", best if revisit else None))
    return sorted(out, key=str)


def result(df):
    return sorted([(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in df.collect()], key=str)


def sample():
    rng = random.Random(3)
    nested = "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc"
    rows = [(i, f"http://a.example/{i}", "".join(rng.choice("ab é\r\n") for _ in range(rng.choice([0, 3, 90, 700]))), "t") for i in range(60)]
    rows += [(100 + i, None, "same page", "t") for i in range(40)]
    rows += [(200, "http://b.example/\r\nX: y", nested * 30, "t"), (201, "u", "\r\n" * 50 + "WARC/1.", "t"), (202, "u", nested, "t"), (203, "", "0\r\n\r\n", "t")]
    rows += [(None, None, None, None), (None, "u", "x" * 900, "t"), (7, "u", "y" * 900, "t"), (7, "u", "y" * 900, "t"), (300, "u", None, "t"), (301, "u", "long " * 20_000, "t")]
    return rows


@pytest.mark.parametrize(("compression", "segment", "chunk"), [("gzip", 16384, 4096), ("none", 100, 7), ("none", 1000, 64)])
def test_round_trip(spark, tmp_path, compression, segment, chunk):
    rows = sample()
    pages = spark.createDataFrame(rows, SCHEMA).repartition(3)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")  # records cross splits
    try:
        warc.write_warc(pages, str(tmp_path / "w"), segment_bytes=segment, chunk_bytes=chunk, compression=compression)
        got = warc.read_warc(spark, str(tmp_path / "w"))
        assert result(got) == expected(rows)
        payloads = {r.page_id: bytes(r.payload).decode() for r in got.where("record_type = 'response' and page_id is not null").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert payloads[200] == rows[100][2] and payloads[301] == "long " * 20_000
    assert not [r for r in got.select("problem").distinct().collect() if r.problem]


def test_least_bytes_and_no_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "BROADCAST_BLOCKS", 0)
    rows = sample()
    warc.write_warc(spark.createDataFrame(rows, SCHEMA), str(tmp_path / "w"), least_bytes=10)
    assert result(warc.read_warc(spark, str(tmp_path / "w"), full=False)) == expected(rows, 10)


def test_text_ids_and_empty_table(spark, tmp_path):
    rows = [("a:1 %\n", "u", "p", ""), ("b", "u", "p", "")]
    warc.write_warc(spark.createDataFrame(rows, SCHEMA.replace("page_id long", "page_id string")), str(tmp_path / "w"))
    assert {(r.page_id, r.record_type, r.refers_to) for r in warc.read_warc(spark, str(tmp_path / "w"), id_type="string").collect()} == {("a:1 %\n", "revisit", "b"), ("b", "response", None)}
    warc.write_warc(spark.createDataFrame([], SCHEMA), str(tmp_path / "e"))
    assert warc.read_warc(spark, str(tmp_path / "e")).collect() == []


def record(fields, block):
    head = "".join(f"{k}: {v}\r\n" for k, v in {**fields, "Content-Length": len(block)}.items())
    return f"WARC/1.0\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def test_foreign_archives(spark, tmp_path):
    http = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n3;x=1\r\nabc\r\nA\r\n0123456789\r\n0\r\nTrailer: t\r\n\r\n"
    cut = [http[:30], http[30:50], http[50:]]
    seg = lambda origin, k, block, **more: record({"WARC-Type": "response" if k == 1 else "continuation", "WARC-Record-ID": origin if k == 1 else f"<{origin}{k}>", "WARC-Segment-Number": k, **({} if k == 1 else {"WARC-Segment-Origin-ID": origin}), **more}, block)
    total = {"WARC-Segment-Total-Length": len(http)}
    files = {
        "1.warc": record({"WARC-Type": "warcinfo"}, b"software: x") + seg("<s>", 2, cut[1]) + seg("<t>", 1, cut[0]) + seg("<v>", 1, cut[0]),
        "2.warc.gz": b"".join(gzip.compress(x) for x in (seg("<s>", 3, cut[2], **total), seg("<s>", 1, cut[0]), seg("<t>", 3, cut[2], **total), record({"WARC-Type": "response", "WARC-Record-ID": "<p>"}, b"HTTP/1.1 200 OK\r\n\r\nplain"))),
        "3.warc": seg("<v>", 2, http[30:], **{"WARC-Segment-Total-Length": 5}) + record({"WARC-Type": "response", "WARC-Record-ID": "<c>"}, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n5\r\nab"),
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    got = sorted((bytes(r.payload) if r.payload is not None else b"", r.problem or "") for r in warc.read_warc(spark, str(tmp_path)).collect())
    assert got == [(b"", "a segment is missing"), (b"", "chunk shorter than its size"), (b"", "segments don't add up to the total length"), (b"abc0123456789", ""), (b"plain", "")]


def test_any_cut_into_pieces_gives_the_same_records():
    rng = random.Random(7)
    blocks = [rng.choice([b"", b"a\r\n", b"\r\nWARC/1.1\r\nContent-Length: 9\r\n\r\nx", b"\n" * 9]) * rng.randint(0, 5) for _ in range(40)]
    data = b"".join(record({"WARC-Type": "response"}, b) for b in blocks)
    pieces = data.removeprefix(b"WARC/1.").split(warc._NEXT)
    for _ in range(20):
        cuts, reader, got = [0, *sorted(rng.sample(range(1, len(pieces)), 10)), len(pieces)], warc._Pieces(), []
        for a, b in zip(cuts, cuts[1:], strict=False):
            got += [block for _, block in reader.add(warc._NEXT.join(pieces[a:b]))]
        assert got == blocks and not reader.held


def test_binary_payloads(spark, tmp_path):
    raw = bytes(range(256)) * 10
    pages = spark.createDataFrame([(1, "u", bytearray(raw))], "page_id long, url string, html binary")
    warc.write_warc(pages, str(tmp_path / "w"), segment_bytes=333)
    assert bytes(warc.read_warc(spark, str(tmp_path / "w")).first().payload) == raw
