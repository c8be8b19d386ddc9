"""WARC archives: written by Spark's text writer, read in splits, with segment reassembly and chunked framing.

A record ends with two line ends, which are the text writer's line separator, so a
task's file is a WARC file (gzip makes it one stream a file). The reader takes the
record end and the opening of the next record as its separator, so large plain files are
read by many tasks at once. Where a payload contains that separator, the record's
length tells, and the pieces are joined again; a file in which such a record crosses
a split is read again whole.

Blocks longer than a segment are split over a first record and continuation records.
These are grouped by their origin's identifier, wherever they lie, ordered by segment number,
and their total length is verified before the HTTP message is decoded.
"""

from __future__ import annotations

import base64
import hashlib
import urllib.parse
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpgraph.llm import bloom
from corpgraph.llm.work import WorkArea, left_join, releasing

#: Bytes of a record's block beyond which it is segmented, and of a chunk of the transfer framing.
SEGMENT_BYTES, CHUNK_BYTES = 16_384, 4_096
#: Blocks of the filter of repeated payloads (40 bytes a row) up to which it is broadcast.
BROADCAST_BLOCKS = 200_000
#: The reader's separator: the end of the line ends after a record, and the opening of the next. No part of it is its own beginning.
_NEXT = b"\nWARC/1."
_DATE = "1970-01-01T00:00:00Z"
_VISIBLE = "".join(map(chr, range(33, 127))).replace("%", "") + " "


def _digest(hex_: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_)).decode()


def _record_id(page: str | None, digest: str) -> str:
    return f"<{uuid.uuid5(uuid.NAMESPACE_URL, f'{page}:{digest}').urn}>"


def _uri(url: str) -> str:
    return "".join(urllib.parse.quote(c) if c < "!" or c == "\x7f" else c for c in url)


def chunked(body: bytes, size: int) -> bytes:
    """The body in chunks of ``size`` bytes, as in a chunked HTTP transfer."""
    return b"".join(b"%x\r\n%b\r\n" % (len(c), c) for c in (body[i : i + size] for i in range(0, len(body), size))) + b"0\r\n\r\n"


def unchunked(framed: bytes) -> bytes:
    """The body of a chunked transfer; extensions and trailers are passed over. ValueError where the framing is broken."""
    out, at = [], 0
    while True:
        end = framed.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk without size line")
        size = int(framed[at:end].partition(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if framed[at + size : at + size + 2] != b"\r\n" or size < 0:
            raise ValueError("chunk shorter than its size")
        out.append(framed[at : at + size])
        at += size + 2


def _record(kind: str, record_id: str, block: bytes, more: list[tuple[str, object]]) -> bytes:
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", _DATE), *more, ("Content-Length", len(block))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None).encode() + b"\r\n" + block


def _records(rows: Iterator[pa.RecordBatch], segment: int, chunk: int) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for at in range(0, batch.num_rows, 256):
            out = []
            for page, url, body, sha1, refers, revisit in zip(*[batch.slice(at, 256).column(c).to_pylist() for c in ("page", "url", "body", "sha1", "refers", "revisit")], strict=True):
                digest = _digest(sha1)
                name = lambda x: None if x is None else urllib.parse.quote(x, safe=_VISIBLE)
                fields = [("WARC-Target-URI", None if url is None else _uri(url)), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Page-ID", name(page))]
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if revisit:
                    fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"), ("WARC-Refers-To", _record_id(refers, digest)), ("Refers-To-Page-ID", name(refers))]
                    out.append(_record("revisit", _record_id(page, digest), f"{head}Content-Length: {len(body)}\r\n\r\n".encode(), [*fields, ("Content-Type", "application/http; msgtype=response")]))
                    continue
                block = f"{head}Transfer-Encoding: chunked\r\n\r\n".encode() + chunked(body, chunk)
                first = _record_id(page, digest)
                fields.append(("Content-Type", "application/http; msgtype=response"))
                if len(block) <= segment:
                    out.append(_record("response", first, block, fields))
                    continue
                parts = [block[i : i + segment] for i in range(0, len(block), segment)]
                out.append(_record("response", first, parts[0], [*fields, ("WARC-Segment-Number", 1)]))
                for k, part in enumerate(parts[1:], 2):
                    last = len(block) if k == len(parts) else None
                    out.append(_record("continuation", _record_id(f"{page}#{k}", digest), part, [("WARC-Segment-Origin-ID", first), ("WARC-Segment-Number", k), ("WARC-Segment-Total-Length", last)]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["record"])


def write_warc(pages: DataFrame, out: str, *, id_col: str = "page_id", url_col: str = "url", body_col: str = "html", least_bytes: int = 0, segment_bytes: int = SEGMENT_BYTES, chunk_bytes: int = CHUNK_BYTES, compression: str = "gzip") -> None:
    """Writes a response or revisit record for each row of ``pages`` to the folder ``out``.

    Of rows with equal payloads of ``least_bytes`` or more, those with the largest id are
    responses and the others revisit them (a null id is the smallest; rows that repeat
    both id and payload are alike). The payload is the body in UTF-8 (binary bodies as they
    are), null bodies are empty. Blocks beyond ``segment_bytes`` are segmented. Urls may
    be null; control characters and spaces in them are percent-encoded. Other columns are
    not read; an empty table gives an archive without records.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(body_col).cast("binary"), F.lit(b"")).alias("body"))
    rows = rows.withColumn("key", F.unhex(F.sha2("body", 256)))
    area = WorkArea(pages.sparkSession, "warc")
    # Keys and ids alone are grouped; of payloads that occur once nothing is shuffled further.
    same = rows.where(F.octet_length("body") >= least_bytes).groupBy("key").agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1")
    same = area.save(same, "same")
    sums = same.agg(F.count("*").alias("keys"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")).first()
    blocks = bloom.block_count(sums["keys"])
    once = lambda df: df.withColumn("keep", F.lit(None).cast(rows.schema["id"].dataType))
    if sums["keys"] == 0:
        judged = once(rows)
    elif blocks <= BROADCAST_BLOCKS:
        bits = area.save(bloom.build(same, "key", blocks), "filter")
        marked = rows.withColumn("block", bloom.block_of(F.col("key"), blocks)).join(F.broadcast(bits), "block", "left").withColumn("maybe", F.coalesce(bloom.passes(F.col("key")), F.lit(False))).drop("block", *bloom.WORDS)
        hits = left_join(marked.where("maybe").drop("maybe"), same, ["key"], "n", sums["rows"])
        judged = once(marked.where("not maybe").drop("maybe")).unionByName(hits)
    else:
        judged = left_join(rows, same, ["key"], "n", sums["rows"])
    revisit = F.col("keep").isNotNull() & ~F.col("id").eqNullSafe(F.col("keep"))
    judged = judged.select(F.col("id").cast("string").alias("page"), "url", "body", F.sha1("body").alias("sha1"), F.col("keep").cast("string").alias("refers"), revisit.alias("revisit"))
    made = judged.mapInArrow(releasing(_records, segment=segment_bytes, chunk=chunk_bytes), "record binary")
    made.select(F.col("record").cast("string").alias("value")).write.mode("overwrite").option("lineSep", "\r\n\r\n").option("compression", compression).text(out)


PARSED = "file string, open boolean, type string, record_id string, origin string, segment int, total long, page string, uri string, refers string, digest string, block binary, payload binary, payload_bytes long, payload_digest string, problem string"


def _message(block: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields (names in lower case) and body of an HTTP message or a WARC record."""
    head, _, body = block.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}, body


def decoded(kind: str, block: bytes, digest: str | None) -> dict[str, object]:
    """payload, payload_bytes, payload_digest, problem of a whole block; a revisit's are those that its header names."""
    try:
        fields, body = _message(block)
        if kind == "revisit":
            return {"payload": None, "payload_bytes": int(fields["content-length"]) if "content-length" in fields else None, "payload_digest": digest, "problem": None}
        if "chunked" in fields.get("transfer-encoding", "").lower():
            body = unchunked(body)
        found = base64.b32encode(hashlib.sha1(body).digest()).decode()
        return {"payload": body, "payload_bytes": len(body), "payload_digest": found, "problem": "payload differs from its digest" if digest not in (None, found) else None}
    except ValueError as e:
        return {"payload": None, "payload_bytes": None, "payload_digest": digest, "problem": str(e)}


class _Pieces:
    """Records out of pieces in order, each piece being what follows ``WARC/1.``; ValueError where that can't be a record."""

    def __init__(self):
        self.held, self.size, self.need = [], 0, None

    def add(self, piece: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
        if not self.held and not piece.strip():
            return
        self.size += len(piece) + (len(_NEXT) if self.held else 0)
        self.held.append(piece)
        while self.held:
            if self.need is None or self.size >= self.need:
                data = _NEXT.join(self.held)
                head = data.find(b"\r\n\r\n")
                if head < 0 and len(data) > 1 << 20:
                    raise ValueError("no header")
                if head >= 0:
                    fields, rest = _message(data[:head] + b"\r\n\r\n")[0], head + 4
                    length = int(fields.get("content-length", "0"))
                    if length < 0:
                        raise ValueError("negative length")
                    self.need = rest + length
                self.held = [data]
            if self.need is None or self.size < self.need:
                return
            block, more = data[rest : self.need], data[self.need :]
            self.held, self.size, self.need = [], 0, None
            yield fields, block
            if more.strip(b"\r\n"):
                gap, found, more = more.partition(_NEXT)
                if not found or gap.strip(b"\r\n"):
                    raise ValueError("no record after a record")
                self.held, self.size = [more], len(more)


def _row(file: str, fields: dict[str, str], block: bytes, full: bool) -> dict[str, object]:
    name = lambda k: urllib.parse.unquote(fields[k]) if k in fields else None
    digest = fields.get("warc-payload-digest", "").rpartition(":")[2] or None
    kind, number = fields.get("warc-type", ""), fields.get("warc-segment-number")
    out = {"file": file, "open": False, "type": kind, "record_id": fields.get("warc-record-id"), "page": name("page-id"), "uri": fields.get("warc-target-uri"), "refers": name("refers-to-page-id"), "digest": digest}
    if number is not None:
        total = fields.get("warc-segment-total-length")
        return out | {"origin": fields.get("warc-segment-origin-id") or out["record_id"], "segment": int(number), "total": None if total is None else int(total), "block": block}
    got = decoded(kind, block, digest)
    return out | got | {"payload": got["payload"] if full else None}


def _parse(rows: Iterator[pa.RecordBatch], full: bool) -> Iterator[pa.RecordBatch]:
    """Records of text pieces, which come in order within a split."""
    schema = pa.schema([(n, {"string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}[t]) for n, t in (c.split() for c in PARSED.split(", "))])
    pieces, where = _Pieces(), None
    out: list[dict] = []
    for batch in rows:
        for file, start, piece in zip(batch.column("file").to_pylist(), batch.column("start").to_pylist(), batch.column("value"), strict=True):
            piece = piece.as_py()
            if where != (file, start):
                if pieces.held:
                    out.append({"file": where[0], "open": True})
                pieces, where = _Pieces(), (file, start)
                piece = piece.removeprefix(b"WARC/1.") if start == 0 else piece
            try:
                for fields, block in pieces.add(piece):
                    if fields.get("warc-type") in ("response", "resource", "revisit", "continuation"):
                        out.append(_row(file, fields, block, full))
            except ValueError:  # no record: the split opens within a payload
                out.append({"file": file, "open": True})
                pieces = _Pieces()
            if len(out) >= 256:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
    if pieces.held:
        out.append({"file": where[0], "open": True})
    yield pa.RecordBatch.from_pylist(out, schema=schema)


def _whole(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole files as pieces, in order."""
    for batch in rows:
        for file, content in zip(batch.column("file").to_pylist(), batch.column("content"), strict=True):
            pieces = content.as_py().split(_NEXT)
            for at in range(0, len(pieces), 256):
                part = pieces[at : at + 256]
                yield pa.RecordBatch.from_arrays([pa.array([file] * len(part)), pa.array([0] * len(part), pa.int64()), pa.array([p if at or i else p.removeprefix(b"WARC/1.") for i, p in enumerate(part)], pa.binary())], ["file", "start", "value"])


def reassembled(segments: list[tuple[int, int | None, bytes]]) -> tuple[bytes | None, str | None, int]:
    """The block of a record's segments (number, total length, block), or the problem, and how often the record was written.

    A record written more than once has every segment as often.
    """
    by_number: dict[int, list] = {}
    for s in segments:
        by_number.setdefault(s[0], []).append(s)
    copies = len(by_number.get(1, []))
    if sorted(by_number) != list(range(1, len(by_number) + 1)):
        return None, "a segment is missing", max(copies, 1)
    if any(len(same) != copies or any(s[2] != same[0][2] for s in same) for same in by_number.values()):
        return None, "segments of one number differ", max(copies, 1)
    block = b"".join(by_number[k][0][2] for k in sorted(by_number))
    total = by_number[len(by_number)][0][1]
    if total != len(block):
        return None, "segments don't add up to the total length", copies
    return block, None, copies


def _reassemble(rows: Iterator[pa.RecordBatch], full: bool) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for i in range(batch.num_rows):
            one = batch.slice(i, 1).to_pylist()[0]
            block, problem, copies = reassembled([(s["segment"], s["total"], s["block"]) for s in one.pop("segments")])
            got = {"payload": None, "payload_bytes": None, "payload_digest": one["digest"], "problem": problem} if block is None else decoded(one["type"] or "response", block, one["digest"])
            row = {k: one[k] for k in ("type", "record_id", "page", "uri", "refers")} | got | {"payload": got["payload"] if full else None}
            kinds = pa.schema([(k, {"payload": pa.binary(), "payload_bytes": pa.int64()}.get(k, pa.string())) for k in row])
            yield pa.RecordBatch.from_pylist([row] * copies, schema=kinds)


def read_warc(spark: SparkSession, path: str, *, id_type: str = "long", full: bool = True) -> DataFrame:
    """One row for each response, resource or revisit record: page_id, target_uri, record_type, refers_to, payload_bytes, payload_digest, problem, and with ``full`` payload.

    page_id and refers_to are null in archives that don't name them. A revisit has no payload
    of its own; its length and digest are those that the record states. ``problem`` says
    why a record has no payload (a segment is missing, lengths don't add up, broken
    framing) or that it differs from its digest. Files may be plain or gzip (also
    one member a record), segments may lie in any of them. A block is held by one task.
    """
    pieces = spark.read.option("lineSep", _NEXT.decode()).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").cast("binary").alias("value"))
    area = WorkArea(spark, "warc-read")
    parsed = area.save(pieces.mapInArrow(releasing(_parse, full=full), PARSED), "parsed")
    broken = [r.file for r in parsed.where("open").select("file").distinct().collect()]
    if broken:
        files = spark.read.format("binaryFile").load(broken).select(F.col("path").alias("file"), "content")
        again = files.mapInArrow(releasing(_whole), "file string, start long, value binary").mapInArrow(releasing(_parse, full=full), PARSED)
        again = area.save(again, "again").withColumn("problem", F.when(F.col("open"), "the file ends within a record").otherwise(F.col("problem")))
        parsed = parsed.where(~F.col("file").isin(broken)).unionByName(again)
    columns = ["type", "record_id", "page", "uri", "refers", "payload", "payload_bytes", "payload_digest", "problem"]
    whole = parsed.where("segment is null").select(*columns)
    first = lambda c: F.max(F.when(F.col("segment") == 1, F.col(c))).alias(c)
    parts = parsed.where("segment is not null").groupBy("origin").agg(F.collect_list(F.struct("segment", "total", "block")).alias("segments"), *[first(c) for c in ("type", "record_id", "page", "uri", "refers", "digest")])
    kinds = ", ".join(f"{c} {parsed.schema[c].dataType.simpleString()}" for c in columns)
    joined = parts.mapInArrow(releasing(_reassemble, full=full), kinds)
    out = whole.unionByName(joined.select(*columns))
    head = [F.col("page").cast(id_type).alias("page_id"), F.col("uri").alias("target_uri"), F.col("type").alias("record_type"), F.col("refers").cast(id_type).alias("refers_to"), F.col("payload_bytes"), F.col("payload_digest"), F.col("problem")]
    return out.select(*head, *[F.col("payload") for _ in range(full)])
