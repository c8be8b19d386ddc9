"""Token ids in a binary format: canonical, length-limited Huffman blocks in ascending document order.

A store is a folder with two Parquet datasets, so any file system that Spark writes
will do and only whole tasks become visible:

* ``blocks``, in folders ``part=N`` that ascend by document: one row a block of whole
  documents with its first token's position (``start``), the documents' ids and
  token counts, the bit stream, and the bit offset of every 512th token. A block
  decodes on its own, and so does each run between two offsets.
* ``code``: one row with the code length of every id; the code is canonical.

Each text is tokenised once. Ids wait in a work table for the global counts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpgraph.llm import batches, bpe, huffman
from corpgraph.llm.word_table import WordTable
from corpgraph.llm.work import WorkArea, releasing

BLOCK_TOKENS = 1 << 16
#: Word tables of this Python worker; of bounded size, they outlive tasks, as learning the words again costs more than the tokens.
_tables: dict[str, WordTable] = {}


def _table(path: str) -> WordTable:
    if path not in _tables:
        _tables[path] = WordTable(bpe.ChunkEncoder(path, True))
    return _tables[path]


def _tokenise(rows: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    table, part, pos = _table(path), TaskContext.get().partitionId(), 0
    for batch in rows:
        for piece, raw, offsets in batches.slices(batch, "text"):
            ids, counts = table.encode(raw, offsets)
            ids = np.insert(ids, np.cumsum(counts), end_id).astype("<u4")
            counts = counts + 1
            kind = "<u2" if ids.max(initial=0) < 1 << 16 else "<u4"
            packed, width = ids.astype(kind).tobytes(), int(kind[-1])
            edges = (np.append(0, np.cumsum(counts)) * width).tolist()
            before = pos + np.cumsum(counts) - counts
            pos += int(counts.sum())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(counts), part, np.int32)), pa.array(before), piece.column("doc_id"), pa.array(counts), pa.array([packed[a:b] for a, b in zip(edges, edges[1:], strict=False)], pa.binary())],
                ["part", "pos", "doc_id", "n", "ids"],
            )


def _unpack(packed: bytes, n: int) -> np.ndarray:
    return np.frombuffer(packed, "<u2" if len(packed) == 2 * n else "<u4")


def _histogram(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1, np.int64)
    for batch in rows:
        held, size = [], 0
        for i, (n, packed) in enumerate(zip(batch.column("n").to_pylist(), batch.column("ids"), strict=True)):
            held.append(_unpack(packed.as_buffer(), n))
            size += n
            if size > 1 << 20 or i == batch.num_rows - 1:
                more = np.bincount(np.concatenate(held), minlength=len(total))
                more[: len(total)] += total
                total, held, size = more, [], 0
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(total[at])], ["id", "count"])


BLOCK = "start long, n_tokens long, doc_ids array<long>, doc_tokens array<long>, bits binary, offsets array<long>, part int"


def _blocks(rows: Iterator[pa.RecordBatch], lengths: np.ndarray, bases: dict[int, int]) -> Iterator[pa.RecordBatch]:
    code = huffman.Code(lengths)
    held: list[tuple] = []

    def flush():
        part, start = held[0][0], bases[held[0][0]] + held[0][1]
        bits, offsets = code.encode(np.concatenate([h[4] for h in held]))
        n = sum(h[3] for h in held)
        cols = [[start], [n], [[h[2] for h in held]], [[h[3] for h in held]], [bits], [offsets.tolist()], [part]]
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int64()), pa.int32()]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["start", "n_tokens", "doc_ids", "doc_tokens", "bits", "offsets", "part"])
        held.clear()
        return out

    size = 0
    for batch in rows:
        for part, pos, doc, n, packed in zip(*[batch.column(c).to_pylist() for c in ("part", "pos", "doc_id", "n", "ids")], strict=True):
            if held and (size >= BLOCK_TOKENS or held[0][0] != part or held[-1][1] + held[-1][3] != pos):
                yield flush()
                size = 0
            held.append((part, pos, doc, n, _unpack(packed, n)))
            size += n
    if held:
        yield flush()


def write_tokens(docs: DataFrame, out: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0) -> None:
    """Encodes every text with the byte-level tokenizer in file ``tokenizer``, appends ``end_id``, and writes the store ``out``.

    Documents ascend by id (nulls first; rows with equal ids by text). Null texts
    count as empty and have the end id alone. Other columns are not read. An empty
    table gives a store without blocks.
    """
    spark = docs.sparkSession
    area = WorkArea(spark, "token-store")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # One shuffle puts the documents in order; the ids leave it in the same order.
    # Rows of one id (or none) are parted by how their texts begin, which agrees with their order.
    ordered = texts.repartitionByRange("doc_id", F.substring("text", 1, 32)).sortWithinPartitions("doc_id", "text")
    made = ordered.mapInArrow(releasing(_tokenise, path=tokenizer, end_id=end_id), "part int, pos long, doc_id long, n long, ids binary")
    made.write.option("compression", "zstd").parquet(f"{area.path}/ids")
    ids = spark.read.schema(made.schema).parquet(f"{area.path}/ids")
    sums = ids.groupBy("part").agg(F.sum("n").alias("n")).collect()
    bases, total = {}, 0
    for r in sorted(sums, key=lambda r: r.part):
        bases[r.part], total = total, total + r.n
    found = ids.select("n", "ids").mapInArrow(releasing(_histogram), "id long, count long").groupBy("id").agg(F.sum("count").alias("count")).collect()
    counts = np.zeros(max((r.id for r in found), default=0) + 1, np.int64)
    for r in found:
        counts[r.id] = r["count"]
    lengths = huffman.code_lengths(counts)
    ids.mapInArrow(releasing(_blocks, lengths=lengths, bases=bases), BLOCK).write.mode("overwrite").option("compression", "none").partitionBy("part").parquet(f"{out}/blocks")
    spark.sql("SELECT unhex(:h) AS lengths, cast(:n AS long) AS tokens", {"h": zlib.compress(lengths.tobytes()).hex(), "n": total}).write.mode("overwrite").parquet(f"{out}/code")
    area.drop("ids")


def _read(rows: Iterator[pa.RecordBatch], lengths: np.ndarray) -> Iterator[pa.RecordBatch]:
    code = huffman.Code(lengths)
    for batch in rows:
        for at in range(0, batch.num_rows, 16):
            part = batch.slice(at, 16)
            streams = [b.as_py() for b in part.column("bits")]
            offsets = [np.array(o, np.int64) for o in part.column("offsets").to_pylist()]
            blocks = code.decode(streams, offsets, part.column("n_tokens").to_pylist())
            for start, docs, sizes, ids in zip(part.column("start").to_pylist(), part.column("doc_ids").to_pylist(), part.column("doc_tokens").to_pylist(), blocks, strict=True):
                n = np.array(sizes, np.int64)
                ends = np.cumsum(n)
                raw = ids.astype("<u4").tobytes()
                edges = (np.append(0, ends) * 4).tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(start + ends - n), pa.array(n), pa.array([raw[a:b] for a, b in zip(edges, edges[1:], strict=False)], pa.binary())],
                    ["doc_id", "start", "n_tokens", "ids"],
                )


def read_tokens(spark: SparkSession, store: str) -> DataFrame:
    """One row a document: doc_id, start (tokens before it), n_tokens, ids (little-endian unsigned 32-bit integers)."""
    head = spark.read.parquet(f"{store}/code").first()
    lengths = np.frombuffer(zlib.decompress(bytes(head.lengths)), np.uint8)
    blocks = spark.read.schema(BLOCK).parquet(f"{store}/blocks").drop("part")
    return blocks.mapInArrow(releasing(_read, lengths=lengths), "doc_id long, start long, n_tokens long, ids binary")
