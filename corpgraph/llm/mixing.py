"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Each source's documents are dealt to shards by a hash. A shard's documents, in a
seeded order, are one stream of tokens that is cut into equal blocks. The blocks of
the mix go to the sources by highest quotients (target / odd numbers), and each
source's blocks to its shards in the same way, which gives integer quotas. A shard
takes its quota as whole passes over its blocks and, for the rest, one run of blocks
from a seeded start, past the last block on to the first. A run holds whole documents
but at its two ends, so the mix can be rounded to documents without a drift.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpgraph.llm.work import WorkArea

#: Tokens of a block.
BLOCK_TOKENS = 64
#: Tokens of a shard; a source has at most ``MAX_SHARDS``.
SHARD_TOKENS, MAX_SHARDS = 50_000, 65_536
#: Sources are planned on the driver, a few numbers each; more than this many is an error.
MAX_SOURCES = 100_000


def words_in(text):
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def sainte_lague(votes: Sequence[float], seats: int, most: Sequence[int] | None = None) -> list[int]:
    """``seats`` seats by highest quotients votes / (2s + 1), none above ``most``; ties go to the earlier party.

    A common divisor d that hands out no more than ``seats``, when each party gets
    round(votes / d), is found by bisection; what is left is handed out one by one.
    """
    most = [seats] * len(votes) if most is None else list(most)
    open_ = [i for i, v in enumerate(votes) if v > 0 and most[i] > 0]
    left = min(seats, sum(most[i] for i in open_))
    got = [0] * len(votes)
    if open_ and left > len(open_):
        # Quotients votes / (2s + 1) above 1 / (2d) are those of a party's first round(votes * d) seats.
        seats_at = lambda d: [min(most[i], math.ceil(votes[i] * d - 0.5)) for i in open_]
        low, high = 0.0, (left + len(open_)) / sum(votes[i] for i in open_)
        while sum(seats_at(high)) < left:
            low, high = high, 2 * high
        for _ in range(100):
            middle = (low + high) / 2
            if sum(seats_at(middle)) <= left:
                low = middle
            else:
                high = middle
        # A little below the divisor found, so that rounding of floats gives no seat too many.
        for i, n in zip(open_, seats_at(low * (1 - 1e-12)), strict=True):
            got[i] = max(0, n)
        left -= sum(got)
        open_ = [i for i in open_ if got[i] < most[i]]
    heap = [(-votes[i] / (2 * got[i] + 1), i) for i in open_]
    heapq.heapify(heap)
    while left > 0 and heap:
        _, i = heapq.heappop(heap)
        got[i] += 1
        left -= 1
        if got[i] < most[i]:
            heapq.heappush(heap, (-votes[i] / (2 * got[i] + 1), i))
    return got


def targets(sizes: Sequence[int], weights: Sequence[float], share: float, repeats: float) -> list[float]:
    """Each source's tokens: ``share`` of all by weight, at most ``repeats`` times its size, the excess reshared by weight."""
    out, open_ = [0.0] * len(sizes), [i for i, w in enumerate(weights) if w > 0]
    left = share * sum(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / total >= repeats * sizes[i]]
        if not full:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in full:
            out[i] = float(repeats * sizes[i])
        left -= sum(out[i] for i in full)
        open_ = [i for i in open_ if i not in set(full)]
    return out


def _quotas(rows: pd.DataFrame, seed: int) -> pd.DataFrame:
    """Integer quotas of one source's shards, and how each shard meets its quota."""
    rows = rows.sort_values("shard").reset_index(drop=True)
    block, repeats = int(rows.block[0]), float(rows.repeats[0])
    blocks = [-(-int(t) // block) for t in rows.tokens]
    caps = [math.floor(repeats * b) for b in blocks]
    got = sainte_lague([float(t) for t in rows.tokens], int(rows.seats[0]), caps)
    rows["blocks"] = blocks
    rows["passes"] = [g // b if b else 0 for g, b in zip(got, blocks, strict=True)]
    rows["extra"] = [g % b if b else 0 for g, b in zip(got, blocks, strict=True)]
    rows["shift"] = [(seed * 7919 + int(s) * 104729) % max(b, 1) for s, b in zip(rows.shard, blocks, strict=True)]
    return rows[["source_no", "shard", "blocks", "passes", "extra", "shift"]]


def _taken(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeats: float = 2.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of ``mix``, with text_hash and the words of the shard's run and of the gap beside it."""
    spark = docs.sparkSession
    # One pass over the texts; everything else reads these few bytes a row.
    rows = WorkArea(spark, "mixing").save(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), words_in(F.col(text_col)).alias("size"), F.xxhash64(F.col(text_col)).alias("text_hash")), "sizes")
    sums = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(MAX_SOURCES + 1).collect()
    if len(sums) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sums = sorted(sums, key=lambda r: (r.source is None, (r.source or "").encode("utf-8", "surrogatepass")))
    sizes, weight = [r["size"] for r in sums], [float(weights[i % len(weights)]) for i in range(len(sums))]
    aims = targets(sizes, weight, share, repeats)
    block = BLOCK_TOKENS
    seats = sainte_lague(aims, round(sum(aims) / block), [math.ceil(repeats * s / block) for s in sizes])
    plan = [(r.source, i, s, a, n, min(MAX_SHARDS, max(1, -(-s // SHARD_TOKENS)))) for i, (r, s, a, n) in enumerate(zip(sums, sizes, aims, seats, strict=True))]
    plan = spark.createDataFrame(plan, "source string, source_no int, source_size long, target double, seats long, shards int")
    # At most MAX_SOURCES rows of about 60 bytes.
    placed = rows.join(F.broadcast(plan), rows.source.eqNullSafe(plan.source)).drop(plan.source).withColumn("shard", F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.col("shards")).cast("int"))
    shards = placed.groupBy("source_no", "shard").agg(F.sum("size").alias("tokens"), F.first("seats").alias("seats")).withColumn("block", F.lit(block)).withColumn("repeats", F.lit(float(repeats)))
    quotas = shards.groupBy("source_no").applyInPandas(lambda pdf: _quotas(pdf, seed), "source_no int, shard int, blocks long, passes long, extra long, shift long")
    order = Window.partitionBy("source_no", "shard").orderBy(F.xxhash64("doc_id", "text_hash", F.lit(seed + 1)), "doc_id", "size", "text_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spread = placed.withColumn("to", F.sum("size").over(order)).withColumn("from", F.col("to") - F.col("size"))
    joined = spread.join(quotas, ["source_no", "shard"])
    extra = F.expr(
        f"""greatest(0L, least(`to`, least(shift + extra, blocks) * {block}) - greatest(`from`, shift * {block}))
        + greatest(0L, least(`to`, (shift + extra - blocks) * {block}) - `from`)"""
    )
    taken = F.when(F.col("size") == 0, F.lit(0)).otherwise(F.col("size") * F.col("passes") + F.when(F.col("extra") > 0, extra).otherwise(F.lit(0)))
    run, gap = (F.col("extra") * block).alias("run"), ((F.col("blocks") - F.col("extra")) * block).alias("gap")
    return joined.select("doc_id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"), "text_hash", run, gap)


def mix(docs: DataFrame, *, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, repeats: float = 2.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, size, source_size, target, taken.

    Sources in code-point order, null last, have ``weights`` in turn and share
    ``share`` times all words; a target stops at ``repeats`` times its source's size
    and the excess is reshared by weight until none is above. taken is the number of
    words that the mix takes from the document, repeats counted: its parts of the
    blocks of its shard that were chosen. No document is taken more than ``repeats``
    times (rounded up). Reruns on the same rows agree.

    Null and empty texts have size 0 and nothing is taken. Rows
    are dealt and ordered by hashes of id and text, so null or repeated ids are rows like
    others; rows that repeat id and text stand next to each other. Empty tables give no
    rows. Other columns are not read. Only a shard's document numbers and
    sizes meet in one task; shards are small whatever a source's share of the rows.
    """
    return _taken(docs, weights=weights, share=share, repeats=repeats, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col).drop("text_hash", "run", "gap")


def mixed_documents(docs: DataFrame, *, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """``docs`` with each document as often as the mix takes it: taken / size, rounded half up; documents without words go. All columns stay.

    Most documents are wholly inside or outside their shard's run, and rounding those
    at its ends evens out. It does not where a document has more than twice the words
    of the run or of the gap beside it: there the fraction is the chance of a seeded draw.

    Rows must differ in id, source or text; null ids and sources are taken like others.
    """
    took = _taken(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **options).where("size > 0")
    share = F.col("taken") / F.col("size")
    drawn = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed + 2)), F.lit(1 << 32)) / float(1 << 32)
    up = F.when(F.col("size") > 2 * F.least("run", "gap"), drawn).otherwise(0.5)
    took = took.groupBy("doc_id", "source", "text_hash").agg(F.max(F.floor(share + up)).cast("int").alias("copies")).where("copies > 0")
    names = docs.columns
    number = max(names, key=len) + "_copy"
    same = F.col(f"d.{id_col}").cast("long").eqNullSafe(F.col("t.doc_id")) & F.col(f"d.{source_col}").cast("string").eqNullSafe(F.col("t.source")) & (F.xxhash64(f"d.{text_col}") == F.col("t.text_hash"))
    keyed = docs.alias("d").join(took.alias("t"), same)
    return keyed.select(*[F.col(f"d.`{c}`") for c in names], F.explode(F.sequence(F.lit(1), F.col("t.copies"))).alias(number)).select(*[F.col(f"`{c}`") for c in names])
