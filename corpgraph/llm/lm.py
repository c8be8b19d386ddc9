"""Language-model scoring by a log-bilinear model, trained with noise-contrastive estimation.

Tokens are A-Z-lower-cased words, and one end token a text. The model predicts an
output unit from the units of the four tokens before: the most frequent words are
units of their own, every other word belongs to one of 64 classes by its last two
bytes, and the end is a unit. Given its class a word has its add-one share of the
class's training tokens, one share being left for words never seen:

    P(word | context) = softmax(q . S + b)[unit] * P(word | unit),  q = sum_i C_i * R[unit_i]

Counts cover all training texts and training passes over every training token. The
texts are dealt by a hash of id and text to rounds and copies, whose numbers follow
the training tokens and never the input's partitions. In a round each copy starts
from the last average and takes its texts in a seeded order; then the copies, and
their step sizes, are averaged by tokens.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.llm import batches
from corpgraph.llm.work import WorkArea, releasing

HEAD_UNITS, CLASSES, CONTEXT, WIDTH = 191, 64, 4, 16
UNITS = HEAD_UNITS + CLASSES + 1
END_UNIT = UNITS - 1
#: Words whose counts every task holds (16 bytes each); the counts of rarer ones are joined.
TABLE_WORDS = 400_000
NOISE, STEP_TOKENS, RATE, FIRST_SQUARE = 32, 1024, 0.2, 1e-3
#: Training tokens for each copy of the model, copies at most, rounds of a pass, and passes over all training tokens.
COPY_TOKENS, MAX_COPIES, ROUNDS, PASSES = 1_000_000, 16, 4, 1
#: Tokens whose contexts are held at once in training.
PIECE_TOKENS = 1 << 18
END_HASH = np.uint64(1)
FOLDS, HELD = 7, 2


def tokens(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and classes of all tokens, ends included, and where each text's tokens begin."""
    w = batches.Words(raw, offsets, lower=True)
    classes = (w.hashes(np.maximum(w.end - 2, w.start), w.end) % np.uint64(CLASSES)).astype(np.int64)
    first = w.first + np.arange(len(w.first))
    return np.insert(w.hashes() | np.uint64(2), w.first[1:], END_HASH), np.insert(classes, w.first[1:], 0), first


def _counts(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of a task's texts with class and count, merged whenever a few million are held."""
    held: list[tuple] = []

    def merged():
        h = np.concatenate([x[0] for x in held])
        order = np.argsort(h, kind="stable")
        h = h[order]
        start = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        return h[start], np.concatenate([x[1] for x in held])[order][start], np.add.reduceat(np.concatenate([x[2] for x in held])[order], start)

    for batch in rows:
        for _, raw, offsets in batches.slices(batch, "text"):
            h, cls, _ = tokens(raw, offsets)
            u, at, n = np.unique(h, return_index=True, return_counts=True)
            held.append((u, cls[at], n))
            if sum(len(x[0]) for x in held) > 2_000_000:
                held = [merged()]
    if held:
        h, cls, n = merged()
        for a in range(0, len(h), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(h[a : a + 100_000].view(np.int64)), pa.array(cls[a : a + 100_000].astype(np.int32)), pa.array(n[a : a + 100_000].astype(np.int64))], ["h", "cls", "c"])


@dataclass
class Vocabulary:
    keys: np.ndarray  # sorted hashes of the frequent words
    counts: np.ndarray
    unit: np.ndarray  # unit of each, -1 for those that share a class
    class_mass: np.ndarray  # training tokens + distinct words + 1 of each class

    def look_up(self, h: np.ndarray, cls: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts (-1: not in the table) and units."""
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        found = self.keys[at] == h
        own = np.where(found, self.unit[at], -1)
        return np.where(found, self.counts[at], -1), np.where(own >= 0, own, HEAD_UNITS + cls)


class Model:
    """R and S: context and output vectors; C: weights of the context's places; b: biases."""

    def __init__(self, share: np.ndarray, values: np.ndarray | None = None):
        self.share = share
        rng = np.random.default_rng(3)
        cut = np.cumsum([UNITS * WIDTH, UNITS * WIDTH, CONTEXT * WIDTH])
        if values is None:
            values = np.concatenate([rng.normal(0, 0.3, UNITS * WIDTH), rng.normal(0, 0.1, UNITS * WIDTH), np.full(CONTEXT * WIDTH, 1 / CONTEXT), np.log(share)])
        r, s, c, self.b = np.split(values.astype(np.float32), cut)
        self.R, self.S, self.C = r.reshape(UNITS, WIDTH), s.reshape(UNITS, WIDTH), c.reshape(CONTEXT, WIDTH)

    def values(self) -> np.ndarray:
        return np.concatenate([self.R.reshape(-1), self.S.reshape(-1), self.C.reshape(-1), self.b])

    def log10_probabilities(self, context: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """Normalised log10 P(unit | context), by matrix products over batches of tokens."""
        out = np.empty(len(unit))
        flat = [self.R * self.C[i] for i in range(CONTEXT)]
        for a in range(0, len(unit), 8192):
            ctx = context[a : a + 8192]
            q = flat[0][ctx[:, 0]]
            for i in range(1, CONTEXT):
                q += flat[i][ctx[:, i]]
            logits = q @ self.S.T
            logits += self.b
            top = logits.max(axis=1)
            own = logits[np.arange(len(ctx)), unit[a : a + 8192]] - top
            logits -= top[:, None]
            np.exp(logits, out=logits)
            out[a : a + 8192] = (own - np.log(logits.sum(axis=1))) / np.log(10)
        return out


def contexts(unit: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Units of the tokens before each token, nearest first; the end's unit stands before a text."""
    place = np.arange(len(unit)) - np.repeat(first[:-1], np.diff(first))
    out = np.full((len(unit), CONTEXT), END_UNIT, np.int32)
    for i in range(CONTEXT):
        out[i + 1 :, i] = unit[: max(0, len(unit) - i - 1)]
        out[place <= i, i] = END_UNIT
    return out


def _scatter(index: np.ndarray, values: np.ndarray) -> np.ndarray:
    return np.stack([np.bincount(index, weights=values[:, k], minlength=UNITS) for k in range(WIDTH)], axis=1).astype(np.float32)


class Trainer:
    """AdaGrad on the noise-contrastive objective, noise shared by a step's tokens."""

    def __init__(self, model: Model, seed: int, squares: np.ndarray | None = None):
        self.m, self.rng = model, np.random.default_rng(seed)
        sq = Model(model.share, np.full_like(model.values(), FIRST_SQUARE) if squares is None else squares)
        self.sq = [sq.R, sq.S, sq.C, sq.b]
        self.log_noise = np.log(NOISE * model.share).astype(np.float32)
        self.edges = np.cumsum(model.share)

    def step(self, ctx: np.ndarray, unit: np.ndarray) -> None:
        m, n = self.m, np.float32(1 / len(unit))
        noise = np.minimum(np.searchsorted(self.edges, self.rng.random(NOISE)), UNITS - 1)
        parts = m.R[ctx]
        q = np.einsum("bcd,cd->bd", parts, m.C)
        true = np.einsum("bd,bd->b", q, m.S[unit]) + m.b[unit] - self.log_noise[unit]
        false = q @ m.S[noise].T + (m.b[noise] - self.log_noise[noise])
        g_true = (-1 / (1 + np.exp(np.clip(true, -30, 30)))) * n
        g_false = (1 / (1 + np.exp(-np.clip(false, -30, 30)))) * n
        g_q = g_true[:, None] * m.S[unit] + g_false @ m.S[noise]
        g_S = _scatter(unit, g_true[:, None] * q)
        np.add.at(g_S, noise, g_false.T @ q)
        g_b = np.bincount(unit, weights=g_true, minlength=UNITS).astype(np.float32)
        np.add.at(g_b, noise, g_false.sum(axis=0))
        g_C = np.einsum("bcd,bd->cd", parts, g_q)
        g_R = _scatter(ctx.reshape(-1), (g_q[:, None, :] * m.C).reshape(-1, WIDTH))
        for x, g, sq in zip((m.R, m.S, m.C, m.b), (g_R, g_S, g_C, g_b), self.sq, strict=True):
            sq += g * g
            x -= np.float32(RATE) * g / np.sqrt(sq)


def _encode(rows: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    """Each text's units as 16-bit integers."""
    vocabulary: Vocabulary = shared.value
    for batch in rows:
        for part, raw, offsets in batches.slices(batch, "text"):
            h, cls, first = tokens(raw, offsets)
            packed = vocabulary.look_up(h, cls)[1].astype("<i2").tobytes()
            edges = (first * 2).tolist()
            yield pa.RecordBatch.from_arrays([part.column("dealt"), pa.array([packed[a:b] for a, b in zip(edges, edges[1:], strict=False)], pa.binary())], ["dealt", "units"])


def _pieces(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Units of some texts, and where each text's begin."""
    part = column.cast(pa.large_binary())
    offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
    unit = np.frombuffer(part.buffers()[2], np.uint8)[offsets[0] : offsets[-1]].view("<i2")
    first, at = (offsets - offsets[0]) // 2, 0
    while at < len(part):
        to = max(at + 1, int(np.searchsorted(first, first[at] + PIECE_TOKENS, "right")) - 1)
        yield unit[first[at] : first[to]], first[at : to + 1] - first[at]
        at = to


def _train(rows: Iterator[pa.RecordBatch], share: np.ndarray, values: np.ndarray, squares: np.ndarray, seed: int) -> Iterator[pa.RecordBatch]:
    """Of each copy whose texts are met, the model and squared gradients after them; rows come copy by copy."""
    copy, trainer, seen, ctx, unit = -1, None, 0, np.zeros((0, CONTEXT), np.int32), np.zeros(0, np.int16)

    def result():
        if len(unit):
            trainer.step(ctx, unit)
        after = [trainer.m.values(), np.concatenate([x.reshape(-1) for x in trainer.sq])]
        return pa.RecordBatch.from_arrays([pa.array([copy], pa.int32()), pa.array([seen], pa.int64()), *[pa.array([x.astype("<f4").tobytes()], pa.binary()) for x in after]], ["copy", "n", "v", "q"])

    for batch in rows:
        copies = batch.column("copy").to_numpy()
        cuts = [0, *(np.flatnonzero(copies[1:] != copies[:-1]) + 1).tolist(), len(copies)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b and copies[a] != copy:
                if trainer:
                    yield result()
                copy, seen, ctx, unit = int(copies[a]), 0, ctx[:0], unit[:0]
                trainer = Trainer(Model(share, values), seed + copy, squares)
            for more, first in _pieces(batch.column("units").slice(a, b - a)) if a < b else ():
                seen += len(more)
                ctx, unit = np.concatenate([ctx, contexts(more, first)]), np.concatenate([unit, more])
                # Steps follow the copy's tokens, not the batches; what is left waits for the next texts.
                whole = len(unit) // STEP_TOKENS * STEP_TOKENS
                for i in range(0, whole, STEP_TOKENS):
                    trainer.step(ctx[i : i + STEP_TOKENS], unit[i : i + STEP_TOKENS])
                ctx, unit = ctx[whole:], unit[whole:]
    if trainer:
        yield result()


def _learn(coded: DataFrame, share: np.ndarray, n: int) -> np.ndarray:
    """The model's values after all rounds over ``coded``: dealt (a hash of the row), units."""
    values = Model(share).values()
    squares = np.full_like(values, FIRST_SQUARE)
    copies = min(MAX_COPIES, max(1, n // COPY_TOKENS))
    slot = F.pmod("dealt", F.lit(copies * ROUNDS))
    slots = coded.select((slot / ROUNDS).cast("int").alias("copy"), (slot % ROUNDS).alias("round"), "dealt", "units")
    for k in range(PASSES * ROUNDS if n else 0):
        # More partitions than copies, so that few share a task; a copy's texts are in one.
        texts = slots.where(F.col("round") == k % ROUNDS).drop("round").repartition(4 * copies, "copy").sortWithinPartitions("copy", "dealt", "units")
        train = releasing(_train, share=share, values=values, squares=squares, seed=11 + k * copies)
        made = sorted(texts.mapInArrow(train, "copy int, n long, v binary, q binary").collect(), key=lambda r: r.copy)
        if made:
            weights = [r.n for r in made]
            values, squares = (np.average([np.frombuffer(r[c], "<f4") for r in made], axis=0, weights=weights).astype(np.float32) for c in ("v", "q"))
    return values


def _score(rows: Iterator[pa.RecordBatch], shared, values: np.ndarray, share: np.ndarray) -> Iterator[pa.RecordBatch]:
    vocabulary: Vocabulary = shared.value
    model = Model(share, values)
    for batch in rows:
        for part, raw, offsets in batches.slices(batch, "text"):
            h, cls, first = tokens(raw, offsets)
            c, unit = vocabulary.look_up(h, cls)
            sums = lambda x: np.diff(np.append(0.0, np.cumsum(x))[first])  # noqa: B023, E731
            held = np.where(c >= 0, np.log10(np.maximum(c, 0) + 1.0), 0.0)
            shares = (unit >= HEAD_UNITS) & (unit != END_UNIT)
            given = np.where(shares, held - np.log10(vocabulary.class_mass[np.clip(unit - HEAD_UNITS, 0, CLASSES - 1)]), 0.0)
            p = model.log10_probabilities(contexts(unit, first), unit) + given
            # Words beyond the table, once a text: their counts are joined.
            at = np.flatnonzero(c < 0)
            row = np.repeat(np.arange(part.num_rows), np.diff(first))[at]
            order = np.lexsort((h[at], row))
            r, x = row[order], h[at][order]
            start = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)
            times = np.diff(np.append(start, len(x)))
            bounds = pa.array(np.searchsorted(r[start], np.arange(part.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), pa.array(np.diff(first)), pa.array(sums(c > 0).astype(np.int64)), pa.array(sums(held)), pa.array(sums(p)), pa.ListArray.from_arrays(bounds, pa.array(x[start].view(np.int64))), pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32)))],
                ["doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "times"],
            )


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<long>, times array<int>"


def lm_scores(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from rows whose crc32 of the decimal doc_id, modulo 7, is not 2 (held_out:
    it is). base_score: sum of log10((c + 1) / (N + V + 1)) over the tokens, c being
    the token's training count, N all and V the distinct training tokens. score: the
    model's log10 probability of the text. n_known: tokens with c > 0.

    Null texts are empty and have the end token alone. A null doc_id counts as the
    empty string: such rows are trained on. Repeated rows are texts like others.
    Without training texts N is 0 and score is base_score; an empty table gives no
    rows. Other columns are not read; whole texts count, of any length. Words are
    told apart by 64-bit hashes.
    """
    spark = docs.sparkSession
    area = WorkArea(spark, "lm")
    ids = F.col(id_col).cast("long")
    held = F.pmod(F.crc32(F.coalesce(ids.cast("string"), F.lit("")).cast("binary")), F.lit(FOLDS)) == HELD
    texts = docs.select(ids.alias("doc_id"), F.col(text_col).cast("string").alias("text"), held.alias("held_out"))
    train = texts.where("not held_out").select("text")
    words = area.save(train.mapInArrow(releasing(_counts), "h long, cls int, c long").groupBy("h").agg(F.first("cls").alias("cls"), F.sum("c").alias("c")), "words")
    total = words.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    n, v = total.n, total.v

    # The lowest count whose words all fit the table; the histogram has a row for each different count.
    least, fit = 1, 0
    for r in words.groupBy("c").count().orderBy(F.desc("c")).limit(TABLE_WORDS).collect():
        if fit + r["count"] > TABLE_WORDS:
            least = r.c + 1
            break
        fit += r["count"]
    table = words.where(F.col("c") >= least).toPandas()
    h, c, cls = table.h.to_numpy(np.int64).view(np.uint64), table.c.to_numpy(np.int64), table.cls.to_numpy(np.int64)
    ends = h == END_HASH
    by_count = np.lexsort((h, -c))
    top = by_count[~ends[by_count]][:HEAD_UNITS]
    unit = np.full(len(h), -1)
    unit[top] = np.arange(len(top))
    unit[ends] = END_UNIT
    mass = np.ones(CLASSES)
    for r in words.where(F.col("h") != int(END_HASH)).groupBy("cls").agg(F.sum("c").alias("c"), F.count("*").alias("k")).collect():
        mass[r.cls] += r.c + r.k
    for i in top:
        mass[cls[i]] -= c[i] + 1
    share = np.ones(UNITS)
    share[unit[unit >= 0]] += c[unit >= 0]
    share[HEAD_UNITS : HEAD_UNITS + CLASSES] += mass - 1
    share /= share.sum()
    order = np.argsort(h)
    if len(h) == 0:
        h, c, unit, order = np.zeros(1, np.uint64), np.full(1, -1), np.full(1, -1), np.zeros(1, np.int64)
    shared = spark.sparkContext.broadcast(Vocabulary(h[order], c[order], unit[order], mass))

    dealt = texts.where("not held_out").select(F.xxhash64("doc_id", "text", F.lit(11)).alias("dealt"), "text")
    values = _learn(area.save(dealt.mapInArrow(releasing(_encode, shared=shared), "dealt long, units binary"), "coded"), share, n)
    area.drop("coded")
    scored = area.save(texts.mapInArrow(releasing(_score, shared=shared, values=values, share=share), SCORED).withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("h"), F.col("x.times").alias("times"))
    counted = rare.join(words.where(F.col("c") < least).select("h", "c"), "h").groupBy("row").agg(F.sum("times").alias("known"), F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("logs"))
    out = scored.drop("rare", "times").join(counted, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    base = F.col("base") + logs - F.col("n_tokens") * float(np.log10(n + v + 1))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), (F.col("score") + logs if n else base).alias("score"))
