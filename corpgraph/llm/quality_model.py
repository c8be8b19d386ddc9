"""Quality classifier: ordinal (cumulative-link) regression on graded ratings with hashed text features.

P(grade <= k) = sigmoid(threshold_k - f(text)): one weight vector for all grades,
and ordered thresholds. f sums the weights of the text's features: its distinct
words, the distinct endings of its words in their own case, and bins of its length
and of its share of distinct words.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.llm import batches
from corpgraph.llm.work import release, releasing

BUCKETS = 1 << 18
#: The sample that the model is fitted on: labelled rows by the least hashes of their ids, so many and so many bytes of text at most.
FIT_ROWS, FIT_BYTES = 20_000, 256 << 20
#: A feature counts if so many rows of the sample have it, and if its presence goes with the highest grade or its absence: chi-squared of 10, about 1 in 600 by chance.
LEAST_ROWS, LEAST_CHI2 = 4, 10.0
EPOCHS, RATE, DECAY, STEP_ROWS = 20, 0.3, 1e-4, 128


@dataclass
class OrdinalModel:
    weights: np.ndarray
    thresholds: np.ndarray  # ascending, one fewer than grades

    def grades(self, values: np.ndarray) -> np.ndarray:
        """Probability of each grade, one row a value."""
        below = 1 / (1 + np.exp(-np.clip(self.thresholds[None, :] - values[:, None], -60, 60)))
        edges = np.hstack([np.zeros((len(values), 1)), below, np.ones((len(values), 1))])
        return np.diff(edges, axis=1)


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text, one after another, and where each text's begin."""
    w = batches.Words(raw, offsets, lower=True)
    rows = w.rows()
    cased = batches.Words(raw, offsets, lower=False)
    ending = cased.hashes(np.maximum(cased.end - 2, cased.start), cased.end)
    size = np.uint64(BUCKETS // 4)
    word = w.hashes() % (np.uint64(3) * size)
    end = np.uint64(3) * size + ending % (size - np.uint64(64))
    both = np.unique(np.concatenate([rows, rows]).astype(np.uint64) * np.uint64(BUCKETS) + np.concatenate([word, end]))
    row, number = (both // np.uint64(BUCKETS)).astype(np.int64), (both % np.uint64(BUCKETS)).astype(np.int32)
    words_only = np.bincount(row[number < 3 * BUCKETS // 4], minlength=len(w.count))
    share = np.minimum(words_only * 16 // np.maximum(w.count, 1), 15)
    length = np.minimum(np.log2(w.count + 1).astype(np.int64), 31)
    extra = np.stack([BUCKETS - 64 + share, BUCKETS - 32 + length]).astype(np.int32)
    first = np.searchsorted(row, np.arange(len(w.count) + 1))
    out = np.insert(number, np.repeat(first[1:], 2), extra.T.reshape(-1))
    return out, first + 2 * np.arange(len(first))


def _featured(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for part, raw, offsets in batches.slices(batch, "text"):
            numbers, first = features(raw, offsets)
            yield pa.RecordBatch.from_arrays([part.column("grade"), pa.array([numbers[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)], pa.binary())], ["grade", "features"])


def _rows_with(features: Iterable[np.ndarray]) -> np.ndarray:
    """How many rows have each feature; a row's features are distinct. Row by row, as the driver has little room."""
    out = np.zeros(BUCKETS, np.int64)
    for x in features:
        out[x] += 1
    return out


def fit_rows(rows: list[tuple[int, np.ndarray]], grades: int, seed: int = 5) -> OrdinalModel:
    """Fits on (grade, feature numbers) by AdaGrad on the likelihood."""
    y = np.array([g for g, _ in rows], np.int64)
    seen = _rows_with(x for _, x in rows).astype(np.float64)
    low = _rows_with(x for g, x in rows if g < grades - 1)
    rate = min(max(float((y < grades - 1).mean()), 1e-6), 1 - 1e-6)
    chi2 = (low - seen * rate) ** 2 / np.maximum(seen * rate * (1 - rate) * (1 - seen / (len(y) + 1)), 1e-9)
    useful = (seen >= LEAST_ROWS) & (chi2 >= LEAST_CHI2)
    xs = [x[useful[x]] for _, x in rows]
    share = np.cumsum(np.bincount(y, minlength=grades) + 1.0)[:-1] / (len(y) + grades)
    model = OrdinalModel(np.zeros(BUCKETS), np.log(share / (1 - share)))
    square_w, square_t = np.full(BUCKETS, 1e-6), np.full(grades - 1, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(order), STEP_ROWS):
            pick = order[at : at + STEP_ROWS]
            sizes = np.array([len(xs[i]) for i in pick])
            flat = np.concatenate([xs[i] for i in pick])
            row = np.repeat(np.arange(len(pick)), sizes)
            value = np.bincount(row, weights=model.weights[flat], minlength=len(pick))
            padded = np.concatenate([[-60.0], model.thresholds, [60.0]])
            a = 1 / (1 + np.exp(-np.clip(padded[y[pick] + 1] - value, -60, 60)))
            b = 1 / (1 + np.exp(-np.clip(padded[y[pick]] - value, -60, 60)))
            likely = np.maximum(a - b, 1e-9)
            slope = (1 - a - b) / len(pick)
            grad = np.bincount(flat, weights=slope[row], minlength=BUCKETS) + DECAY * model.weights
            square_w += grad * grad
            model.weights -= RATE * grad / np.sqrt(square_w) * (grad != 0)
            grad_t = np.zeros(grades + 1)
            np.add.at(grad_t, y[pick] + 1, -a * (1 - a) / likely / len(pick))
            np.add.at(grad_t, y[pick], b * (1 - b) / likely / len(pick))
            square_t += grad_t[1:-1] ** 2
            model.thresholds = np.maximum.accumulate(model.thresholds - RATE * grad_t[1:-1] / np.sqrt(square_t))
    model.weights = model.weights.astype(np.float32)
    return model


def graded(labels: DataFrame, *, id_col: str = "doc_id") -> DataFrame:
    """doc_id, grade from labels quality and toxic (0 or 1): 2 good and not toxic, 1 one of the two, 0 neither.

    Rows with a null are left out; of a document's several grades the lowest counts.
    """
    grade = F.col("quality").cast("int") + 1 - F.col("toxic").cast("int")
    return labels.select(F.col(id_col).cast("long").alias("doc_id"), grade.alias("grade")).where("doc_id is not null and grade between 0 and 2").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def fit(docs: DataFrame, grades: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", levels: int = 3, most_rows: int = FIT_ROWS, most_bytes: int = FIT_BYTES) -> OrdinalModel | None:
    """Fits on a sample of ``grades`` (doc_id, grade from 0 to levels - 1). None where no two grades occur.

    The sample holds at most ``most_rows`` rows, and no more than ``most_bytes`` of
    their texts: the first rows, in order of a hash of the id (of one id by length), that
    stay within both, also where ids repeat.
    """
    picked = grades.where(F.col("grade").between(0, levels - 1)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = texts.join(F.broadcast(picked), "doc_id").select("doc_id", "grade", "text")
    # Rows of three numbers, one more than may count; their order is that of the ids' hashes.
    hashed, size = F.xxhash64("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0))
    sizes = found.select(hashed.alias("h"), "doc_id", size.alias("n")).orderBy("h", "doc_id", "n").limit(most_rows + 1).collect()
    fit_in = min(most_rows, int(np.searchsorted(np.cumsum([r.n for r in sizes]), most_bytes, "right")))
    if fit_in < len(sizes):
        # The first row beyond: ids before its id count whole, and of its own id the rows before it.
        last = sizes[fit_in]
        own = sum(r.doc_id == last.doc_id for r in sizes[:fit_in])
        before = found.where((hashed < last.h) | ((hashed == last.h) & (F.col("doc_id") < last.doc_id)))
        found = before.unionByName(found.where(F.col("doc_id") == last.doc_id).orderBy(size, F.xxhash64("text"), "text", "grade").limit(own)) if own else before
    rows = found.select("grade", "text").mapInArrow(releasing(_featured), "grade int, features binary").collect()
    sample = sorted((r.grade, bytes(r.features)) for r in rows)
    del rows
    model = fit_rows([(g, np.frombuffer(x, np.int32)) for g, x in sample], levels) if len({g for g, _ in sample}) > 1 else None
    del sample
    # The driver's Python shares one budget with its JVM, also in the stages that follow.
    release()
    return model


SCORES = [("expected_grade", "double"), ("tail_probability", "double"), ("kept", "boolean")]


def _scored(rows: Iterator[pa.RecordBatch], model: OrdinalModel | None, least: float, text: str, filtering: bool) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for part, raw, offsets in batches.slices(batch, text):
            n = part.num_rows
            if model is None:
                expected, tail = np.full(n, np.nan), np.ones(n)
            else:
                numbers, first = features(raw, offsets)
                sums = np.append(0.0, np.cumsum(model.weights[numbers], dtype=np.float64))
                p = model.grades(sums[first[1:]] - sums[first[:-1]])
                expected, tail = p @ np.arange(p.shape[1]), p[:, -1]
            keep = pa.array(tail >= least)
            if filtering:
                yield part.filter(keep)
            else:
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(expected, mask=np.isnan(expected)), pa.array(tail), keep], ["doc_id", *[k for k, _ in SCORES]])


def score(docs: DataFrame, model: OrdinalModel | None, *, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, expected_grade, tail_probability (of the highest grade), kept.

    kept: tail_probability >= ``least``. Null texts count as empty; a text without
    words is judged by its length bin. Without a model (no graded rows) all rows are
    kept, with tail_probability 1 and expected_grade null. Null ids and repeated rows
    give one row each; empty tables none; other columns are not read. Whole texts
    count, of any length; nothing is shuffled.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(releasing(_scored, model=model, least=least, text="text", filtering=False), "doc_id long, " + ", ".join(f"{k} {t}" for k, t in SCORES))


def keep_good(docs: DataFrame, model: OrdinalModel | None, *, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, with all their columns; the text column becomes a string if it isn't one."""
    docs = docs.withColumn(text_col, F.col(f"`{text_col}`").cast("string"))
    return docs.mapInArrow(releasing(_scored, model=model, least=least, text=text_col, filtering=True), docs.schema)
