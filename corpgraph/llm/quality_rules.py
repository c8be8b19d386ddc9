"""Quality rules by repetition coverage: how much of a text lies inside n-grams and lines that the text repeats.

Rolling hashes of several n-gram lengths are taken over the words of whole batches;
a character counts once however many repeated n-grams cover its word.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.llm import batches
from corpgraph.llm.work import releasing

#: Largest share of word characters inside repeated n-grams, by n, and inside repeated lines.
MOST_COVERED = {4: 0.30, 6: 0.25, 8: 0.20, 10: 0.15}
MOST_LINES = 0.30
BASE_WINDOW, BASE_WORDS, BASE_PERCENT = 5, 10, 20
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _covered(h: np.ndarray, w: batches.Words, n: int) -> np.ndarray:
    """Which words lie in an n-gram that occurs twice or more in their text."""
    at, keys = batches.grams(h, w.count, w.first, n)
    row = np.repeat(np.arange(len(w.count), dtype=np.uint64), w.count)[at]
    hit = at[batches.duplicated(keys + batches.mix(row + np.uint64(1)))]
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, hit, 1)
    np.add.at(edge, hit + n, -1)
    return np.cumsum(edge[:-1]) > 0


def _per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    sums = np.append(0, np.cumsum(values))
    return sums[first[1:]] - sums[first[:-1]]


def measure(raw: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts of ``apply_rules``, one value a text."""
    w = batches.Words(raw, offsets, lower=False)
    h, chars = w.hashes(), w.chars()
    out = {"n_words": w.count.astype(np.int64), "word_chars": _per_row(chars, w.first)}
    out["n_symbols"] = _per_row(_SYMBOL[raw].astype(np.int64), offsets)

    # Lines: spans between line ends; a text's end closes its last line.
    breaks = np.append(np.flatnonzero(raw == 10), len(raw))
    starts = np.union1d(breaks[:-1] + 1, offsets[:-1])
    starts = starts[starts < len(raw)]
    row = np.searchsorted(offsets, starts, "right") - 1
    stop = np.minimum(breaks[np.searchsorted(breaks, starts)], offsets[row + 1])
    worded = np.searchsorted(w.start, stop) > np.searchsorted(w.start, starts)
    starts, stop, row = starts[worded], stop[worded], row[worded]
    key = w.hashes(starts, stop) + batches.mix(row.astype(np.uint64) + np.uint64(1))
    order = np.argsort(key, kind="stable")
    later = np.zeros(len(key), bool)
    if len(key):
        later[order[1:][key[order][1:] == key[order][:-1]]] = True
    out["n_dup_lines"] = np.bincount(row[later], minlength=len(w.count)).astype(np.int64)
    leads = np.append(0, np.cumsum(chars))
    line_chars = leads[np.searchsorted(w.start, stop)] - leads[np.searchsorted(w.start, starts)]
    twice = batches.duplicated(key)
    out["line_chars"] = np.bincount(row[twice], weights=line_chars[twice], minlength=len(w.count)).astype(np.int64)
    out["n_repeat_words"] = _per_row(_covered(h, w, BASE_WINDOW).astype(np.int64), w.first)
    for n in MOST_COVERED:
        out[f"chars_{n}"] = _per_row(chars * _covered(h, w, n), w.first)
    return out


COLUMNS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "line_chars", *[f"chars_{n}" for n in MOST_COVERED]]


def _measured(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rows:
        for part, raw, offsets in batches.slices(batch, "text"):
            got = measure(raw, offsets)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), *[pa.array(got[c]) for c in COLUMNS]], ["doc_id", *COLUMNS])


def apply_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, counts, base_failed, kept.

    * n_words: runs of bytes other than ASCII blanks; word_chars: their code points.
    * n_symbols: characters of ``#*$%&|<>``.
    * n_dup_lines: lines (split at ``\\n``) with a word that equal an earlier line.
    * n_repeat_words: words inside 5-word windows found twice or more in the text.
    * line_chars, chars_N: word characters inside lines, or N-grams, found twice or more.
    * base_failed: under 10 words, or over 20 % of the words in repeated windows.
    * kept: not base_failed, and no share of characters above ``MOST_COVERED`` and ``MOST_LINES``.

    Null and empty texts have zero words, hence fail. Null ids and repeated rows give
    one row each; empty tables none; other columns are not read. Whole texts are
    measured, of any length; nothing is shuffled. N-grams are compared by 64-bit hashes.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    got = texts.mapInArrow(releasing(_measured), "doc_id long, " + ", ".join(f"{c} long" for c in COLUMNS))
    base = (F.col("n_words") < BASE_WORDS) | (100 * F.col("n_repeat_words") > BASE_PERCENT * F.col("n_words"))
    over = [F.col(f"chars_{n}") > most * F.col("word_chars") for n, most in MOST_COVERED.items()]
    over.append(F.col("line_chars") > MOST_LINES * F.col("word_chars"))
    return got.withColumn("base_failed", base).withColumn("kept", ~functools.reduce(lambda a, b: a | b, over, F.col("base_failed")))
