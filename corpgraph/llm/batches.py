"""Whole-batch text work in numpy: words, their hashes and n-grams straight from Arrow's buffers.

A word is a run of bytes other than 0x20 and 0x09-0x0D. No text is decoded and no
row is looped over for these steps; texts are taken in slices of a few MB, so
memory follows the slice (or the longest single text), not the partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LEAD = np.ones(256, bool)
_LEAD[0x80:0xC0] = False
_BYTE_KEYS = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_STEP, _MASK = 0x9E3779B97F4A7C15 | 1, (1 << 64) - 1
_GRAM_KEYS = np.random.default_rng(20240602).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3, in place on a fresh array."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's base and of its inverse. Those of a slice are kept; longer ones, for one long text, are not."""

    def table(base: int, size: int) -> np.ndarray:
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        return np.multiply.accumulate(steps)

    bases = {"up": _STEP, "down": pow(_STEP, -1, 1 << 64)}
    if n > SLICE_BYTES + 4096:
        return table(bases["up"], n), table(bases["down"], n)
    if not _powers:
        _powers.update({name: table(base, SLICE_BYTES + 4096) for name, base in bases.items()})
    return _powers["up"], _powers["down"]


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets) of slices of at most ``limit`` bytes of text, one row at least; null texts are empty."""
    texts = pc.fill_null(batch.column(column), "")
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
        part = texts.slice(at, to - at).cast(pa.large_binary())
        offsets = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
        data = part.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
        yield batch.slice(at, to - at), raw, offsets - offsets[0]
        at = to


class Words:
    """Words of a slice of texts: ``start`` and ``end`` in bytes, and ``first[i]:first[i+1]`` are the words of row i."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, lower: bool):
        self.raw, self.offsets = (_LOWER[raw] if lower else raw), offsets
        inside = ~_SPACE[raw]
        filled = offsets[:-1][offsets[:-1] < offsets[1:]]
        opens, closes = inside.copy(), inside.copy()
        opens[1:] &= ~inside[:-1]
        opens[filled] = inside[filled]
        last = offsets[1:][offsets[:-1] < offsets[1:]] - 1
        closes[:-1] &= ~inside[1:]
        closes[last] = inside[last]
        self.start, self.end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.count = np.diff(self.first)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of the words (or of other spans) that depend on their bytes alone."""
        start, end = (self.start, self.end) if start is None else (start, end)
        if not hasattr(self, "_sums"):
            up, self._down = _power_tables(len(self.raw) + 1)
            self._sums = np.zeros(len(self.raw) + 1, np.uint64)
            np.cumsum(_BYTE_KEYS[self.raw] * up[: len(self.raw)], out=self._sums[1:])
        return mix((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(np.uint64))

    def chars(self) -> np.ndarray:
        """Code points of each word."""
        if not hasattr(self, "_leads"):
            self._leads = np.zeros(len(self.raw) + 1, np.int64)
            np.cumsum(_LEAD[self.raw], out=self._leads[1:])
        return self._leads[self.end] - self._leads[self.start]


def grams(hashes: np.ndarray, count: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the first words of all n-grams within rows, and the n-grams' hashes."""
    total = len(hashes)
    if total < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    out = hashes[: total - n + 1] * _GRAM_KEYS[0]
    for i in range(1, n):
        out += hashes[i : total - n + 1 + i] * _GRAM_KEYS[i]
    left = np.repeat(first[1:], count)[: total - n + 1] - np.arange(total - n + 1)
    at = np.flatnonzero(left >= n)
    return at, mix(out[at])


def row_hash(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of the word sequence of each row (order counts)."""
    place = np.arange(len(hashes), dtype=np.uint64) - np.repeat(first[:-1], np.diff(first)).astype(np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(mix(hashes + mix(place)), out=sums[1:])
    return mix(sums[first[1:]] - sums[first[:-1]] + np.diff(first).astype(np.uint64))


def duplicated(keys: np.ndarray) -> np.ndarray:
    """Which keys occur twice or more."""
    if len(keys) == 0:
        return np.zeros(0, bool)
    order = np.argsort(keys)
    ranked = keys[order]
    same = ranked[1:] == ranked[:-1]
    hit = np.zeros(len(keys), bool)
    hit[order[1:][same]] = True
    hit[order[:-1][same]] = True
    return hit
