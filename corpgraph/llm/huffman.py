"""Canonical, length-limited Huffman codes, and blocks of coded ids that decode independently."""

from __future__ import annotations

import numpy as np

#: Tokens between two bit-offset checkpoints of a block.
CHECKPOINT = 512
LIMIT = 16


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code length of each id by package-merge; 0 for ids that don't occur. The limit grows if the alphabet needs it."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        out[used] = 1
        return out
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    if limit > 24:
        raise ValueError("more than 2^24 different ids")
    leaves = np.argsort(counts[used], kind="stable")
    weight = counts[used][leaves].astype(np.float64)
    merged = weight
    levels = []
    for _ in range(limit - 1):
        pairs = merged[: len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weight, pairs])
        order = np.argsort(both, kind="stable")
        levels.append(order < len(weight))  # which items of this level are leaves
        merged = both[order]
    take, length = 2 * len(weight) - 2, np.zeros(len(weight), np.int64)
    for leaf in reversed(levels):
        n = int(leaf[:take].sum())
        length[:n] += 1
        take = 2 * (take - n)
    length[:take] += 1
    out[used[leaves]] = length
    return out


class Code:
    """The canonical code of some code lengths, and its decoding table."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.bits = max(1, int(self.lengths.max(initial=0)))
        used = np.flatnonzero(self.lengths)
        order = used[np.lexsort((used, self.lengths[used]))]
        width = self.lengths[order]
        span = np.int64(1) << (self.bits - width)
        first = np.cumsum(span) - span  # code, filled up to the longest length
        self.codes = np.zeros(len(lengths), np.uint64)
        self.codes[order] = (first >> (self.bits - width)).astype(np.uint64)
        self.symbol = np.zeros(1 << self.bits, np.uint32)
        self.step = np.zeros(1 << self.bits, np.int64)
        total = int(span.sum())
        self.symbol[:total] = np.repeat(order, span)
        self.step[:total] = np.repeat(width, span)

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bit stream (most significant bit first) and the bit offset of every ``CHECKPOINT``-th token."""
        if len(ids) == 0:
            return b"", np.zeros(0, np.int32)
        size = self.lengths[ids]
        ends = np.cumsum(size)
        at = ends - size
        value = self.codes[ids] << (64 - (at & 31) - size).astype(np.uint64)
        words = int(ends[-1] >> 5) + 2
        high = np.bincount(at >> 5, weights=(value >> np.uint64(32)).astype(np.float64), minlength=words)
        low = np.bincount((at >> 5) + 1, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=words)
        stream = (high + low).astype(np.uint64).astype(">u4").tobytes()
        return stream[: (int(ends[-1]) + 7) // 8], at[::CHECKPOINT].astype(np.int32)

    def decode(self, streams: list[bytes], offsets: list[np.ndarray], counts: list[int]) -> list[np.ndarray]:
        """Ids of several blocks. All runs between checkpoints go forward together, one table lookup a token each."""
        base = np.cumsum([0] + [len(s) + 4 for s in streams]) * 8
        raw = np.frombuffer(b"".join(s + b"\0\0\0\0" for s in streams) + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window = raw[:-3] << np.uint32(24) | raw[1:-2] << np.uint32(16) | raw[2:-1] << np.uint32(8) | raw[3:]
        at = np.concatenate([o.astype(np.int64) + b for o, b in zip(offsets, base, strict=False)] or [np.zeros(0, np.int64)])
        left = np.concatenate([np.minimum(CHECKPOINT, n - np.arange(0, n, CHECKPOINT)) for n in counts] or [np.zeros(0, np.int64)])
        order = np.argsort(-left, kind="stable")
        at, longest = at[order], left[order]
        out = np.zeros((len(at), CHECKPOINT), np.uint32)
        fill = np.uint32(32 - self.bits)
        for k in range(int(longest[0]) if len(longest) else 0):
            n = int(np.searchsorted(-longest, -k, "left"))
            p = at[:n]
            code = (window[p >> 3] << (p & 7).astype(np.uint32)) >> fill
            out[order[:n], k] = self.symbol[code]
            p += self.step[code]
        runs = np.cumsum([0] + [-(-n // CHECKPOINT) for n in counts])
        return [out[a:b].reshape(-1)[:n] for a, b, n in zip(runs, runs[1:], counts, strict=False)]
