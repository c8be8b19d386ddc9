"""Byte-level BPE of whole batches: words are hashed and looked up in numpy, and only new words go to the tokenizers library.

Applies where a text's white space is single spaces and single line ends between
words, for then every word, with the space before it, is encoded on its own. All
other texts go through ``ChunkEncoder``, and so do all texts where the tokenizer
isn't byte-level BPE over the usual split into words.

Words are found by 64-bit hashes and compared byte by byte: a text with a word whose
hash stands for another word goes through ``ChunkEncoder`` too.
"""

from __future__ import annotations

import json

import numpy as np

from corpgraph.llm import batches
from corpgraph.llm.bpe import ChunkEncoder, Generations

SLOTS = 1 << 22
#: Bytes of a word; texts with longer ones are encoded text by text.
LONGEST = 30_000
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_TAIL = np.zeros(256, bool)
_TAIL[list(b".,;:!?")] = True


class WordTable:
    """An open-addressing table from 64-bit word hashes to ids, emptied when half full."""

    slots = SLOTS

    def __init__(self, enc: ChunkEncoder):
        self.enc, self.newline = enc, np.frombuffer(enc.library(["\n"])[0], "<u4")
        made = json.loads(enc.tokenizer.to_str())
        before = made["pre_tokenizer"] or {}
        self.usual = made["normalizer"] is None and before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space") and len(self.newline) == 1 and all(len(enc.library([chr(b)])[0]) == 4 for b in np.flatnonzero(_TAIL))
        self.tails = np.zeros(256, np.uint32)
        for b in np.flatnonzero(_TAIL):
            self.tails[b] = np.frombuffer(enc.library([chr(b)])[0], "<u4")[:1].sum()
        self.clear()

    def clear(self) -> None:
        self.key, self.at, self.size = np.zeros(self.slots, np.uint64), np.zeros(self.slots, np.int32), np.zeros(self.slots, np.uint16)
        self.pool, self.used, self.entries = np.zeros(1 << 20, np.uint32), 0, 0
        self.name_at, self.name_size = np.zeros(self.slots, np.int32), np.zeros(self.slots, np.uint16)
        self.names, self.named = np.zeros(1 << 20, np.uint8), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slots of ``keys``, -1 for those not there."""
        slot = (keys >> np.uint64(40)).astype(np.int64) & (self.slots - 1)
        out = np.full(len(keys), -1)
        todo = np.arange(len(keys))
        while len(todo):
            there = self.key[slot[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = slot[todo[hit]]
            todo = todo[~hit & (there != 0)]
            slot[todo] = slot[todo] + 1 & self.slots - 1
        return out

    def put(self, keys: np.ndarray, values: list[bytes], names: list[bytes]) -> None:
        """Distinct new keys, their ids and the words that they stand for."""
        flat = np.frombuffer(b"".join(values), "<u4")
        size = np.fromiter(map(len, values), np.int64, len(values)) // 4
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(flat)), np.uint32)])
        self.pool[self.used : self.used + len(flat)] = flat
        at = self.used + np.cumsum(size) - size
        self.used += len(flat)
        self.entries += len(keys)
        text = np.frombuffer(b"".join(names), np.uint8)
        name_size = np.fromiter(map(len, names), np.int64, len(names))
        if self.named + len(text) > len(self.names):
            self.names = np.concatenate([self.names, np.zeros(max(len(self.names), len(text)), np.uint8)])
        self.names[self.named : self.named + len(text)] = text
        name_at = self.named + np.cumsum(name_size) - name_size
        self.named += len(text)
        slot = (keys >> np.uint64(40)).astype(np.int64) & (self.slots - 1)
        todo = np.arange(len(keys))
        while len(todo):
            free = self.key[slot[todo]] == 0
            self.key[slot[todo[free]]] = keys[todo[free]]
            mine = free & (self.key[slot[todo]] == keys[todo])
            self.at[slot[todo[mine]]] = at[todo[mine]]
            self.size[slot[todo[mine]]] = size[todo[mine]]
            self.name_at[slot[todo[mine]]], self.name_size[slot[todo[mine]]] = name_at[todo[mine]], name_size[todo[mine]]
            todo = todo[~mine]
            slot[todo] = slot[todo] + 1 & self.slots - 1

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice of texts (no end tokens) and the number of ids of each text."""
        if not self.usual:
            data, edges = raw.tobytes(), offsets.tolist()
            parts = [np.frombuffer(x, "<u4") for x in self.enc.library([data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(edges, edges[1:], strict=False)])]
            return np.concatenate([np.zeros(0, np.uint32), *parts]), np.array([len(p) for p in parts], np.int64)
        w = batches.Words(raw, offsets, lower=False)
        odd = self._odd(raw, offsets, w)
        rows = w.rows()
        good = ~odd[rows]
        start, end = w.start[good], w.end[good]
        first = np.zeros(len(w.start), bool)
        first[w.first[:-1][w.count > 0]] = True
        after_line = (raw[np.maximum(w.start - 1, 0)] == 10) & ~first
        bare = (first | after_line)[good]
        # One punctuation mark after an ASCII letter is a token of its own: words are looked up without it.
        tail = np.where(_TAIL[raw[end - 1]] & (end - start > 1) & _LETTER[raw[np.maximum(end - 2, 0)]], raw[end - 1], 0)
        end = end - (tail > 0)
        key = batches.mix(w.hashes(start, end) + bare.astype(np.uint64)) | np.uint64(1)
        if self.entries > self.slots // 2 or max(self.used, self.named) > 1 << 30:
            self.clear()
        distinct, where, which = np.unique(key, return_index=True, return_inverse=True)
        slot = self.find(distinct)
        unseen = np.flatnonzero(slot < 0)
        if len(unseen):
            data, pick = raw.tobytes(), where[unseen]
            pieces = ["\0" * b + data[s:e].decode("utf-8", "surrogatepass") for s, e, b in zip(start[pick].tolist(), end[pick].tolist(), bare[pick].tolist(), strict=True)]
            self.enc.pieces = Generations(1 << 62)
            self.enc.learn(list(set(pieces)))
            self.put(distinct[unseen], [self.enc.pieces[p] for p in pieces], [p.encode("utf-8", "surrogatepass") for p in pieces])
            self.enc.pieces = Generations(1 << 62)
            slot[unseen] = self.find(distinct[unseen])
        clash = self._clashes(raw, start, end, bare, slot[which])
        odd[rows[good][clash]] = True
        at, size = self.at[slot][which].astype(np.int64), self.size[slot][which].astype(np.int64)
        # A line end's own id goes before the word that follows it, a punctuation mark's after its word.
        line, close = after_line[good].astype(np.int64), (tail > 0).astype(np.int64)
        total = size + line + close
        ends = np.cumsum(total)
        ids = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
        ids[(ends - total)[line > 0]] = self.newline[0]
        ids[ends[tail > 0] - 1] = self.tails[tail[tail > 0]]
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        ids[np.repeat(ends - close - size, size) + place] = self.pool[np.repeat(at, size) + place]
        counts = np.bincount(rows[good], weights=total, minlength=len(offsets) - 1).astype(np.int64)
        if not odd.any():
            return ids, counts
        parts = np.split(ids, np.cumsum(counts)[:-1])
        for i in np.flatnonzero(odd):
            text = raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "surrogatepass")
            parts[i] = np.frombuffer(self.enc.encode([text])[0], "<u4")
            counts[i] = len(parts[i])
        return np.concatenate(parts), counts

    def _clashes(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, bare: np.ndarray, slot: np.ndarray) -> np.ndarray:
        """Which words aren't, byte for byte, those of their slots."""
        size, name, lead = (end - start).astype(np.int32), self.name_at[slot], bare.astype(np.int32)
        out = (self.name_size[slot] != size + lead) | (bare != (self.names[np.minimum(name, len(self.names) - 1)] == 0))
        if out.any():
            keep = np.flatnonzero(~out)
            start, size, name, lead = start[keep], size[keep], name[keep], lead[keep]
        if len(size):
            ends = np.cumsum(size, dtype=np.int32)
            at = np.arange(ends[-1], dtype=np.int32) + np.repeat(start.astype(np.int32) - (ends - size), size)
            differ = np.flatnonzero(raw[at] != self.names[at + np.repeat(name + lead - start.astype(np.int32), size)])
            if len(differ):
                lost = np.unique(np.searchsorted(ends, differ, "right"))
                out[np.flatnonzero(~out)[lost]] = True
        return out

    def _odd(self, raw: np.ndarray, offsets: np.ndarray, w: batches.Words) -> np.ndarray:
        """Texts with other white space than single spaces and line ends between words, or with an added token's content."""
        odd = np.zeros(len(offsets) - 1, bool)
        size = np.diff(offsets)
        inner = np.bincount(w.rows(), weights=w.end - w.start, minlength=len(size)).astype(np.int64)
        odd |= size - inner != np.maximum(w.count - 1, 0)
        odd[np.searchsorted(w.first, np.flatnonzero(w.end - w.start > LONGEST), "right") - 1] = True
        other = ((raw < 0x20) & (raw != 10)) | (raw == 0x7F)
        hi = np.flatnonzero((raw == 0xC2) | ((raw >= 0xE1) & (raw <= 0xE3)))
        if len(hi):
            a, b, c = raw[hi], raw[np.minimum(hi + 1, len(raw) - 1)], raw[np.minimum(hi + 2, len(raw) - 1)]
            space = (a == 0xC2) & ((b == 0x85) | (b == 0xA0)) | (a == 0xE1) & (b == 0x9A) & (c == 0x80) | (a == 0xE3) & (b == 0x80) & (c == 0x80) | (a == 0xE2) & ((b == 0x80) & ((c <= 0x8A) | (c == 0xA8) | (c == 0xA9) | (c == 0xAF)) | (b == 0x81) & (c == 0x9F))
            other[hi] |= space
        data = raw.tobytes() if self.enc.added else b""
        for a in map(str.encode, self.enc.added):
            at = data.find(a)
            while at >= 0:
                other[at] = True
                at = data.find(a, at + 1)
        hit = np.flatnonzero(other)
        odd[np.searchsorted(offsets, hit, "right") - 1] = True
        return odd
