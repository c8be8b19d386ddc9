"""Alignment of two tokenizers' tokens over the same bytes, by packed bitsets of token ends.

Of a slice of texts, one bitset for each tokenizer has a bit at the last byte of every
token, 64 bits a word. Their AND holds the shared cuts, which part the tokens into
groups; select (the set bits in order) gives the cuts, and rank (popcounts summed over
words, and the popcount of a masked word) turns each cut into the number of tokens
that end up to it, hence into token ranges. The tokens that end together at a cut are
linked.

How often each pair of ids is linked is counted over the whole corpus. Tasks hold the
counts of at most ``TABLE_PAIRS`` pairs, the most frequent; those of rarer pairs are joined.

Texts are cut where neither tokenizer has a token that spans the cut: at a space
between two characters that aren't white space. Words of texts with single spaces and line
ends are hashed and looked up in numpy (``PairTable``), other texts piece by piece. Tables
are bounded; that of words lives as long as its Python worker. Where a word's
tokens don't give back its bytes, the text is encoded whole by both libraries.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.llm import batches
from corpgraph.llm.bpe import ChunkEncoder, Generations
from corpgraph.llm.word_table import WordTable
from corpgraph.llm.work import WorkArea, releasing

#: Id pairs whose counts a task holds (some 17 bytes each).
TABLE_PAIRS = 2_000_000
#: Pieces of texts with other white space that are kept, each generation; characters of a piece that is kept.
PIECES, LONGEST_PIECE = 20_000, 200
_MARK = "▁"


class BitSet:
    """Places in ``0:size``, packed 64 to a word."""

    def __init__(self, words: np.ndarray, size: int):
        self.words, self.size = words, size
        self.before = np.append(0, np.cumsum(np.bitwise_count(words), dtype=np.int64))

    @classmethod
    def of(cls, places: np.ndarray, size: int) -> BitSet:
        bits = np.zeros(-(-size // 64) * 64, np.uint8)
        bits[places] = 1
        return cls(np.packbits(bits, bitorder="little").view("<u8"), size)

    def __and__(self, other: BitSet) -> BitSet:
        return BitSet(self.words & other.words, self.size)

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Number of set places below each of ``places`` (0 to size)."""
        word, bit = places >> 6, (places & 63).astype(np.uint64)
        inner = np.append(self.words, np.uint64(0))[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(inner)

    def select(self) -> np.ndarray:
        """All set places in order: the k-th is where the rank passes k."""
        return np.flatnonzero(np.unpackbits(self.words.view(np.uint8), bitorder="little"))


class Aligned:
    """Groups and links of one stretch of tokens: ids and byte lengths of both sides, over the same bytes."""

    def __init__(self, a: np.ndarray, a_size: np.ndarray, b: np.ndarray, b_size: np.ndarray):
        self.a, self.b = a, b
        a_end, b_end = np.cumsum(a_size), np.cumsum(b_size)
        total = int(a_end[-1]) if len(a) else 0
        self.ends_a, self.ends_b = BitSet.of(a_end - 1, total), BitSet.of(b_end - 1, total)
        self.shared = self.ends_a & self.ends_b
        #: Last byte of each group, and the tokens of either side that end up to it.
        self.cuts = self.shared.select()
        self.a_to, self.b_to = self.ends_a.rank(self.cuts + 1), self.ends_b.rank(self.cuts + 1)
        self.a_group, self.b_group = self.shared.rank(a_end - 1), self.shared.rank(b_end - 1)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the tokens that end together, one link a cut, as every token has a byte at least."""
        return self.a[self.a_to - 1], self.b[self.b_to - 1]

    def interleaved(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each token in group order, the a tokens of a group first: id, whether it is of b, whether it is its side's last in the group."""
        n = len(self.a) + len(self.b)
        ids, of_b, last = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros(n, bool)
        at_a = np.arange(len(self.a)) + np.append(0, self.b_to)[self.a_group]
        at_b = np.arange(len(self.b)) + self.a_to[self.b_group]
        ids[at_a], ids[at_b], of_b[at_b] = self.a, self.b, True
        last[at_a[self.a_to - 1]] = last[at_b[self.b_to - 1]] = True
        return ids, of_b, last


class Pair:
    """Both tokenizers: a byte-level BPE file of the tokenizers library and a sentencepiece model that adds a space before the text."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = ChunkEncoder(a_path, True)
        self.a.tokenizer.encode_special_tokens = True  # their strings in texts are plain text
        made = json.loads(self.a.tokenizer.to_str())
        before = made["pre_tokenizer"] or {}
        if made["normalizer"] is not None or before.get("type") != "ByteLevel" or before.get("add_prefix_space"):
            raise ValueError(f"not a byte-level BPE tokenizer without normalizer and prefix: {a_path}")
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        chars = {c: b for b, c in _byte_names().items()}
        vocabulary = self.a.tokenizer.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(chars[c] for c in token) if all(c in chars for c in token) else token.encode()
        size = self.b.get_piece_size()
        names = [self.b.id_to_piece(i) for i in range(size)]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_MARK, " ").encode() for i, p in enumerate(names)]
        self.a_size, self.b_size = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        #: No piece of b has a space inside, and a cuts by the usual pattern: then a safe place of a is one of b.
        self.separable = before.get("use_regex", True) and not any(_MARK in p.lstrip(_MARK) for p in names)
        self.a.pieces, self.b_pieces = Generations(PIECES), Generations(PIECES)
        self.strings = np.array([str(i).encode() + end for side, ends in ((self.a_bytes, b",|"), (self.b_bytes, b",;")) for end in (ends[:1], ends[1:]) for i in range(len(side))], object)

    def whole(self, text: str) -> tuple[bytes, bytes] | None:
        """Ids of one text, straight from the libraries; None where either side's bytes aren't those of space and text."""
        a = self.a.tokenizer.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        b = self.b.encode(text)
        raw = (" " + text).encode()
        if b"".join(map(self.a_bytes.__getitem__, a)) != raw or b"".join(map(self.b_bytes.__getitem__, b)) != raw:
            return None
        return np.array(a, "<u4").tobytes(), np.array(b, "<u4").tobytes()

    def learn(self, pieces: list[str]) -> tuple[list[bytes], list[bytes], np.ndarray]:
        """Ids of both sides of pieces, which stand for themselves with a space before them but for those that open with a 0 byte; and whether their bytes come back."""
        held, self.a.pieces = self.a.pieces, Generations(1 << 62)
        self.a.learn(pieces)
        a, self.a.pieces = [self.a.pieces[p] for p in pieces], held
        after_line = [p[:1] == "\0" for p in pieces]
        # The model adds a space before every text: behind a line end it is out of the way.
        b = [ids[2:] if bare else ids for ids, bare in zip(self.b.encode(["\n" + p[1:] if bare else p for p, bare in zip(pieces, after_line, strict=True)], num_threads=1), after_line, strict=True)]
        raw = [p[1:].encode() if bare else (" " + p).encode() for p, bare in zip(pieces, after_line, strict=True)]
        want = np.fromiter(map(len, raw), np.int64, len(raw))
        good, joined = np.ones(len(pieces), bool), b"".join(raw)
        sides = (([np.frombuffer(x, "<u4") for x in a], self.a_bytes, self.a_size), ([np.array(x, np.int64) for x in b], self.b_bytes, self.b_size))
        for ids, names, sizes in sides:
            flat = np.concatenate([np.zeros(0, np.int64), *ids])
            upto = np.append(0, np.cumsum(sizes[flat.astype(np.int64)]))
            ends = np.cumsum(np.fromiter(map(len, ids), np.int64, len(ids)))
            good &= np.diff(np.append(0, upto[ends])) == want
            if b"".join(map(names.__getitem__, flat.astype(np.int64).tolist())) != joined:
                good &= np.array([b"".join(map(names.__getitem__, x.tolist())) == r for x, r in zip(ids, raw, strict=True)], bool)
        return a, [np.array(x, "<u4").tobytes() for x in b], good

    def encode(self, text: str) -> tuple[bytes, bytes] | None:
        """Ids of both sides as little-endian unsigned 32-bit integers; None: the text has no tokens."""
        if not text:
            return None
        if not self.separable or "\0" in text:
            return self.whole(text)
        a, b, cut = self.a.pieces, self.b_pieces, self.a.cut(" " + text)
        unseen = b.missing(cut)
        if unseen:
            for p, x, y, good in zip(unseen, *self.learn(unseen), strict=True):
                a[p], b[p] = x, y if good else None
        a.missing(cut)
        out = self.whole(text) if any(b[p] is None for p in set(cut)) else (b"".join(map(a.__getitem__, cut)), b"".join(map(b.__getitem__, cut)))
        for p in unseen:
            if len(p) > LONGEST_PIECE:
                del a[p], b[p]
        if len(b) > b.most:  # both hold the same pieces and turn over together
            a.most = len(a) - 1
            a.trim()
            b.trim()
        return out


class PairTable(WordTable):
    """Word hashes to the ids of both sides: a's, then b's."""

    slots = 1 << 21

    def __init__(self, both: Pair):
        super().__init__(both.a)
        self.both = both
        sp, marks = both.b, ".,;:!?"
        letters = [c for c in map(chr, range(128)) if c.isalpha()]
        apart = {sp.id_to_piece(i) for i in range(sp.get_piece_size())}
        #: A mark after a letter, and a line end, are tokens of their own in b too.
        self.usual = self.usual and both.separable and len(sp.encode("\n")) == 2 and not any(x + m in p for p in apart for m in marks for x in letters if m in p)
        self.newlines = (self.newline[:1], np.array(sp.encode("\n")[1:2], np.uint32))
        b_tails = np.zeros(256, np.uint32)
        for m in marks:
            b_tails[ord(m)] = sp.encode("a" + m)[-1]
        self.both_tails = (self.tails, b_tails)

    def clear(self) -> None:
        super().clear()
        self.a_ids = np.zeros(self.slots, np.uint16)

    def pair(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each side all ids of a slice of texts, and the number of each text's."""
        if not self.usual:
            return self._joined([], [], np.ones(len(offsets) - 1, bool), raw, offsets)
        w = batches.Words(raw, offsets, lower=False)
        odd = self._odd(raw, offsets, w)
        rows = w.rows()
        good = ~odd[rows]
        start, end = w.start[good], w.end[good]
        first = np.zeros(len(w.start), bool)
        first[w.first[:-1][w.count > 0]] = True
        bare = ((raw[np.maximum(w.start - 1, 0)] == 10) & ~first)[good]
        tail = self._tail(raw, start, end)
        end = end - (tail > 0)
        key = batches.mix(w.hashes(start, end) + bare.astype(np.uint64)) | np.uint64(1)
        if self.entries > self.slots // 2 or max(self.used, self.named) > 1 << 30:
            self.clear()
        distinct, where, which = np.unique(key, return_index=True, return_inverse=True)
        slot = self.find(distinct)
        unseen = np.flatnonzero(slot < 0)
        if len(unseen):
            data, pick = raw.tobytes(), where[unseen]
            names = [b"\0" * b + data[s:e] for s, e, b in zip(start[pick].tolist(), end[pick].tolist(), bare[pick].tolist(), strict=True)]
            a, b, fits = self.both.learn([n.decode("utf-8", "surrogatepass") for n in names])
            # A word whose bytes don't come back has no ids, which is told by its size.
            values = [x + y if f else b"" for x, y, f in zip(a, b, fits.tolist(), strict=True)]
            self.put(distinct[unseen], values, names)
            slot[unseen] = self.find(distinct[unseen])
            self.a_ids[slot[unseen]] = np.where(fits, np.fromiter(map(len, a), np.int64, len(a)) // 4, 0)
        lost = self._clashes(raw, start, end, bare, slot[which]) | (self.size[slot] == 0)[which]
        odd[rows[good][lost]] = True
        line, close, text = bare.astype(np.int64), (tail > 0).astype(np.int64), rows[good]
        at, size, a_ids = (x[slot][which].astype(np.int64) for x in (self.at, self.size, self.a_ids))
        ids, counts = [], []
        for k, (begin, n) in enumerate(((at, a_ids), (at + a_ids, size - a_ids))):
            # A line end's own id goes before the word that follows it, a mark's after its word.
            total = n + line + close
            ends = np.cumsum(total)
            out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint32)
            out[(ends - total)[line > 0]] = self.newlines[k][0]
            out[ends[tail > 0] - 1] = self.both_tails[k][tail[tail > 0]]
            from_ = ends - total + line
            place = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            out[np.repeat(from_, n) + place] = self.pool[np.repeat(begin, n) + place]
            ids.append(out)
            counts.append(np.bincount(text, weights=total, minlength=len(offsets) - 1).astype(np.int64))
        return self._joined(ids, counts, odd, raw, offsets)

    def _joined(self, ids: list, counts: list, odd: np.ndarray, raw: np.ndarray, offsets: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Puts in the texts that are encoded one by one."""
        counts = counts or [np.zeros(len(odd), np.int64)] * 2
        parts = [np.split(x, np.cumsum(n)[:-1]) for x, n in zip(ids, counts, strict=True)] if ids and odd.any() else [[np.zeros(0, np.uint32)] * len(odd)] * 2
        if not odd.any():
            return list(zip(ids, counts, strict=True))
        parts, counts = [list(p) for p in parts], [n.copy() for n in counts]
        for i in np.flatnonzero(odd):
            got = self.both.encode(raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "surrogatepass")) or (b"", b"")
            for k in (0, 1):
                parts[k][i] = np.frombuffer(got[k], "<u4")
                counts[k][i] = len(parts[k][i])
        return [(np.concatenate(p), n) for p, n in zip(parts, counts, strict=True)]

    @staticmethod
    def _tail(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """One punctuation mark after an ASCII letter, by which words are looked up without it."""
        last, before = raw[end - 1], raw[np.maximum(end - 2, 0)] | 32
        marks = np.isin(last, np.frombuffer(b".,;:!?", np.uint8))
        return np.where(marks & (end - start > 1) & (before >= 97) & (before <= 122), last, 0)


def _byte_names() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself where printable, else the next free one from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(rest)}


#: Word tables of this Python worker; of bounded size, they outlive tasks, as learning the words again costs more than the tokens.
_tables: dict[tuple[str, str], PairTable] = {}


def _align(rows: Iterator[pa.RecordBatch], a_path: str, b_path: str, full: bool) -> Iterator[pa.RecordBatch]:
    if (a_path, b_path) not in _tables:
        _tables[a_path, b_path] = PairTable(Pair(a_path, b_path))
    table = _tables[a_path, b_path]
    both = table.both
    n_a_ids, n_b_ids = len(both.a_bytes), len(both.b_bytes)
    for batch in rows:
        for part, raw, offsets in batches.slices(batch, "text"):
            pair = table.pair(raw, offsets)
            flat, counts = [x.astype(np.int64) for x, _ in pair], [n for _, n in pair]
            n_texts = part.num_rows
            got = Aligned(flat[0], both.a_size[flat[0]], flat[1], both.b_size[flat[1]])
            a_ends, b_ends = np.cumsum(counts[0]), np.cumsum(counts[1])
            # A text's last byte is a cut, so groups don't span texts.
            g_ends = np.searchsorted(got.a_to, a_ends, "right")
            ids, of_b, last = got.interleaved()
            codes = ids + np.where(of_b, 2 * n_a_ids + last * n_b_ids, last * n_a_ids)
            edges = np.append(0, a_ends + b_ends).tolist()
            named = both.strings[codes]
            digest = ["" if s == e else hashlib.sha256(b"".join(named[s:e])[:-1]).hexdigest() for s, e in zip(edges, edges[1:], strict=False)]
            la, lb = got.links()
            links = (la * n_b_ids + lb).astype("<u8" if n_a_ids * n_b_ids >= 1 << 32 else "<u4")
            packed, step = links.tobytes(), links.itemsize
            g_edges = (np.append(0, g_ends) * step).tolist()
            n_groups = np.diff(np.append(0, g_ends))
            cols = [part.column("doc_id"), *map(pa.array, (*counts, n_groups)), pa.array(digest, pa.string()), pa.array([packed[s:e] for s, e in zip(g_edges, g_edges[1:], strict=False)], pa.binary())]
            names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"]
            if full:
                # Of each group: tokens of both sides and bytes up to its end, counted within the text.
                row = np.repeat(np.arange(n_texts), n_groups)
                size = np.bincount(np.repeat(np.arange(n_texts), counts[0]), weights=both.a_size[flat[0]], minlength=n_texts).astype(np.int64)
                bounds = pa.array(np.append(0, g_ends).astype(np.int32))
                within = (got.a_to - (a_ends - counts[0])[row], got.b_to - (b_ends - counts[1])[row], got.cuts + 1 - (np.cumsum(size) - size)[row])
                cols += [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(c)).astype(np.int32)), pa.array(f.astype(np.int32))) for f, c in zip(flat, counts, strict=True)]
                cols += [pa.ListArray.from_arrays(bounds, pa.array(x)) for x in within]
                names += ["a_ids", "b_ids", "a_to", "b_to", "byte_to"]
            yield pa.RecordBatch.from_arrays(cols, names)


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All links of a batch and the number of each row's."""
    column = column.cast(pa.large_binary())
    edges = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[edges[0] : edges[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, np.diff(edges)


def _count(rows: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def flush() -> pa.RecordBatch:
        keys = np.concatenate([k for k, _ in held])
        n = np.concatenate([c for _, c in held])
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        start = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        return keys[start], np.add.reduceat(n, start)

    for batch in rows:
        for at in range(0, batch.num_rows, 1000):
            raw, _ = _codes(batch.slice(at, 1000).column("links"))
            if len(raw):
                held.append(np.unique(raw.view(f"<u{width}").astype(np.int64), return_counts=True))
                size += len(held[-1][0])
            if size > TABLE_PAIRS:
                held, size = [flush()], 0
                if len(held[0][0]) > TABLE_PAIRS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held.pop()], ["pair", "count"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in flush()], ["pair", "count"])


def _look_up(rows: Iterator[pa.RecordBatch], shared, width: int, keep: list[str]) -> Iterator[pa.RecordBatch]:
    pair, count, best = shared.value
    for batch in rows:
        for at in range(0, batch.num_rows, 1000):
            part = batch.slice(at, 1000)
            raw, sizes = _codes(part.column("links"))
            codes, row = raw.view(f"<u{width}").astype(np.int64), np.repeat(np.arange(part.num_rows), sizes // width)
            found = np.minimum(np.searchsorted(pair, codes), len(pair) - 1)
            hit = pair[found] == codes
            add = lambda x: np.diff(np.append(0, np.cumsum(x))[np.append(0, np.cumsum(sizes // width))])  # noqa: B023, E731
            known, top = add(np.where(hit, count[found], 0)), add(hit & best[found])
            # Pairs beyond the table, once a text: their counts are joined.
            lost = np.flatnonzero(~hit)
            order = np.lexsort((codes[lost], row[lost]))
            r, x = row[lost][order], codes[lost][order]
            start = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)
            times = np.diff(np.append(start, len(x)))
            bounds = pa.array(np.searchsorted(r[start], np.arange(part.num_rows + 1)).astype(np.int32))
            cols = [part.column(c) for c in keep] + [pa.array(known), pa.array(top.astype(np.int64)), pa.ListArray.from_arrays(bounds, pa.array(x[start])), pa.ListArray.from_arrays(bounds, pa.array(times))]
            yield pa.RecordBatch.from_arrays(cols, [*keep, "known", "top", "rare", "times"])


def align(docs: DataFrame, a_path: str, b_path: str, *, id_col: str = "doc_id", text_col: str = "text", full: bool = True, table_pairs: int = TABLE_PAIRS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Side a encodes space and text, side b the text, to which it adds the space. A group
    runs from one byte where tokens of both sides end to the next. count_sum adds up, over
    the links of a text, how often the corpus links their pair of ids; n_best are the links
    whose pair is its b id's most frequent (ties included). groups_sha256 is the digest
    of all groups as ``a1,a2|b1;a3|b2``. With ``full`` also a_ids, b_ids, and of each group
    a_to, b_to, byte_to: tokens of both sides and bytes of space and text up to its end.

    Null and empty texts, and those that either tokenizer doesn't give back byte for
    byte, have no tokens: zeros and ''. Null ids, repeated rows and empty tables pass
    through, ids keep their type, other columns are not read, and texts of any
    length are encoded whole. Texts are not shuffled.
    """
    spark = docs.sparkSession
    area = WorkArea(spark, "align")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    lists = ", a_ids array<int>, b_ids array<int>, a_to array<long>, b_to array<long>, byte_to array<long>" * full
    made = texts.mapInArrow(releasing(_align, a_path=a_path, b_path=b_path, full=full), f"doc_id {kind}, n_a long, n_b long, n_groups long, groups_sha256 string, links binary{lists}")
    rows = area.save(made, "rows")
    import sentencepiece

    n_b = sentencepiece.SentencePieceProcessor(model_file=b_path).get_piece_size()
    width = F.octet_length("links") / F.greatest("n_groups", F.lit(1))
    width = int(rows.agg(F.max(width)).first()[0] or 4)
    counted = rows.select("links").mapInArrow(releasing(_count, width=width), "pair long, count long").groupBy("pair").agg(F.sum("count").alias("count"))
    counted = counted.withColumn("b", F.col("pair") % n_b)
    most = counted.groupBy("b").agg(F.max("count").alias("most"))
    pairs = area.save(counted.join(most, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best")), "pairs")

    # The lowest count whose pairs all fit the table; the histogram has a row for each different count.
    least, fit = 1, 0
    for r in pairs.groupBy("count").agg(F.count("*").alias("n")).orderBy(F.desc("count")).limit(table_pairs).collect():
        if fit + r.n > table_pairs:
            least = r["count"] + 1
            break
        fit += r.n
    table = pairs.where(F.col("count") >= least).toPandas().sort_values("pair")
    pair, count, best = table.pair.to_numpy(np.int64), table["count"].to_numpy(np.int64), table.best.to_numpy(bool)
    if len(pair) == 0:
        pair, count, best = np.full(1, -1), np.zeros(1, np.int64), np.zeros(1, bool)
    shared = spark.sparkContext.broadcast((pair, count, best))
    keep = [f for f in rows.columns if f != "links"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "links") + ", known long, top long, rare array<long>, times array<long>"
    out = rows.mapInArrow(releasing(_look_up, shared=shared, width=width, keep=keep), schema)
    n_best, count_sum = F.col("top"), F.col("known")
    if least > 1:
        out = area.save(out.withColumn("row", F.monotonically_increasing_id()), "found")
        rare = out.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("pair"), F.col("x.times").alias("times"))
        sums = rare.join(pairs.where(F.col("count") < least), "pair").groupBy("row").agg(F.sum(F.col("times") * F.col("count")).alias("more"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_top"))
        out = out.join(sums, "row", "left")
        n_best, count_sum = n_best + F.coalesce("more_top", F.lit(0)), count_sum + F.coalesce("more", F.lit(0))
    head = [F.col("doc_id"), F.col("n_a"), F.col("n_b"), F.col("n_groups"), F.col("n_groups").alias("n_links"), n_best.alias("n_best"), count_sum.alias("count_sum"), F.col("groups_sha256")]
    return out.select(*head, *[c for c in ("a_ids", "b_ids", "a_to", "b_to", "byte_to") if full])
