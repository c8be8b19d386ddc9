"""BPE encoding and decoding with content-defined chunk reuse.

A text is cut into chunks where a rolling hash of the last bytes says so, be it within
a word, hence at the same places in every copy of a passage. Of a chunk, the part from
its first to its last safe place is encoded once and kept. At a safe place (a space
between two characters that aren't white space, or any space where white space only
parts tokens) no token can span both sides.

Joins are then repaired: what lies between the last safe place of a chunk and the
first of the next is encoded again as one; where the next chunk has none, the span
grows over it, and so on until both sides agree on a place or the text ends.

What is new is cut at every safe place (pieces), and only pieces that were never seen
go to the tokenizers library, many in one call. Texts with the content of an added
token go to the library whole.

Chunk and piece tables are bounded and live as long as a task: when a table is full it
becomes the old generation, which hits are copied from, and a new one starts.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.llm.work import releasing

#: Entries of the piece and chunk tables of a task, each generation: some 25 MB and 4 MB.
PIECES, CHUNKS = 120_000, 4_000
#: Bytes in a chunk, on average, less one: a chunk ends where these bits of the rolling hash are 0.
CHUNK_MASK = 0x1FF
WINDOW = 16
_BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0                　"
_FIRST = "\0"
_CONTROL = re.compile("[\x1c-\x1f]").search
_SAFE = re.compile(r"(?<=\S) (?=\S)").search
_SAFE_AT = re.compile(r"\S \S").match
_LEANING = re.compile(r"\s |\s$| \s|^\s").search
#: One pre-token of Latin letters, and punctuation that is a pre-token of its own.
_SIMPLE = re.compile("([A-Za-zÀ-ÖØ-öø-įıĲ-ɏ]+)([.,;:!?]*)").fullmatch
_LINES = re.compile(r"[^\s\0]+\n\S+").fullmatch


class Generations(dict):
    """A dict of bounded size: ``old`` holds what was there before it was last full."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def missing(self, keys: Iterable) -> list:
        """Those of ``keys`` that neither generation has; the others are in the young one afterwards."""
        out = []
        for k in set(keys).difference(self):
            if k in self.old:
                self[k] = self.old[k]
            else:
                out.append(k)
        return out

    def trim(self) -> None:
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()


def rolling_hash(raw: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` bytes that end at each place, by doubling."""
    h = raw.astype(np.uint32) * np.uint32(0x9E3779B1)
    width, factor = 1, 0x01000193
    while width < WINDOW:
        grown = h.copy()
        grown[width:] += h[:-width] * np.uint32(factor & 0xFFFFFFFF)
        h, width, factor = grown, width * 2, factor * factor & 0xFFFFFFFF
    return h ^ (h >> np.uint32(15))


class ChunkEncoder:
    """Encodes texts as ``Tokenizer.encode(text, add_special_tokens=False)`` of ``path`` does, reusing chunks.

    ``spaces_stay``: the tokenizer's tokens carry the space to their left (byte-level
    BPE); otherwise white space is dropped and splits tokens, and texts are lower-cased.
    """

    def __init__(self, path: str, spaces_stay: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.spaces_stay = spaces_stay
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.pieces, self.chunks = Generations(PIECES), Generations(CHUNKS)
        #: Chunks found in the table, chunks encoded, and joins repaired so far.
        self.reused = self.encoded = self.repairs = 0
        self.names: list[str] | None = None
        # The file's own BPE model behind a plain split, for pieces known to be one pre-token.
        self.model = Tokenizer(self.tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        alphabet = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {b: alphabet.pre_tokenize_str(bytes([b]).decode("latin-1"))[0][0][-1:] for b in range(128)}
        self.bytes |= {b: alphabet.pre_tokenize_str(chr(0x80 + (b & 0x3F)))[0][0][-1:] for b in range(0x80, 0xC0)}
        self.bytes |= {b: alphabet.pre_tokenize_str(chr((b & 0x1F) << 6))[0][0][:1] for b in range(0xC2, 0xCA)}
        self.mark = self.model.encode(self.bytes[10], add_special_tokens=False).ids

    def library(self, texts: list[str]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers, straight from the library."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def plain(self, words: list[str]) -> list[bytes]:
        """The same for single pre-tokens of Latin letters: one call to the model, with a line end's token between words."""
        text = "\n".join(words if self.spaces_stay else [w.lower() for w in words])
        mapped = text.encode().decode("latin-1").translate({**self.bytes, 10: f" {self.bytes[10]} "})
        ids = np.array(self.model.encode_batch_fast([mapped], add_special_tokens=False)[0].ids, "<u4")
        stops = np.flatnonzero(ids == self.mark[0])
        raw, step = ids.tobytes(), 4
        starts = np.append(0, stops + 1) * step
        return [raw[a:b] for a, b in zip(starts.tolist(), np.append(stops * step, len(raw)).tolist(), strict=True)]

    def learn(self, unseen: list[str]) -> None:
        """Puts the ids of new pieces into the table."""
        simple, other, lines = [], [], []
        for p in unseen:
            m = _SIMPLE(p)
            if m:
                simple.append((p, m[1], m[2]))
            elif self.spaces_stay and _LINES(p):
                lines.append((p, p.split("\n", 1)))
            else:
                other.append(p)
        if lines and len(self.mark) == 1:  # a line end between two other characters is a token of its own
            self.learn(self.pieces.missing([h for _, (h, _) in lines] + [_FIRST + t for _, (_, t) in lines]))
            end = self.library(["\n"])[0]
            self.pieces.update((p, self.pieces[h] + end + self.pieces[_FIRST + t]) for p, (h, t) in lines)
        elif lines:
            other += [p for p, _ in lines]
        if len(self.mark) != 1:
            simple, other = [], unseen
        lead = " " if self.spaces_stay else ""
        cores = list({c for _, c, _ in simple}.difference(self.pieces))
        for at in range(0, len(cores), 5_000):
            part = cores[at : at + 5_000]
            self.pieces.update(zip(part, self.plain([lead + c for c in part]), strict=True))
        tails = {t for _, _, t in simple if t}
        ends = dict(zip(tails, self.library(list(tails)), strict=True)) | {"": b""}
        for p, core, tail in simple:
            self.pieces[p] = self.pieces[core] + ends[tail]
        whole = [p[1:] if p[0] == _FIRST else lead + p for p in other]
        self.pieces.update(zip(other, self.library(whole), strict=True))

    def cut(self, text: str) -> list[str]:
        """Pieces of a chunk. Byte-level pieces stand for themselves with a space before them, but for one that opens with ``_FIRST``.

        A space between two other characters that aren't white space either is a safe
        join; around any other space both sides are one piece.
        """
        if not self.spaces_stay:
            return text.replace("\n", " ").split() if text.isascii() and not _CONTROL(text) else [p for p in text.replace("\n", " ").split(" ") if p]
        inner = text[1:] if text[0] == " " and len(text) > 1 else text
        out = inner.split(" ")
        if _LEANING(inner):
            parts, out, open_ = out, [], False
            for i, p in enumerate(parts):
                if i and (open_ or not p or p[0] in _BLANKS):
                    out[-1] += " " + p
                else:
                    out.append(p)
                open_ = not p or p[-1] in _BLANKS
        if inner is text:
            out[0] = _FIRST + out[0]
        return out

    def opened(self, chunk: str) -> tuple[str, str | None, str]:
        """A chunk before its first, between, and after its last safe place; without one all is head, and the middle None."""
        if not self.spaces_stay:
            first, last = chunk.find(" "), chunk.rfind(" ")
        else:
            found = _SAFE(chunk)
            first = last = found.start() if found else -1
            if found:
                last = chunk.rfind(" ")
                while not _SAFE_AT(chunk, last - 1):
                    last = chunk.rfind(" ", 0, last)
        return (chunk, None, "") if first < 0 else (chunk[:first], chunk[first:last], chunk[last:])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        # A zero character is kept from texts that are cut, as it marks pieces without a space before them.
        special = {i for i, t in enumerate(texts) if _FIRST in t or any(a in t for a in self.added)}
        plan = [[] if i in special else self.chunked(t) for i, t in enumerate(texts)]
        new = self.chunks.missing(set().union(*plan))
        self.encoded += len(new)
        self.reused += sum(map(len, plan)) - len(new)
        bodies = {}
        for c in new:
            head, body, tail = self.opened(c)
            bodies[c] = None if body is None else self.cut(body) if body else []
            self.chunks[c] = (head, None, tail)
        known = self.chunks.__getitem__
        # Of each text in turn: pieces of a span that is encoded anew, or a chunk whose middle is known.
        steps: list[list] = []
        for p in plan:
            made, open_ = [], ""
            for k, c in enumerate(p):
                head, ids, tail = known(c)
                open_ += head
                if ids is None and bodies.get(c) is None:
                    continue
                self.repairs += k > 0
                if open_:
                    made.append(self.cut(open_))
                made.append(c)
                open_ = tail
            if open_:
                made.append(self.cut(open_))
            steps.append(made)
        need = {x for pieces in bodies.values() if pieces for x in pieces}
        need.update(x for made in steps for step in made if type(step) is list for x in step)
        self.learn(self.pieces.missing(need))
        get = self.pieces.__getitem__
        for c, pieces in bodies.items():
            if pieces is not None:
                head, _, tail = known(c)
                self.chunks[c] = (head, b"".join(map(get, pieces)), tail)
        done = [b"".join([b"".join(map(get, x)) if type(x) is list else known(x)[1] for x in made]) for made in steps]
        for i in special:
            done[i] = self.library([texts[i]])[0]
        self.chunks.trim()
        self.pieces.trim()
        return done

    def chunked(self, text: str) -> list[str]:
        """Chunks of a text, cut where the rolling hash says so and a character begins."""
        raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
        at = np.flatnonzero((rolling_hash(raw) & np.uint32(CHUNK_MASK) == 0)[:-1]) + 1 if len(raw) > WINDOW else []
        if len(at) == 0:
            return [text] if text else []
        at = at[(raw[at] & 0xC0) != 0x80]
        if text.isascii():
            edges = [0, *at.tolist(), len(text)]
            return [text[a:b] for a, b in zip(edges, edges[1:], strict=False)]
        data = raw.tobytes()
        edges = [0, *at.tolist(), len(data)]
        return [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip(edges, edges[1:], strict=False)]

    def decode(self, ids: np.ndarray) -> str:
        """As ``Tokenizer.decode(ids, skip_special_tokens=False)``; a tokenizer without decoder joins token strings by spaces."""
        if self.tokenizer.decoder is not None:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False)
        if self.names is None:
            size = self.tokenizer.get_vocab_size(with_added_tokens=True)
            self.names = [self.tokenizer.id_to_token(i) for i in range(size)]
        return " ".join(map(self.names.__getitem__, ids.tolist()))


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Rows and texts of a batch in slices of about ``limit`` bytes, one row at least; null texts are empty."""
    texts = pc.fill_null(batch.column(column), "")
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield batch.slice(at, to - at), texts.slice(at, to - at).to_pylist()
        at = to


def _round_trip(rows: Iterator[pa.RecordBatch], path: str, spaces_stay: bool, full: bool) -> Iterator[pa.RecordBatch]:
    # Tables live as long as the task: workers that wait for their next task hold none.
    enc = ChunkEncoder(path, spaces_stay)
    for batch in rows:
        for part, texts in text_slices(batch):
            n, digest, decoded, ids, back = [], [], [], [], []
            for raw in enc.encode(texts):
                x = np.frombuffer(raw, "<u4")
                text = enc.decode(x)
                n.append(len(x))
                digest.append(hashlib.sha256(" ".join(map(str, x.tolist())).encode()).hexdigest())
                decoded.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
                if full:
                    ids.append(x.astype(np.int32))
                    back.append(text)
            cols = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(decoded, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if full:
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.string())]
                names += ["ids", "decoded"]
            yield pa.RecordBatch.from_arrays(cols, names)


def encode_decode(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text", spaces_stay: bool = False, full: bool = True) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_tokens, ids_sha256, decoded_sha256, and with ``full`` ids and decoded.

    The digests are of the decimal ids joined by one space and of the decoded text in
    UTF-8. Null texts count as empty and have no ids. Null ids, repeated rows and
    empty tables pass through; other columns are not read. Nothing is shuffled, and
    a text of any length is encoded whole.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded string" * full
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(releasing(_round_trip, path=path, spaces_stay=spaces_stay, full=full), schema)
