import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpgraph.llm import batches, bpe, huffman, token_store
from corpgraph.llm.word_table import WordTable
from corpgraph.llm.work import WorkArea
from tests.llm.test_bpe import texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 40), max_size=1500), st.integers(6, 16))
def test_code_round_trip(ids, limit):
    x = np.array(ids, np.int64)
    lengths = huffman.code_lengths(np.bincount(x, minlength=3), limit)
    assert lengths.max(initial=0) <= max(limit, 6)
    assert sum(2.0 ** -int(n) for n in lengths if n) <= 1
    code = huffman.Code(lengths)
    parts = [x[: len(x) // 3], x[len(x) // 3 :], x[:0]]
    coded = [code.encode(p) for p in parts]
    back = code.decode([c[0] for c in coded], [c[1] for c in coded], [len(p) for p in parts])
    assert [b.tolist() for b in back] == [p.tolist() for p in parts]


def test_lengths_are_huffmans_when_unlimited():
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21, 0, 34])
    assert huffman.code_lengths(counts, 16).tolist() == [8, 8, 7, 6, 5, 4, 3, 2, 0, 1]
    assert huffman.code_lengths(counts, 4).max() == 4


def test_store_equals_library(spark, monkeypatch):
    monkeypatch.setattr(token_store, "BLOCK_TOKENS", 700)
    rows = [(i * 3, t) for i, t in enumerate(texts())] + [(2, None), (2, "twice"), (None, "no id")]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, t, 9) for i, t in rows], "doc_id long, text string, start int").repartition(5)
    out = WorkArea(spark, "test").path
    token_store.write_tokens(df, out, PATH)
    got = token_store.read_tokens(spark, out).collect()
    tk, start, want = Tokenizer.from_file(PATH), 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        raw = np.array([*tk.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        want.append((i, start, len(raw) // 4, zlib.crc32(raw)))
        start += len(raw) // 4
    assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(bytes(r.ids))) for r in got), key=lambda r: r[1]) == want
    token_store.write_tokens(df.limit(0), out + "-none", PATH)
    assert token_store.read_tokens(spark, out + "-none").count() == 0


def encoded(table, rows):
    raw = np.frombuffer("".join(rows).encode(), np.uint8)
    ids, counts = table.encode(raw, np.append(0, np.cumsum([len(t.encode()) for t in rows])))
    return [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]


def test_words_that_share_a_hash_keep_their_own_ids(monkeypatch):
    """With two-bit hashes nearly all words clash."""
    tk, rows = Tokenizer.from_file(PATH), ["one two three", "four one five", "six\nseven eight, nine", "ab ba"]
    plain = batches.Words.hashes
    monkeypatch.setattr(batches.Words, "hashes", lambda self, *a: plain(self, *a) & np.uint64(3))
    table = WordTable(bpe.ChunkEncoder(PATH, True))
    for _ in range(2):
        assert encoded(table, rows) == [tk.encode(t, add_special_tokens=False).ids for t in rows]


def test_other_tokenizers_are_not_cut_into_words():
    path = public_tokenizers.path("word_bpe_49k.json")
    tk, rows = Tokenizer.from_file(path), ["One two  three", "four\none", "ü É 漢字 [UNK] <unk>"]
    tk.no_padding()
    tk.no_truncation()
    assert encoded(WordTable(bpe.ChunkEncoder(path, True)), rows) == [tk.encode(t, add_special_tokens=False).ids for t in rows]
