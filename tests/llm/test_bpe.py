import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from corpgraph.llm import bpe

SETS = [("word_bpe_49k.json", False), ("byte_bpe_50k.json", True)]
ODD = ["", " ", "a", "  two  spaces ", "tab\t x\n\n y \r\n z", "it's we'll  don't 'S", "x <|endoftext|> y", "<|startoftext|>", "é ́a ö̈", "日本語の文 章です " * 40, "Σας ΣΑΣ", "a b   c", "123 4,567.89", "#$% && ||", "no" * 3000, "\x1cx \x1d y", "\0a \0b c", "end ", "\n", "🙂 🙂🙂 ‍ x"]


def texts():
    r = random.Random(3)
    words = ["the", "Thondre,", "aún", "of", "x1y2", "end.\nNew", "\n", "", "don't", "—", "a" * 30, "\t", "été", " "]
    made = [" ".join(r.choice(words) for _ in range(r.randint(1, 900))) for _ in range(60)]
    passage = made[0] * 3
    return ODD + made + [m[: len(m) // 2] + " " + passage for m in made[:10]]


@pytest.mark.parametrize("name,stay", SETS)
def test_same_as_library(name, stay):
    path = public_tokenizers.path(name)
    tk, enc = Tokenizer.from_file(path), bpe.ChunkEncoder(path, stay)
    rows = texts()
    for _ in range(2):  # the second time from the tables
        for t, raw in zip(rows, enc.encode(rows), strict=True):
            ids = tk.encode(t, add_special_tokens=False).ids
            assert np.frombuffer(raw, "<u4").tolist() == ids, t[:80]
            assert enc.decode(np.frombuffer(raw, "<u4")) == tk.decode(ids, skip_special_tokens=False)


def test_small_tables_change_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "PIECES", 5)
    monkeypatch.setattr(bpe, "CHUNKS", 2)
    path = public_tokenizers.path("word_bpe_49k.json")
    small, rows = bpe.ChunkEncoder(path, False), texts()
    assert [small.encode([t])[0] for t in rows] == small.library(rows)


def test_query_columns(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    tk = Tokenizer.from_file(path)
    df = spark.createDataFrame([(1, "Hello there", 5), (2, None, 6), (2, "", None), (None, "x y", 1)], "doc_id long, text string, n_tokens int")
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.encode_decode(df, path).collect()}

    def row(i, t):
        ids = tk.encode(t, add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        return i, len(ids), sha(" ".join(map(str, ids))), sha(tk.decode(ids, skip_special_tokens=False))

    assert got == {row(1, "Hello there"), row(2, ""), row(None, "x y")}
    assert bpe.encode_decode(df.limit(0), path).count() == 0


@pytest.mark.parametrize("name,stay", SETS)
def test_chunks_are_shared_and_joins_repaired(name, stay):
    """Passages that many texts share, in Latin letters and without any spaces, at other places each time."""
    path = public_tokenizers.path(name)
    tk, enc, r = Tokenizer.from_file(path), bpe.ChunkEncoder(path, stay), random.Random(11)
    word = lambda: "".join(r.choice("abcdefgé") for _ in range(r.randint(1, 12)))
    passage = " ".join(word() for _ in range(2000))
    letters = [chr(c) for c in range(0x4E00, 0x4E60)]
    dense = "".join(r.choice(letters) for _ in range(3000))
    rows = [" ".join([word() for _ in range(r.randint(1, 40))]) + " " + (dense if i % 2 else passage) + word() * (i % 3) + " \t " * (i % 4) for i in range(12)]
    got = enc.encode(rows[:6]) + enc.encode(rows[6:])
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [tk.encode(t, add_special_tokens=False).ids for t in rows]
    assert enc.reused > 2 * enc.encoded  # the passages' chunks are cut alike in all texts
    assert enc.repairs > len(rows)
    assert any(enc.opened(c)[1] is None for t in rows for c in enc.chunked(t)) and any(enc.opened(c)[1] for t in rows for c in enc.chunked(t))
    assert all("".join(enc.chunked(t)) == t and "".join(x or "" for c in enc.chunked(t) for x in enc.opened(c)) == t for t in rows + texts())
    assert max(len(enc.chunks), len(enc.chunks.old)) <= bpe.CHUNKS + len(rows) * 40
