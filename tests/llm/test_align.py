"""Cross-tokenizer alignment against both libraries and a plain loop over byte offsets."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from corpgraph.llm import align

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Plain words, and more of them: don't stop.", "", None, " leading and trailing  ", "two  spaces\n\nand\tlines\r\n ok", "déjà vu über naïveté 日本語 🙂🙂",
    "<|endoftext|> is text <s> </s> <0x41> <unk>", "a▁b has their mark", "x ▁y", "\x00\x01\x7f  z", "ﬁ ligature é", "x" * 5000, "again again again", "Plain words, and more of them: don't stop.", " ", "\n", "1234567890 00 12",
]


def brute(texts):
    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    back = {c: b for b, c in align._byte_names().items()}
    rows = []
    for t in texts:
        ids_a, ids_b = (tok.encode(" " + t, add_special_tokens=False).ids, sp.encode(t)) if t else ([], [])
        raw_a = [bytes(back[c] for c in tok.id_to_token(i)) for i in ids_a]
        raw_b = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if not t or b"".join(raw_a) != (" " + t).encode() or b"".join(raw_b) != (" " + t).encode():
            rows.append(([], [], [], []))
            continue
        at_a, at_b = np.cumsum([len(x) for x in raw_a]).tolist(), np.cumsum([len(x) for x in raw_b]).tolist()
        groups, links, i, j = [], [], 0, 0
        for cut in sorted(set(at_a) & set(at_b)):
            x, y = range(i, at_a.index(cut, i) + 1), range(j, at_b.index(cut, j) + 1)
            groups.append(",".join(str(ids_a[k]) for k in x) + "|" + ",".join(str(ids_b[k]) for k in y))
            links += [(ids_a[p], ids_b[q]) for p in x for q in y if at_a[p] == at_b[q]]
            i, j = i + len(x), j + len(y)
        rows.append((ids_a, ids_b, groups, links))
    count = Counter(x for r in rows for x in r[3])
    most = {}
    for (_, b), n in count.items():
        most[b] = max(most.get(b, 0), n)
    return [
        (len(a), len(b), len(g), len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for a, b, g, links in rows
    ]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@pytest.mark.parametrize("table_pairs", [align.TABLE_PAIRS, 5, 0])
def test_equals_brute_force(spark, table_pairs):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, links string").repartition(3)
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align.align(docs, A, B, full=False, table_pairs=table_pairs).collect()}
    assert [got[i] for i in range(len(TEXTS))] == brute(TEXTS)


def test_whole_texts_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align.align(docs, A, B, full=False).collect()}
    assert [got[r.doc_id] for r in rows] == brute([r.text for r in rows])


def test_full_output_cuts_the_bytes(spark):
    docs = spark.createDataFrame([("k1", "Some façade — twice"), (None, "ab"), ("k1", "Some façade — twice")], "doc_id string, text string")
    both = align.Pair(A, B)
    rows = align.align(docs, A, B).collect()
    assert sorted((r.doc_id or "") for r in rows) == ["", "k1", "k1"]
    for r in rows:
        raw = b"".join(both.a_bytes[i] for i in r.a_ids)
        assert raw == b"".join(both.b_bytes[i] for i in r.b_ids) and r.byte_to[-1] == len(raw)
        for x, y, z in zip(r.a_to, r.b_to, r.byte_to, strict=True):
            assert b"".join(both.a_bytes[i] for i in r.a_ids[:x]) == b"".join(both.b_bytes[i] for i in r.b_ids[:y]) == raw[:z]


def test_empty_table(spark):
    assert align.align(spark.createDataFrame([], "doc_id long, text string"), A, B, full=False).collect() == []


def test_rank_and_select():
    rng = np.random.default_rng(5)
    for size in (0, 1, 63, 64, 65, 1000):
        places = np.flatnonzero(rng.random(size) < 0.3)
        bits = align.BitSet.of(places, size)
        assert bits.select().tolist() == places.tolist()
        assert bits.rank(np.arange(size + 1)).tolist() == [int((places < p).sum()) for p in range(size + 1)]
