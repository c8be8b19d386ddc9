"""The pipeline's stages against plain versions, on a small corpus."""

import random

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from corpgraph.llm import mixing
from tests.llm.test_near_dedup import brute


def test_stages(spark, tmp_path):
    r = random.Random(12)
    words = [f"w{i}" for i in range(500)]
    docs = []
    for i in range(400):
        text = [r.choice(words) for _ in range(r.randint(30, 90))]
        bad = i % 5 == 0
        docs.append((i, " ".join(w.upper() + "!!" for w in text) if bad else " ".join(text), "en", f"s{i % 3}", 1))
    docs += [(500 + i, docs[i * 7 + 1][1], "en", "s0", 1) for i in range(20)]  # exact copies, two of them bad
    docs += [(600 + i, docs[i * 7 + 2][1] + " tail", "en", "s1", 1) for i in range(20)]  # near copies
    docs += [(700, None, None, None, None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    df = spark.createDataFrame(docs, schema)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 0 if i % 5 == 0 else 1, 0) for i in range(300)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))

    stages = dict(corpus_pipeline.STAGES)
    bad = {d[0] for d in docs if d[1] and "!!" in d[1]}
    one = stages["quality classifier"](spark, df, str(tmp_path))
    kept = {x.doc_id for x in one.collect()}
    assert one.columns == df.columns and not kept & bad
    assert len({d[0] for d in docs if d[1]} - bad - kept) <= 5

    two = stages["exact dedup"](spark, one, str(tmp_path))
    first = {}
    for d in sorted(x for x in docs if x[0] in kept):
        first.setdefault(d[1] or "", d[0])
    assert {x.doc_id for x in two.collect()} == set(first.values()) and two.columns == df.columns

    three = stages["near dedup"](spark, two, str(tmp_path))
    left = [(d[0], d[1]) for d in docs if d[0] in set(first.values())]
    lead = brute(left, 5, 80)
    assert {x.doc_id for x in three.collect()} == {i for i, _ in left if lead[i][1] == i} and three.columns == df.columns

    four = stages["mixing"](spark, three, str(tmp_path))
    took = {x.doc_id: int(x.taken / x["size"] + 0.5) for x in mixing.mix(three).collect() if x["size"]}
    count = {}
    for x in four.collect():
        count[x.doc_id] = count.get(x.doc_id, 0) + 1
    assert count == {i: n for i, n in took.items() if n} and four.columns == df.columns

    five = stages["bpe"](spark, four, str(tmp_path))
    tk, text = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), {d[0]: d[1] for d in docs}
    assert all(x.n_tokens == len(tk.encode(text[x.doc_id], add_special_tokens=False).ids) for x in five.collect())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == five.count()


def test_odd_rows_pass_all_stages(spark, tmp_path):
    """Null and repeated ids, null and empty texts, a clashing column: no stage fails or loses a row without a reason."""
    r = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    text = lambda: " ".join(r.choice(words) for _ in range(40))
    same, other = text(), text()
    rows = [(None, text(), "a"), (None, text(), None), (1, same, "a"), (1, same, "a"), (2, same.upper(), "b"), (None, same, "b"), (3, other, None), (3, text(), "b"), (4, None, "a"), (5, "", "a"), (6, " \n ", "b")]
    docs = spark.createDataFrame([(i, t, "en", s, 1, "x") for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long, component_id string")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    kept, seen = docs, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        seen.append(sorted((str(x.doc_id), x.text or "") for x in kept.collect()))
    every = sorted((str(i), t or "") for i, t, _ in rows)
    assert seen[0] == every
    gone = [("2", same.upper()), ("None", same), ("5", "")]  # 4, without a text, is equal to 5
    assert seen[1] == [x for x in every if x not in gone] and seen[2] == seen[1]
    assert seen[3] and set(seen[3]) <= {x for x in seen[2] if x[1].strip()}
    none = docs.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, str(tmp_path)).count() == 0, name
