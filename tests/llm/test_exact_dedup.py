import hashlib
import random

from pyspark.sql import functions as F

from corpgraph.llm import exact_dedup


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def rows():
    r = random.Random(2)
    pool = ["", None, "Hello", "hello", "É", "é", "x" * 9000, "X" * 9000, "a b", "a  b"] + [f"text {i}" for i in range(40)]
    return [(i, r.choice(pool)) for i in range(400)] + [(1000 + i, "hot copy") for i in range(300)]


def expected(docs, largest):
    groups = {}
    for i, t in docs:
        groups.setdefault(lower(t), []).append(i)
    return {(i, (max if largest else min)(groups[lower(t)]), len(groups[lower(t)]), hashlib.sha256(lower(t).encode()).hexdigest()) for i, t in docs}


def test_groups(spark):
    df = spark.createDataFrame([(i, t, 5) for i, t in rows()], "doc_id long, text string, keep_id int").repartition(5)
    for keep in ("smallest", "largest"):
        got = exact_dedup.exact_groups(df, keep=keep).collect()
        assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got} == expected(rows(), keep == "largest")
        assert all(r.kept == (r.doc_id == r.keep_id) for r in got) and len(got) == 700


def test_weak_digest_is_verified_by_text(spark):
    df = spark.createDataFrame(rows(), "doc_id long, text string").repartition(4)
    weak = lambda text: F.substring(exact_dedup.sha256(text), 1, 0)
    got = exact_dedup.exact_groups(df, digest=lambda t: F.encode(F.length(t).cast("string"), "UTF-8")).collect()
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got} == expected(rows(), False)
    assert exact_dedup.exact_groups(df, digest=weak).count() == 700


def test_null_ids_repeats_and_empty(spark):
    df = spark.createDataFrame([(None, "a"), (4, "A"), (4, "A"), (None, "z")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_groups(df).collect()), key=str)
    assert got == sorted([(None, 4, 3, False), (4, 4, 3, True), (4, 4, 3, True), (None, None, 1, True)], key=str)
    assert exact_dedup.exact_groups(df.limit(0)).count() == 0
    assert exact_dedup.drop_copies(df.where("doc_id = 4")).columns == ["doc_id", "text"]


def test_rows_go_by_id_and_text(spark):
    rows = [(1, "a"), (2, "A"), (2, "b"), (None, "a"), (None, "c"), (3, None), (4, ""), (3, None)]
    docs = spark.createDataFrame([(*r, "x", 9, "y") for r in rows], "doc_id long, text string, gone_id string, digest int, kept string")
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, "a"), (2, "b"), (None, "c"), (3, None), (3, None)], key=str)


def test_extreme_ids(spark):
    low, high = -(2**63), 2**63 - 1
    df = spark.createDataFrame([(low, "a"), (high, "A"), (0, "a"), (low, "b")], "doc_id long, text string")
    for keep, stays in (("smallest", low), ("largest", high)):
        got = {(r.doc_id, r.keep_id, r.group_size) for r in exact_dedup.exact_groups(df, keep=keep).collect()}
        assert got == {(low, stays, 3), (high, stays, 3), (0, stays, 3), (low, low, 1)}


def test_index_grows_by_batches_and_levels(spark, tmp_path):
    def log(pairs):
        return spark.createDataFrame(pairs, "doc_id long, text string").select("doc_id", exact_dedup.sha256(F.col("text")).alias("digest"))

    r = random.Random(8)
    seen, path = {}, f"{tmp_path}/index"
    for batch in range(9):
        pairs = [(batch * 100 + i, f"t{r.randrange(120)}") for i in range(60)]
        for i, t in pairs:
            seen.setdefault(t, []).append(i)
        index = exact_dedup.MergeIndex(spark, path)  # opened again for every batch
        index.add(log(pairs))
        index.compact()
    index = exact_dedup.MergeIndex(spark, path)
    assert [x.level for x in index.runs].count(0) == 1 and [x.level for x in index.runs].count(1) == 2
    asked = [f"t{i}" for i in range(0, 160, 2)]
    got = {bytes(x.digest): (x.first, x.last, x.copies) for x in index.look_up(log([(0, t) for t in asked])).collect()}
    assert got == {hashlib.sha256(t.encode()).digest(): (min(seen[t]), max(seen[t]), len(seen[t])) for t in asked if t in seen}
    index.compact(whole=True)
    assert len(index.runs) == 1 and index.entries().count() == len(seen) == index.runs[0].entries
    assert exact_dedup.MergeIndex(spark, f"{tmp_path}/none").look_up(log([(0, "x")])).count() == 0
