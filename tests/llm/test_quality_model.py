import math
import random
import re
import tracemalloc

import numpy as np

from corpgraph.llm import batches
from corpgraph.llm import quality_model as q


def corpus(n, seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(n):
        text = [r.choice(words) for _ in range(r.randint(20, 120))]
        grade = 2
        if r.random() < 0.2:
            text[r.randrange(len(text))] = r.choice(["vileword", "nastyword"])
            grade = 1
        if r.random() < 0.2:
            text = [t.upper() + "!!" for t in text]
            grade = 0
        rows.append((i, " ".join(text), grade))
    return rows


def test_held_out_accuracy_and_thresholds(spark):
    rows = corpus(3000, 1)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, kept string").repartition(4)
    grades = spark.createDataFrame([(i, g) for i, _, g in rows if i < 2000], "doc_id long, grade int")
    model = q.fit(docs, grades)
    assert (np.diff(model.thresholds) >= 0).all()
    assert np.allclose(model.grades(np.array([-3.0, 0.0, 9.0])).sum(axis=1), 1)
    got = {r.doc_id: r for r in q.score(docs, model).collect()}
    held = [(got[i], g) for i, _, g in rows if i >= 2000]
    assert sum(x.kept == (g == 2) for x, g in held) / len(held) > 0.95
    mean = [np.mean([x.expected_grade for x, h in held if h == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]
    again = q.fit(docs.repartition(7), grades)
    assert np.array_equal(model.weights, again.weights)


def test_edge_rows(spark):
    df = spark.createDataFrame([(1, None, 1), (None, "a b", 2), (3, "", 3), (3, "", 3), (4, "x" * 100000, 4)], "doc_id long, text string, grade int")
    labels = spark.createDataFrame([(1, 1, 0), (3, None, 1), (4, 0, 1)], "doc_id long, quality int, toxic int")
    model = q.fit(df, q.graded(labels))
    assert q.score(df, model).count() == 5
    assert q.fit(df, q.graded(labels.limit(0))) is None
    assert all(r.kept and r.expected_grade is None for r in q.score(df, None).collect())
    assert q.keep_good(df, None).columns == df.columns
    assert q.score(df.limit(0), model).count() == 0


def plain_features(text):
    """Feature numbers of one text, word by word."""
    t = text or ""
    words = re.findall("[^\x20\x09-\x0d]+", t)
    low = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]

    def number(data):
        raw = np.frombuffer(data, np.uint8)
        w = batches.Words(raw, np.array([0, len(raw)]), lower=False)
        return int(w.hashes(np.array([0]), np.array([len(raw)]))[0])

    size = q.BUCKETS // 4
    own = {number(w.encode()) % (3 * size) for w in low}
    ends = {3 * size + number(w.encode()[-2:]) % (size - 64) for w in words}
    share = min(len(own) * 16 // max(len(words), 1), 15)
    return own | ends | {q.BUCKETS - 64 + share, q.BUCKETS - 32 + min(int(np.log2(len(words) + 1)), 31)}


def test_scores_equal_brute_force(spark):
    rows = corpus(300, 5) + [(900, None, 2), (901, "", 2), (902, "x " * 3000, 0)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string").repartition(3)
    model = q.fit(docs, spark.createDataFrame([(i, g) for i, _, g in rows], "doc_id long, grade int"))
    got = {r.doc_id: r for r in q.score(docs, model).collect()}
    for i, t, _ in rows:
        value = sum(float(model.weights[f]) for f in plain_features(t))
        below = [1 / (1 + math.exp(value - c)) for c in model.thresholds]
        assert abs(got[i].tail_probability - (1 - below[1])) < 1e-6
        assert abs(got[i].expected_grade - ((below[1] - below[0]) + 2 * (1 - below[1]))) < 1e-6
        assert got[i].kept == (got[i].tail_probability >= 0.5)


def test_fit_climbs_the_likelihood():
    """Against the likelihood written out: the fitted model beats grade shares alone, and thresholds can hardly better it."""
    sample = [(g, np.array(sorted(plain_features(t)), np.int32)) for _, t, g in corpus(600, 7)]
    model = q.fit_rows(sample, 3)

    def loss(thresholds, weights):
        total = 0.0
        for g, x in sample:
            v = float(np.sum(weights[x], dtype=np.float64))
            edges = [0.0, *[1 / (1 + math.exp(v - c)) for c in thresholds], 1.0]
            total -= math.log(max(edges[g + 1] - edges[g], 1e-12))
        return total / len(sample)

    share = np.cumsum(np.bincount([g for g, _ in sample]))[:-1] / len(sample)
    fitted = loss(model.thresholds, model.weights)
    assert fitted < 0.5 * loss(np.log(share / (1 - share)), np.zeros(q.BUCKETS))
    for step in ([0.2, 0], [-0.2, 0], [0, 0.2], [0, -0.2]):
        assert loss(model.thresholds + np.array(step), model.weights) > fitted - 0.02


def test_sample_is_bounded_in_bytes(spark):
    rows = corpus(400, 3)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    grades = spark.createDataFrame([(i, g) for i, _, g in rows], "doc_id long, grade int")
    few, same = q.fit(docs, grades, most_bytes=20_000), q.fit(docs.repartition(5), grades, most_bytes=20_000)
    assert np.array_equal(few.weights, same.weights) and not np.array_equal(few.weights, q.fit(docs, grades).weights)


def test_fit_needs_little_beside_its_rows():
    rng = np.random.default_rng(3)
    # Distinct features of each row, as features() gives them.
    rows = [(i % 3, (rng.permutation(q.BUCKETS // 64)[:2000] * 64 + i % 64).astype(np.int32)) for i in range(4000)]
    size = sum(x.nbytes for _, x in rows)
    tracemalloc.start()
    q.fit_rows(rows, 3)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * size, (peak, size)


def test_fit_releases_the_drivers_memory(spark, monkeypatch):
    released = []
    monkeypatch.setattr(q, "release", lambda: released.append(True))
    docs = spark.createDataFrame([(i, f"w{i}") for i in range(8)], "doc_id long, text string")
    q.fit(docs, spark.createDataFrame([(i, i % 3) for i in range(8)], "doc_id long, grade int"))
    assert released


def test_the_sample_keeps_its_bounds_where_ids_repeat(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(q, "fit_rows", lambda rows, levels: seen.append(len(rows)))
    docs = spark.createDataFrame([(i % 100, f"text {i} " + "x" * 90) for i in range(4000)], "doc_id long, text string")
    grades = spark.createDataFrame([(i, i % 3) for i in range(100)], "doc_id long, grade int")
    for rows, size, want in ((90, 1 << 30, 90), (401, 1 << 30, 401), (5000, 1 << 30, 4000), (5000, 100_000, None)):
        q.fit(docs, grades, most_rows=rows, most_bytes=size)
        got = seen.pop()
        assert got == want if want else 100_000 // 101 <= got <= 100_000 // 97
