import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from corpgraph.llm import lm

WORD = re.compile("[^\x20\x09-\x0d]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus(n=2500):
    r = random.Random(6)
    tongues = [[f"{p}{i}{s}" for i in range(120)] for p, s in (("a", "tion"), ("ü", "ung"), ("é", "ment"))]
    rows = []
    for i in range(n):
        tongue = r.choice(tongues)
        rows.append((i, " ".join(tongue[min(int(r.expovariate(0.05)), 119)] for _ in range(r.randint(5, 60)))))
    return rows + [(n, None), (n + 1, ""), (n + 2, "Never-Seen WORDS only"), (n + 2, "Never-Seen WORDS only"), (n + 3, "x" * 50000)]


def test_base_and_gain(spark, monkeypatch):
    monkeypatch.setattr(lm, "TABLE_WORDS", 150)  # so that rare words' counts are joined
    monkeypatch.setattr(lm, "STEP_TOKENS", 128)  # a small corpus, so small steps
    rows = corpus()
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    c = Counter(w for i, t in rows if not held(i) for w in [*words_of(t), None])
    n, v = sum(c.values()), len(c)
    df = spark.createDataFrame([(i, t, 1.0) for i, t in rows], "doc_id long, text string, score double").repartition(3)
    got = {r.doc_id: r for r in lm.lm_scores(df).collect()}
    for i, t in rows:
        w, r = [*words_of(t), None], got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(c[x] > 0 for x in w), n)
        assert math.isclose(r.base_score, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), rel_tol=1e-9)
        assert r.score < 0
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > 0.95 * sum(r.base_score for r in out)


def test_probabilities_sum_to_one():
    share = np.random.default_rng(1).random(lm.UNITS)
    share /= share.sum()
    m = lm.Model(share)
    ctx = np.tile(np.array([[3, 5, 250, lm.END_UNIT]], np.int32), (lm.UNITS, 1))
    assert math.isclose((10 ** m.log10_probabilities(ctx, np.arange(lm.UNITS))).sum(), 1, rel_tol=1e-4)


def test_training_prefers_what_follows():
    share = np.full(lm.UNITS, 1 / lm.UNITS)
    m = lm.Model(share.copy())
    t = lm.Trainer(m, 1)
    unit = np.tile(np.arange(8), 500)
    ctx = lm.contexts(unit, np.array([0, len(unit)]))
    before = m.log10_probabilities(ctx, unit).mean()
    for _ in range(100):
        t.step(ctx[:1000], unit[:1000])
    assert m.log10_probabilities(ctx, unit).mean() > before + 1


def test_empty(spark):
    df = spark.createDataFrame([(2, "a b")], "doc_id long, text string")
    assert lm.lm_scores(df.limit(0)).count() == 0
    alone = [i for i in range(50) if zlib.crc32(str(i).encode()) % 7 == 2][0]
    r = lm.lm_scores(spark.createDataFrame([(alone, "a b")], "doc_id long, text string")).first()
    assert (r.train_tokens, r.n_known, r.score) == (0, 0, r.base_score)


def test_scores_do_not_follow_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "COPY_TOKENS", 60_000)  # so that a small corpus has several copies
    df = spark.createDataFrame(corpus(6000), "doc_id long, text string")
    one, many = ({r.doc_id: r for r in lm.lm_scores(df.repartition(n)).collect()} for n in (1, 200))
    assert all(math.isclose(r.score, many[i].score, rel_tol=1e-4) for i, r in one.items())
    out = [r for r in many.values() if r.held_out]
    assert sum(r.score for r in out) > 0.95 * sum(r.base_score for r in out)
