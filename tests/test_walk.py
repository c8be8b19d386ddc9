"""The prefix-tree walk against comparing every choice, and how many choices it scores."""

import random

import numpy as np

from corpgraph.functions.similarity import common_subsequence, weighted_ratio
from corpgraph.operators import fuzzy, walk


def test_near_equals_comparing_all():
    rng = random.Random(3)
    texts = {"".join(rng.choices("ab c", k=rng.randint(0, 9))) for _ in range(300)} - {""}
    tree, need = walk.Tree(texts), np.array([max(1, m - 2) for m in range(10)])
    for key in ["abcab", "a", "ccc ab", "abababab"]:
        at, common = tree.near(key, need)
        got = {tree.texts[i]: int(c) for i, c in zip(at, common, strict=True)}
        assert got == {t: c for t in texts if (c := common_subsequence(key, t)) >= need[len(t)]}


def test_names_that_differ_in_one_rare_word_are_not_all_scored(monkeypatch):
    letters = lambda n: str(n).translate(str.maketrans("0123456789", "abcdefghij"))
    names = [f"energy {letters(n)} partners" for n in range(10_000, 13_000)]
    block, scored = walk.Block(names, names, 0, 1), []
    monkeypatch.setattr(walk, "weighted_ratio", lambda a, b: scored.append(b) or weighted_ratio(a, b))
    keys = [f"energies {letters(12_345)} partner", "qqqqqq bcdef zzzzzz"]
    got = [block.best(k, k, 85) for k in keys]
    assert got == [(f"energy {letters(12_345)} partners", weighted_ratio(keys[0], f"energy {letters(12_345)} partners")), None]
    assert len(scored) < 30


def test_a_score_beyond_100_needs_no_pairs(spark):
    df = spark.range(50).selectExpr("concat('NAME ', id) AS k")
    best = fuzzy.best_match(df, df, "k", "k", at_least=101)
    assert best.columns == ["k", "best_norm", "fuzzy_score"] and best.count() == 0
    assert "InPandas" not in best._jdf.queryExecution().toString()
