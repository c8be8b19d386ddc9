"""The candidate join against scoring every pair, and how its work grows."""

import random

import pytest
from pyspark.sql import functions as F

from corpgraph.functions.similarity import SCORERS
from corpgraph.operators import candidates, fuzzy

WORDS = "ACME GLOBEX INITECH UMBRELLA HOLDINGS CORP COMMITTEE PAC INC OF THE AMERICAN BANKERS ASSOCIATION A B C UNITED STATES FUND POLITICAL ACTION CO X1".split()


def sample(rng, n):
    out = []
    for _ in range(n):
        words = rng.choices(WORDS, k=rng.randint(1, 6))
        text = list(" ".join(words))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
            i = rng.randrange(len(text) + 1)
            rng.choice([lambda: text.insert(i, rng.choice("ABXZ ")), lambda: text.pop(i - 1) if text else None, lambda: text.reverse() if rng.random() < 0.02 else None])()
        out.append("".join(text).strip() or "Q")
    return out


def best_of(keys, choices, scorer, least):
    one, out = SCORERS[scorer], []
    for k in sorted(set(keys)):
        top = min(((-one(k, c), c) for c in set(choices)), default=(0, ""))
        if -top[0] >= least:
            out.append((k, top[1], -top[0]))
    return out


@pytest.mark.parametrize(("scorer", "least"), [("token_set", 90), ("token_set", 95), ("weighted", 85), ("weighted", 90), ("ratio", 85), ("ratio", 92)])
def test_best_match_equals_scoring_all(spark, monkeypatch, scorer, least):
    monkeypatch.setattr(candidates, "HOT_SIGNATURE", 20)
    rng = random.Random(f"{scorer}{least}")
    keys, choices = sample(rng, 250), sample(rng, 250)
    frames = [spark.createDataFrame([(x,) for x in xs + ["", None]], f"{c} string") for xs, c in ((keys, "k"), (choices, "c"))]
    got = sorted(map(tuple, fuzzy.best_match(*frames, "k", "c", scorer=scorer, at_least=least).collect()))
    assert got == best_of(keys, choices, scorer, least)


def test_all_matches_equals_scoring_all(spark):
    rng = random.Random(9)
    keys, choices = sample(rng, 150), sample(rng, 150)
    frames = [spark.createDataFrame([(x,) for x in xs], f"{c} string") for xs, c in ((keys, "k"), (choices, "c"))]
    got = sorted(map(tuple, fuzzy.all_matches(*frames, "k", "c", at_least=88).collect()))
    every = ((k, c, SCORERS["token_set"](k, c)) for k in set(keys) for c in set(choices))
    assert got == sorted(x for x in every if x[2] >= 88)


def test_pieces_dont_overlap_and_are_enough():
    for number in range(1, 9):
        made = candidates.pieces(["ACME", "HOLDINGS"], number, {"ACME": 0.5})
        assert len(made) == number and all(p in "ACME HOLDINGS" for p in made) and sum(map(len, made)) <= 12
        assert "ACME" not in made


def test_work_grows_with_the_names_not_with_their_product(spark):
    def pairs(n):
        rng = random.Random(n)
        word = lambda: "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ", k=rng.randint(5, 9)))
        frames = [spark.createDataFrame([(f"{word()} {word()} {word()} PAC",) for _ in range(n)], "k string") for _ in "ab"]
        shares = candidates.common_words(*frames)
        return candidates.candidates(*[candidates.cut(f, 90, False, shares) for f in frames], "token_set", 90).count()

    few, many = pairs(400), pairs(1600)
    assert few < 0.08 * 400 * 400 and many < 0.08 * 1600 * 1600  # all pairs would be 2,560,000


def test_no_block_pairs_in_the_plan(spark):
    df = spark.range(50).select(F.format_string("NAME %d", "id").alias("k"))
    plan = fuzzy.best_match(df, df, "k", "k", at_least=90)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInPandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
