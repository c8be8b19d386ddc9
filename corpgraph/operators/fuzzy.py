"""Fuzzy best match and all matches, exact.

From ``candidates.LEAST_SCORE`` on, keys meet the choices that share a signature with them
(``candidates``). Below it, and for names with too few letters for it, every key
meets every choice in blocks, pruned by exact upper bounds.

A block's choices are held as numpy arrays: character counts, lengths, and postings
of their tokens. For a key, an upper bound of its score with each choice comes out of
a few array operations; only choices whose bound reaches the threshold and the best
score so far are scored, best bounds first. Nothing that could win is left out.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.functions.similarity import SCORERS
from corpgraph.operators import candidates, walk

#: Choices and keys of one block; each block of keys meets each block of choices in one task.
BLOCK_CHOICES, BLOCK_KEYS = 20_000, 2_000
#: Characters with a counter of their own are told apart by their code modulo this, which only loosens the bounds.
COUNTERS = 48
_SLACK = 1e-9


def _counts(texts: list[str]) -> np.ndarray:
    out = np.zeros((len(texts), COUNTERS), np.int16)
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32) % COUNTERS
    np.add.at(out, (rows, codes), 1)
    return out


class Choices:
    """A block of distinct choices in order."""

    def __init__(self, names: Iterable[str]):
        self.names = sorted(names)
        self.sets = [sorted(set(n.split())) for n in self.names]
        self.length = np.array([len(n) for n in self.names])
        self.joined = np.array([len(" ".join(s)) for s in self.sets])
        self.counts = _counts(self.names)
        #: Counts of the distinct tokens joined; those of the names where no token repeats.
        self.set_counts = _counts([" ".join(s) for s in self.sets])
        self.tokens = np.array([len(s) for s in self.sets])
        postings: dict[str, list[int]] = {}
        for i, s in enumerate(self.sets):
            for t in s:
                postings.setdefault(t, []).append(i)
        self.postings = {t: np.array(rows) for t, rows in postings.items()}

    def shared(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Characters (joined by spaces) and number of the tokens that each choice shares."""
        chars, number = np.zeros(len(self.names), np.int64), np.zeros(len(self.names), np.int64)
        for t in tokens:
            rows = self.postings.get(t)
            if rows is not None:
                chars[rows] += len(t) + 1
                number[rows] += 1
        return np.maximum(chars - 1, 0), number

    def token_set_bound(self, key: str) -> np.ndarray:
        tokens = sorted(set(key.split()))
        if not tokens:
            return np.zeros(len(self.names))
        both, number = self.shared(tokens)
        joined = " ".join(tokens)
        n, m = len(joined), self.joined
        gap = number > 0
        left, right = n - both - gap, m - both - gap
        common = np.minimum(np.minimum(_counts([joined])[0], self.set_counts).sum(axis=1) - both - gap, np.minimum(left, right))
        out = 100 - 100 * (left + right - 2 * np.maximum(common, 0)) / np.maximum(n + m, 1)
        out = np.maximum(out, np.where(gap, 200 * both / np.maximum(both + np.minimum(n, m), 1), 0))
        out[gap & ((number == len(tokens)) | (number == self.tokens))] = 100
        out[self.tokens == 0] = 0
        return out

    def ratio_bound(self, key: str) -> np.ndarray:
        common = np.minimum(_counts([key])[0], self.counts).sum(axis=1)
        return np.where(self.length + len(key) > 0, 200 * common / np.maximum(self.length + len(key), 1), 100)

    def weighted_bound(self, key: str) -> np.ndarray:
        if not key:
            return np.zeros(len(self.names))
        n, m = len(key), self.length
        short, long_ = np.minimum(n, m), np.maximum(n, m)
        length = long_ / np.maximum(short, 1)
        whole = self.ratio_bound(key)
        common = np.minimum(_counts([key])[0], self.counts).sum(axis=1)
        part = 200 * common / np.maximum(short + common, 1)
        _, number = self.shared(sorted(set(key.split())))
        near = np.maximum(whole, 0.95 * self.token_set_bound(key))
        scale = np.where(length <= 8, 0.9, 0.6)
        # Without a shared token, a stretch of one's tokens against the other's: characters in common bound it too.
        far = np.maximum(whole, np.maximum(scale * part, 0.95 * scale * np.where(number > 0, 100, part)))
        out = np.where(length < 1.5, near, np.minimum(far, 100))
        # Repeated tokens and spaces change the lengths that these bounds are made of.
        out[(self.joined != m) | (len(" ".join(sorted(set(key.split())))) != n)] = 100
        return np.where(m == 0, 0, out)

    def _bound(self, key: str, scorer: str) -> np.ndarray:
        return {"token_set": self.token_set_bound, "weighted": self.weighted_bound, "ratio": self.ratio_bound}[scorer](key)

    def best(self, key: str, scorer: str, at_least: float) -> tuple[str, float] | None:
        """The choice with the highest score of ``at_least`` or more; the first of equals."""
        if not self.names:
            return None
        score, bound = SCORERS[scorer], self._bound(key, scorer)
        maybe = np.flatnonzero(bound >= at_least - _SLACK)
        found = (-1.0, -1)
        for i in maybe[np.lexsort((maybe, -bound[maybe]))]:
            if bound[i] < found[0] - _SLACK:
                break
            if bound[i] <= found[0] and i > found[1]:
                continue
            s = score(key, self.names[i])
            if s >= at_least and (s > found[0] or (s == found[0] and i < found[1])):
                found = (s, int(i))
        return None if found[1] < 0 else (self.names[found[1]], found[0])

    def every(self, key: str, scorer: str, at_least: float) -> list[tuple[str, float]]:
        """All choices that score ``at_least``, in order."""
        if not self.names:
            return []
        scored = [(self.names[i], SCORERS[scorer](key, self.names[i])) for i in np.flatnonzero(self._bound(key, scorer) >= at_least - _SLACK)]
        return [(n, s) for n, s in scored if s >= at_least]


def _in_blocks(keys: DataFrame, choices: DataFrame, pick) -> DataFrame:
    """k, best, score: what ``pick(block, key)`` finds for each key in each block of choices."""
    n_keys, n_choices = keys.count(), choices.count()
    rows, cols = max(1, -(-n_keys // BLOCK_KEYS)), max(1, -(-n_choices // BLOCK_CHOICES))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    asked = keys.select("k", F.pmod(F.xxhash64("k"), F.lit(rows)).alias("r"), every(cols).alias("c"))
    held = choices.select("k", F.pmod(F.xxhash64("k"), F.lit(cols)).alias("c"), every(rows).alias("r"))

    def match(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        block = Choices(b.k)
        return pd.DataFrame([(k, *f) for k in a.k for f in pick(block, k)], columns=["k", "best", "score"])

    return asked.groupBy("r", "c").cogroup(held.groupBy("r", "c")).applyInPandas(match, "k string, best string, score double")


def _scored(left: DataFrame, right: DataFrame, left_key: str, right_key: str, scorer: str, at_least: float, pick) -> DataFrame:
    """k, best, score of all pairs of distinct non-blank names that can matter."""
    keys, choices = candidates.names(left, left_key), candidates.names(right, right_key)
    if at_least < candidates.LEAST_SCORE:
        return _in_blocks(keys, choices, pick)
    keys, choices = keys.persist(), choices.persist()  # each is read three times
    shares = candidates.common_words(keys, choices)
    keys, choices = (candidates.cut(x, at_least, scorer == "weighted", shares).persist() for x in (keys, choices))
    wide = keys.where("not cut").select("k")
    none = wide.isEmpty()
    if none and left is right and left_key == right_key and scorer != "weighted":
        once = candidates.scored(candidates.candidates(keys, keys, scorer, at_least, same=True), scorer, at_least)
        both = F.explode(F.array(F.struct("k", "best", "score"), F.struct(F.col("best").alias("k"), F.col("k").alias("best"), "score")))
        itself = keys.select("k", F.col("k").alias("best"), F.lit(100.0).alias("score")).where(F.col("score") >= at_least)
        return once.select(both.alias("m")).select("m.*").unionByName(itself)
    found = candidates.scored(candidates.candidates(keys.where("cut"), choices, scorer, at_least), scorer, at_least)
    return found if none else found.unionByName(_in_blocks(wide, choices.select("k"), pick))


def _weighted(left: DataFrame, right: DataFrame, left_key: str, right_key: str, at_least: float, pick) -> DataFrame:
    """k, best, score of each key's best choices: equal ones (only they score 100), else those by words, then what ``walk`` finds beyond."""
    keys, choices = candidates.names(left, left_key), candidates.names(right, right_key)
    equal = keys.join(choices, "k", "left_semi").select("k", F.col("k").alias("best"), F.lit(100.0).alias("score"))
    shares = candidates.common_words(keys, choices)
    keys = keys.join(choices, "k", "left_anti")
    keys, choices = (candidates.cut(x, at_least, True, shares).persist() for x in (keys, choices))
    few = keys.where("cut")
    pairs = candidates.candidates(few, choices, "weighted", at_least, near_too=False).select("a", "b")
    pairs = pairs.unionByName(candidates.by_rare_words(few, choices, shares)).distinct().withColumn("sure", F.lit(True))
    found = candidates.scored(pairs, "weighted", at_least).persist()
    floors = few.select("k").join(found.groupBy("k").agg(F.max("score").alias("floor")), "k", "left")
    out = equal.unionByName(found).unionByName(walk.near_best(floors, choices.select("k"), shares, at_least))
    wide, long_ = keys.where("not cut").select("k").unionByName(walk.too_many(few.select("k"), shares)).distinct(), walk.too_many(choices.select("k"), shares)
    if not wide.isEmpty():
        out = out.unionByName(_in_blocks(wide, choices.select("k"), pick))
    return out if long_.isEmpty() else out.unionByName(_in_blocks(keys.select("k"), long_, pick))


def all_matches(left: DataFrame, right: DataFrame, left_key: str, right_key: str, *, scorer: str = "token_set", at_least: float) -> DataFrame:
    """left_key, match, fuzzy_score: every pair of distinct non-blank keys that scores ``at_least``."""
    if scorer == "weighted":
        raise ValueError("a common word alone matches most pairs by the weighted score: ask for the best match")
    found = _scored(left, right, left_key, right_key, scorer, at_least, lambda block, k: block.every(k, scorer, at_least))
    return found.select(F.col("k").alias(left_key), F.col("best").alias("match"), F.col("score").alias("fuzzy_score"))


def best_match(left: DataFrame, right: DataFrame, left_key: str, right_key: str, *, scorer: str = "token_set", at_least: float = 0.0) -> DataFrame:
    """left_key, best_norm, fuzzy_score of each distinct non-blank ``left_key`` that has a ``right_key`` scoring ``at_least``; ties go to the first in order.

    With ``at_least`` 0 every key gets its best choice, and hardly anything is pruned:
    both sides are dealt to blocks by hash, and a task holds one block of each.
    """

    def pick(block: Choices, key: str) -> list[tuple[str, float]]:
        found = block.best(key, scorer, at_least)
        return [found] if found else []

    if at_least > 100:  # no score is
        return left.select(F.col(left_key).cast("string").alias(left_key), F.lit(None).cast("string").alias("best_norm"), F.lit(None).cast("double").alias("fuzzy_score")).where("false")
    if scorer == "weighted" and at_least >= candidates.LEAST_SCORE:
        scored = _weighted(left, right, left_key, right_key, at_least, pick)
    else:
        scored = _scored(left, right, left_key, right_key, scorer, at_least, pick)
    best = scored.groupBy("k").agg(F.min(F.struct((-F.col("score")).alias("s"), F.col("best").alias("best"))).alias("m"))
    return best.select(F.col("k").alias(left_key), F.col("m.best").alias("best_norm"), (-F.col("m.s")).alias("fuzzy_score"))
