"""The best match by the weighted score where lengths are alike: prefixes that choices share are compared with a key once.

Names of less than 1.5 times each other's length score by whole strings, by sorted words, or by
sets of words. Each is a longest common subsequence (LCS) of two texts beside ``own``
characters that both have anyway, so names meet as texts under a ``tag``:

* ``raw``: the names; ``sorted``: their words in order, and their distinct words in order.
* For every set of common words in a name, the set; the text is the name's other words, and ``own``
  the set's length and a space. Pairs that share a rarer word meet by that word (``candidates``).

The choices of a tag are dealt to blocks, and held as a prefix tree for each length. A key goes down
the trees level by level with the rows of the LCS table of all prefixes that are left; a prefix
goes when what it has and what could still come don't reach the score. The score asked is
high at first and falls to the best known one, so a key with a near choice never sees the rest.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.functions.similarity import weighted_ratio

#: Texts of choices and of keys in one task.
BLOCK_CHOICES, BLOCK_KEYS = 500_000, 2_000
#: Names with more common words than this have too many sets of them.
MOST_COMMON = 8
#: Scores asked one after the other.
STEPS = (97, 94, 91, 88)
_EPS = 1e-9


def _codes(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


class Tree:
    """Distinct texts as a prefix tree of each length, all walked together."""

    def __init__(self, texts: Iterable[str]):
        self.texts = sorted(set(texts), key=lambda t: (len(t), t))
        sizes = np.array([len(t) for t in self.texts])
        self.lengths = np.unique(sizes)
        deepest = int(self.lengths[-1]) if len(sizes) else 0
        parts: list[list[tuple]] = [[] for _ in range(deepest + 1)]  # char, length, first text, first child, end of children
        counts = np.zeros(deepest + 2, np.int64)
        for m in map(int, self.lengths):
            lo, hi = np.searchsorted(sizes, m), np.searchsorted(sizes, m, side="right")
            codes = _codes(self.texts[lo:hi]).reshape(hi - lo, m)
            differ = codes[1:] != codes[:-1]
            fresh = np.append(-1, np.argmax(differ, axis=1)) if m else np.array([-1])
            starts = np.zeros(1, np.int64)
            chars = np.zeros(1, np.uint32)
            for level in range(m + 1):
                below = np.flatnonzero(fresh <= level) if level < m else np.zeros(0, np.int64)
                cut = np.searchsorted(below, np.append(starts, hi - lo)) + counts[level + 1]
                parts[level].append((chars, np.full(len(starts), m), starts + lo, cut[:-1], cut[1:]))
                counts[level] += len(starts)
                starts, chars = below, codes[below, level] if level < m else chars
        self.levels = [[np.concatenate(x) for x in zip(*p, strict=True)] for p in parts if p]

    def near(self, key: str, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the texts whose LCS with ``key`` is ``need`` of their length at least, and the LCS."""
        codes, n = _codes([key]), len(key)
        rest = np.arange(n, -1, -1)
        at = np.flatnonzero(need[self.lengths] <= np.minimum(self.lengths, n))
        rows, places, sizes = np.zeros((len(at), n + 1), np.int16), [], []
        for level, (_, length, first, child, end) in enumerate(self.levels):
            done = length[at] == level
            if done.any():
                places.append(first[at[done]])
                sizes.append(rows[done, -1])
                at, rows = at[~done], rows[~done]
            if not len(at):
                break
            number = end[at] - child[at]
            parent = np.repeat(np.arange(len(at)), number)
            at = np.arange(len(parent)) - np.repeat(np.cumsum(number) - number, number) + child[at][parent]
            chars, length = self.levels[level + 1][:2]
            old = rows[parent]
            rows = old.copy()
            np.maximum(rows[:, 1:], old[:, :-1] + (chars[at][:, None] == codes), out=rows[:, 1:])
            np.maximum.accumulate(rows, axis=1, out=rows)
            left = length[at] - level - 1
            kept = (rows + np.minimum(rest, left[:, None])).max(axis=1) >= need[length[at]]
            at, rows = at[kept], rows[kept]
        return (np.concatenate(places), np.concatenate(sizes)) if places else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Block:
    """Choices of one tag by their texts."""

    def __init__(self, names: Iterable[str], texts: Iterable[str], own: int, scale: float):
        self.named: dict[str, list[str]] = {}
        for name, text in zip(names, texts, strict=True):
            self.named.setdefault(text, []).append(name)
        self.tree, self.own, self.scale = Tree(self.named), own, scale
        self.all_lengths = np.arange(1 + int(self.tree.lengths[-1]))

    def best(self, key: str, text: str, at_least: float) -> tuple[str, float] | None:
        """The choice with the highest score of ``at_least`` or more by this tag, the first of equals."""
        for least in [*(s for s in STEPS if s > at_least), at_least]:
            whole = 2 * self.own + len(text) + self.all_lengths
            share = least / self.scale / 100
            if share > 1 + _EPS:
                continue
            at, common = self.tree.near(text, np.ceil(share * whole / 2 - self.own - _EPS).astype(np.int64))
            lengths = np.array([len(self.tree.texts[i]) for i in at], np.int64)
            bound = self.scale * 200 * (self.own + common) / np.maximum(2 * self.own + len(text) + lengths, 1)
            found: tuple[float, str] | None = None
            for i in np.argsort(-bound, kind="stable"):
                if found and bound[i] < -found[0] - _EPS:
                    break
                for name in self.named[self.tree.texts[at[i]]]:
                    score = weighted_ratio(key, name)
                    if score >= at_least and (found is None or (-score, name) < found):
                        found = (-score, name)
            if found and -found[0] >= least:
                return found[1], -found[0]
        return None


def _texts(frames: Iterator[pd.DataFrame], shares: dict[str, float]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for i, k in enumerate(frame.k):
            words = k.split()
            distinct = sorted(set(words))
            common = [w for w in distinct if w in shares]
            made = {("raw", k, 0), ("sorted", " ".join(sorted(words)), 0), ("sorted", " ".join(distinct), 0)}
            for size in range(1, len(common) + 1) if len(common) <= MOST_COMMON else ():
                for both in itertools.combinations(common, size):
                    made.add((f"words {' '.join(both)}", " ".join(w for w in distinct if w not in both), len(" ".join(both)) + 1))
            rows += [(i, *m) for m in made if m[1]]
        made_of = pd.DataFrame(rows, columns=["i", "tag", "text", "own"])
        yield frame.iloc[made_of.i].reset_index(drop=True).join(made_of[["tag", "text", "own"]])


def too_many(names: DataFrame, shares: dict[str, float]) -> DataFrame:
    """Names with more than ``MOST_COMMON`` of the common words."""

    def pick(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame[[sum(w in shares for w in set(k.split())) > MOST_COMMON for k in frame.k]]

    return names.mapInPandas(pick, "k string")


def near_best(keys: DataFrame, choices: DataFrame, shares: dict[str, float], at_least: float) -> DataFrame:
    """k, best, score: for each key (k, floor: the best score known, or null) what each block of each tag has from there on."""
    asked = keys.select("k", F.coalesce("floor", F.lit(float(at_least))).alias("floor"))
    asked = asked.mapInPandas(lambda x: _texts(x, shares), "k string, floor double, tag string, text string, own int")
    held = choices.select("k").mapInPandas(lambda x: _texts(x, shares), "k string, tag string, text string, own int")
    # Beyond 95 only whole names can reach the score.
    asked = asked.where((F.col("tag") == "raw") | (F.col("floor") <= 95 + _EPS))
    blocks = lambda df, size, name: df.groupBy("tag").agg(F.ceil(F.count("*") / size).cast("int").alias(name))
    tags = blocks(asked, BLOCK_KEYS, "rows").join(blocks(held, BLOCK_CHOICES, "cols"), "tag")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    deal = lambda n: F.pmod(F.xxhash64("k"), F.col(n)).cast("int")
    a = asked.join(tags, "tag").select("tag", "k", "text", "floor", deal("rows").alias("r"), every("cols").alias("c"))
    b = held.join(tags, "tag").select("tag", "k", "text", "own", deal("cols").alias("c"), every("rows").alias("r"))

    def match(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        rows = []
        if len(a) and len(b):
            block = Block(b.k, b.text, int(b.own.iloc[0]), 1 if b.tag.iloc[0] == "raw" else 0.95)
            rows = [(k, *found) for k, text, floor in zip(a.k, a.text, a.floor, strict=True) if (found := block.best(k, text, floor))]
        return pd.DataFrame(rows, columns=["k", "best", "score"])

    return a.groupBy("tag", "r", "c").cogroup(b.groupBy("tag", "r", "c")).applyInPandas(match, "k string, best string, score double")
