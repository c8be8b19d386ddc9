"""Candidate pairs of an exact fuzzy join: names that can reach a score meet by a shared signature, not all by all.

A pair that scores ``at_least`` shares one of these, so a join by signature misses none:

* Words. If the words in common decide the score, they make up a known share of one
  side's characters. Of that side's words, rarest first, a prefix that outweighs the rest
  can't lie outside the common ones altogether: a word of it is on the other side.
* Parts. If the strings differ in few characters, say d insertions and deletions, then of any
  d // 2 + 1 parts of the longer side one is in the other but for one letter (``parts``).
* Pieces, where a name has too few letters for parts: of any d + 1 pieces of one side that lie
  in words and don't overlap, one is whole in a word of the other side. Names are cut into d + 1
  pieces, long ones in rare words, and lengths must agree within d. The same holds for a
  stretch of the longer side that the shorter one resembles.
* A common word of sides of unlike length gives the weighted score a fixed value. Of the
  choices with it, only the first in order can win, so they are grouped by word and length.

A signature that very many choices have is dealt to several tasks.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpgraph.functions.similarity import SCORERS
from corpgraph.operators import parts

#: Below this score pieces get so short that nearly all pairs meet.
LEAST_SCORE = 85
#: Choices of one signature that meet in one task.
HOT_SIGNATURE = 5_000
#: Words of more than one in so many names are dear places for pieces; a piece is as rare by chance as this to the power of its length.
COMMON, CHANCE = 2_000, 12
#: What the weighted score gives for a common word where one name is 1.5 to 8 times as long as the other.
COMMON_WORD = 0.95 * 0.9 * 100
_EPS = 1e-9


def edits(n: int, least: float) -> int:
    """The most insertions and deletions between a string of ``n`` characters and any other at ratio ``least``."""
    c = 1 - least / 100
    return math.floor(2 * c * n / (1 - c) + _EPS)


def stretch_edits(n: int, least: float) -> int:
    """The same for a string of ``n`` characters and a stretch of at most as many."""
    return math.floor(2 * (1 - least / 100) * n + _EPS)


def pieces(words: list[str], number: int, shares: dict[str, float]) -> list[str]:
    """``number`` pieces inside the words that don't overlap, fewer only where there are too few letters.

    Each further piece goes to the word where it costs least: a piece is looked up as
    often as its word is common (``shares``, of all names) or as short pieces are by chance.
    """

    out = []
    for w, n in zip(words, _dealt(tuple((len(w), shares.get(w, 0.0)) for w in words), number), strict=True):
        edges = [len(w) * i // n for i in range(n + 1)] if n else []
        out += [w[a:b] for a, b in zip(edges, edges[1:], strict=False)]
    return out


@functools.lru_cache(maxsize=100_000)
def _dealt(words: tuple[tuple[int, float], ...], number: int) -> list[int]:
    """How many pieces each word (letters, share) gets."""

    def cost(i: int, n: int) -> float:
        letters, share = words[i]
        return n * share + sum(CHANCE ** -(letters // n + (j < letters % n)) for j in range(n)) if n else 0.0

    made = [0] * len(words)
    for _ in range(number):
        open_ = [i for i, (letters, _) in enumerate(words) if made[i] < letters]
        if not open_:
            break
        made[min(open_, key=lambda i: cost(i, made[i] + 1) - cost(i, made[i]))] += 1
    return made


def _cut(frames: Iterator[pd.DataFrame], least: float, weighted: bool, shares: dict[str, float]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        rows = []
        for k in frame.k:
            words = sorted(set(k.split()))
            near = edits(len(k), least) + 1
            part = stretch_edits(len(k), least / 0.9) + 1 if weighted else 0
            near_parts = [] if weighted else parts.parts(words, stretch_edits(len(k), least) // 2 + 1, shares)
            rows.append((k, len(k), len(" ".join(words)), words, pieces(words, near, shares), near_parts, pieces(words, part, shares) if weighted else [], sum(map(len, words)) >= near))
        yield pd.DataFrame(rows, columns=["k", "n", "j", "words", "near_pieces", "near_parts", "part_pieces", "cut"])


CUT = "k string, n int, j int, words array<string>, near_pieces array<string>, near_parts array<string>, part_pieces array<string>, cut boolean"


def names(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-blank names: k."""
    return df.select(F.col(column).cast("string").alias("k")).where("k <> ''").distinct()


def common_words(keys: DataFrame, choices: DataFrame) -> dict[str, float]:
    """Words that more than one in ``COMMON`` names have, and their share; fewer than ``COMMON`` times a name's words."""
    every = keys.unionByName(choices)
    counts = every.select(F.explode(F.array_distinct(F.split("k", r"\s+"))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    total = every.count()
    return {r.w: r.n / total for r in counts.where(F.col("n") > total / COMMON).collect()} if total else {}


def cut(keys: DataFrame, least: float, weighted: bool, shares: dict[str, float]) -> DataFrame:
    """Names with length, length of distinct words joined, words and pieces; ``cut`` is false where there are too few letters."""
    return keys.mapInPandas(lambda frames: _cut(frames, least, weighted, shares), CUT)


def _grams(cut: DataFrame, sizes: list[int]) -> DataFrame:
    """k, n, j, sig: stretches of the words of the given sizes."""
    stretches = F.array([F.lit(s) for s in sizes])
    word = cut.select("k", "n", "j", F.explode("words").alias("w"))
    sized = word.select("k", "n", "j", "w", F.explode(stretches).alias("s")).where(F.length("w") >= F.col("s"))
    return sized.select("k", "n", "j", F.explode(F.sequence(F.lit(1), F.length("w") - F.col("s") + 1)).alias("i"), "w", "s").select("k", "n", "j", F.substring("w", F.col("i"), F.col("s")).alias("sig")).distinct()


def _meet(asking: DataFrame, holding: DataFrame, where: Column) -> DataFrame:
    """a, b: names of both sides with a common sig; ``asking`` has f, the number of ``holding`` rows with it."""
    parts = (F.col("f") / HOT_SIGNATURE).cast("int")
    a = asking.select(F.col("k").alias("a"), F.col("n").alias("n"), F.col("j").alias("j"), "sig", F.explode(F.sequence(F.lit(0), parts)).alias("deal"))
    hot = asking.where(F.col("f") >= HOT_SIGNATURE).select("sig", parts.alias("parts")).distinct()
    b = holding.select(F.col("k").alias("b"), F.col("n").alias("m"), F.col("j").alias("i"), "sig").join(hot, "sig", "left")
    b = b.withColumn("deal", F.coalesce(F.pmod(F.xxhash64("b"), F.col("parts") + 1).cast("int"), F.lit(0))).drop("parts")
    return a.join(b, ["sig", "deal"]).where(where).select("a", "b")


def _swapped(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))


def _by_pieces(asking: DataFrame, holding: DataFrame, column: str, where: Column) -> DataFrame:
    """Pairs where a piece of the asking side is in a word of the other side."""
    rows = asking.select("k", "n", "j", F.explode(F.array_distinct(column)).alias("sig"))
    sizes = sorted(r.s for r in rows.select(F.length("sig").alias("s")).distinct().collect())
    if not sizes:
        return asking.where("false").select(F.col("k").alias("a"), F.col("k").alias("b"))
    grams = _grams(holding, sizes)
    return _meet(rows.join(grams.groupBy("sig").agg(F.count("*").alias("f")), "sig"), grams, where)


def _by_words(asking: DataFrame, holding: DataFrame, least: float, where: Column) -> DataFrame:
    """Pairs where a word of the asking side's prefix is on the other side."""
    words = asking.select("k", "n", "j", F.explode("words").alias("sig"))
    there = holding.select("k", "n", "j", F.explode("words").alias("sig"))
    found = words.join(there.groupBy("sig").agg(F.count("*").alias("f")), "sig", "left").withColumn("f", F.coalesce("f", F.lit(0)))
    before = Window.partitionBy("k").orderBy("f", "sig").rowsBetween(Window.unboundedPreceding, -1)
    rest = F.coalesce(F.sum(F.length("sig") + 1).over(before), F.lit(0))
    share = (200 - 2 * least) / (200 - least)
    prefix = found.withColumn("rest", rest).where((F.col("rest") <= F.col("j") * share + _EPS) & (F.col("f") > 0))
    return _meet(prefix, there, where)


def _unlike(short: str, long_: str) -> Column:
    """Lengths that the weighted score compares by stretches at its higher scale."""
    low, high = F.least(short, long_), F.greatest(short, long_)
    return (2 * high >= 3 * low) & (high <= 8 * low)


def by_rare_words(left: DataFrame, right: DataFrame, shares: dict[str, float]) -> DataFrame:
    """a, b: names (of ``cut``) of alike length that share a word which isn't common (``shares``)."""
    rare = lambda df: df.select("k", "n", "j", F.explode("words").alias("sig")).where(~F.col("sig").isin(list(shares)))
    there = rare(right)
    return _meet(rare(left).join(there.groupBy("sig").agg(F.count("*").alias("f")), "sig"), there, ~_unlike("n", "m"))


def _of_unlike(asking: DataFrame, holding: DataFrame) -> DataFrame:
    """Names to which some name of the other side is unlike in length."""
    lengths = holding.select(F.col("n").alias("m")).distinct()
    able = asking.select("n").distinct().join(lengths, _unlike("n", "m"), "left_semi")
    return asking.join(F.broadcast(able), "n")


def _near(left: DataFrame, right: DataFrame, scorer: str, least: float, where: Column, same: bool) -> list[DataFrame]:
    """Pairs that are alike as strings: by parts of the longer one, by pieces of the left one where either has no parts."""
    cut_up = F.size("near_parts") > 0
    whole, short = left.where(cut_up), right.where(~cut_up)
    size, other = F.col("size"), F.col("other")
    if same:
        found = [parts.near(whole, whole, scorer, least, (size > other) | ((size == other) & (F.col("a") < F.col("b"))))]
    else:
        found = [parts.near(whole, right.where(cut_up), scorer, least, size >= other), _swapped(parts.near(right.where(cut_up), whole, scorer, least, size > other))]
    few = left.where(~cut_up)
    found += [] if few.isEmpty() else [_by_pieces(few, right, "near_pieces", where)]
    return found if short.isEmpty() else [*found, _by_pieces(whole, short, "near_pieces", where)]


def candidates(left: DataFrame, right: DataFrame, scorer: str, least: float, *, near_too: bool = True, same: bool = False) -> DataFrame:
    """a, b, sure: distinct pairs of names (of ``cut``) among which are all that score ``least``; the first choice only of those that a common word alone brings there.

    Without ``near_too``, pairs of alike length that share no word's part in the score are left out. With ``same``, ``left`` and ``right`` hold the same names: a pair comes once, a before b, a name and itself not at all.
    """
    weighted, alike = scorer == "weighted", ~_unlike("n", "m")
    c = 1 - least / 100
    near = (F.abs(F.col("n") - F.col("m")) <= c * (F.col("n") + F.col("m")) + _EPS) | (F.abs(F.col("j") - F.col("i")) <= c * (F.col("j") + F.col("i")) + _EPS)
    found = [p.withColumn("sure", F.lit(False)) for p in _near(left, right, scorer, least, near, same)] if near_too else []
    sure = []
    if scorer != "ratio":
        at = least / 0.95 if weighted else least
        here = alike if weighted else F.col("a") != F.col("b") if same else F.lit(True)
        sure += [_by_words(left, right, at, here)] if same else [_by_words(left, right, at, here), _swapped(_by_words(right, left, at, here))]
    if weighted:
        sure += [_by_pieces(_of_unlike(left, right), right, "part_pieces", _unlike("n", "m")), _swapped(_by_pieces(_of_unlike(right, left), left, "part_pieces", _unlike("n", "m")))]
        if least <= COMMON_WORD + _EPS:
            there = right.select(F.explode("words").alias("w"), F.col("n").alias("m"), "k").groupBy("w", "m").agg(F.min("k").alias("b"))
            shared = left.select(F.col("k").alias("a"), "n", F.explode("words").alias("w")).join(there, "w").where(_unlike("n", "m"))
            sure.append(shared.groupBy("a").agg(F.min("b").alias("b")))
    found += [p.withColumn("sure", F.lit(True)) for p in sure]
    pairs = found[0]
    for p in found[1:]:
        pairs = pairs.unionByName(p)
    if same:
        pairs = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "sure")
    return pairs.groupBy("a", "b").agg(F.max("sure").alias("sure"))


def _bags(texts: Iterable[str], counters: int = 48) -> np.ndarray:
    texts = list(texts)
    rows = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    places = rows * counters + np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32) % counters
    return np.bincount(places, minlength=len(texts) * counters).reshape(len(texts), counters)


def scored(pairs: DataFrame, scorer: str, least: float) -> DataFrame:
    """k, best, score of the pairs that reach ``least``. Characters in common bound the others' scores first."""

    def bound(a: list[str], b: list[str]) -> np.ndarray:
        common = np.minimum(_bags(a), _bags(b)).sum(axis=1)
        return 200 * common / np.maximum([len(x) + len(y) for x, y in zip(a, b, strict=True)], 1)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = SCORERS[scorer]
        for frame in frames:
            sets = [[" ".join(sorted(set(x.split()))) for x in frame[c]] for c in "ab"]
            maybe = frame.sure.to_numpy(bool) | (bound(list(frame.a), list(frame.b)) >= least - _EPS) | (bound(*sets) >= least - _EPS) if len(frame) else []
            kept = frame[maybe] if len(frame) else frame
            rows = [(a, b, one(a, b)) for a, b in zip(kept.a, kept.b, strict=True)]
            yield pd.DataFrame([r for r in rows if r[2] >= least], columns=["k", "best", "score"])

    return pairs.mapInPandas(score, "k string, best string, score double")
