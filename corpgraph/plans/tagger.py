"""A person tagger trained on the names that the patterns of filings label."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.functions import chain
from corpgraph.plans.people import INLINE, INLINE_TITLE, LABELLED, ROLES, SIGNED

#: At most so many windows of at most so many characters on each side of a name are fitted on.
FIT_WINDOWS, AROUND, LONGEST_NAME = 2_000, 160, 80
_WINDOW = "array<struct<text string, names array<struct<a int, b int>>>>"


def labelled(text: str) -> list[str]:
    """Distinct names of two words or more that stand in a signature, or before a title."""
    two = lambda s: len(s.split()) > 1 and len(s) <= LONGEST_NAME
    found = [n for signer, name, title in [*SIGNED.findall(text), *LABELLED.findall(text)] if ROLES.search(title.lower()) for n in (signer, name)]
    found += [name for name, title in (INLINE.findall(text) if INLINE_TITLE.search(text) else ()) if ROLES.search(title.lower())]
    return list(dict.fromkeys(n.strip() for n in found if two(n) and n[0].isupper()))


def windows(text: str) -> list[chain.Window]:
    """Stretches around every place where a labelled name stands, wherever in the text; labels count from the stretch's start."""
    spans: list[tuple[int, int]] = []
    for name in labelled(text):
        at = text.find(name)
        while at >= 0:
            spans.append((at, at + len(name)))
            at = text.find(name, at + len(name))
    spans.sort(key=lambda s: (s[0], -s[1]))
    free: list[tuple[int, int]] = []
    for s in spans:
        if not free or s[0] >= free[-1][1]:
            free.append(s)
    out, reached = [], -1
    for a, b in free:
        if b <= reached:
            continue
        lo, hi = max(0, a - AROUND), min(len(text), b + AROUND)
        while lo > 0 and not text[lo - 1].isspace() and lo > a - 2 * AROUND:
            lo -= 1
        inside = [(x - lo, y - lo) for x, y in free if x >= lo and y <= hi]
        out.append((text[lo:hi], inside))
        reached = hi
    return out


def labelled_windows(filings: DataFrame, text: str = "raw_text") -> DataFrame:
    """Distinct labelled windows of all filings: text, names.

    Equal texts are cut once. That they are shuffled for it also deals a table of one small file to all tasks.
    """

    @F.pandas_udf(_WINDOW)
    def cut(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield t.map(lambda x: [{"text": w, "names": [{"a": a, "b": b} for a, b in n]} for w, n in windows(x or "")])

    return filings.select(text).distinct().select(F.explode(cut(text)).alias("w")).select("w.*").dropDuplicates(["text"])


def fit_tagger(filings: DataFrame, text: str = "raw_text", most: int = FIT_WINDOWS) -> chain.ChainTagger:
    """A tagger fitted on the ``most`` labelled windows of all filings whose hashes are least, whatever their order or partitions.

    A window is at most three times ``AROUND`` and two names long, so the bound in rows bounds the driver's bytes too.
    Null and empty texts label nothing; without any label the tagger finds nobody.
    """
    least = labelled_windows(filings, text).orderBy(F.xxhash64("text"), "text").limit(most).collect()
    return chain.fit([(r.text, [(n.a, n.b) for n in r.names]) for r in least])
