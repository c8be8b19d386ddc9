"""Source divergence against a plain sum over all terms."""

import random
import re
from collections import Counter, defaultdict

import pytest

from corpgraph.llm import divergence

SCHEMA = "doc_id long, text string, lang string, source string, p long, term string"


def brute(rows, least=3, top=200):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, df, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(divergence.TERM, (text or "").translate(low))
        groups[lang].add(source)
        counts[lang, source].update(terms)
        df[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in df[lang].items() if n >= least]
        v = len(kept)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + v) for t in kept}  # noqa: B023, E731
        all_ = Counter()
        for s in sources:
            all_.update(counts[lang, s])
        p, q = {s: share(counts[lang, s]) for s in sources}, share(all_)
        for s in sources:
            pairs = [(-sum((p[s][t] - p[o][t]) ** 2 // p[o][t] for t in kept), o) for o in sources if o != s]
            terms = [(-((p[s][t] - q[t]) ** 2 // q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", sorted(pairs, key=lambda x: (x[0], x[1].encode()))), ("term", sorted(terms, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, -value, k) for k, (value, item) in enumerate(items, 1)]
    return sorted(out)


def result(df):
    return sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in df.collect())


def sample(seed, n=120):
    rng = random.Random(seed)
    words = ["The", "the", "été", "ÉTÉ", "x1y", "a-b", "日本", "Foo", "foo", "bar", "baz", "q" * 300, "ſ", "K"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = []
    for i in range(n):
        lang, source = rng.choice(["en", "en", "de", None, ""]), rng.choice(["hot", "hot", "b", "c", None, "ü"])
        rows.append((i, None if rng.random() < 0.05 else " ".join(rng.choices(words, k=rng.randint(0, 40))), lang, source, 1, "t"))
    rows += [(500, "a" * 100_000 + " end", "en", "hot", 1, "t"), (501, "", "xx", "only", 1, "t"), (502, "rare words here", "yy", "one", 1, "t"), (503, "other", "yy", "two", 1, "t"), (3, "the the", "en", "b", 1, "t"), (3, "the the", "en", "b", 1, "t")]
    return rows


@pytest.mark.parametrize(("seed", "slice_bytes", "small"), [(1, 8 << 20, 8 << 20), (2, 50, 0)])
def test_equals_brute_force(spark, monkeypatch, seed, slice_bytes, small):
    monkeypatch.setattr(divergence, "BROADCAST_BYTES", small)
    rows = sample(seed)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    assert result(divergence.audit(docs, top_terms=5)) == brute(rows, top=5)
    if slice_bytes == 50:
        assert result(divergence.audit(docs, least_docs=1)) == brute(rows, least=1)


def test_empty_table(spark):
    assert divergence.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_counts_in_small_slices_are_the_same(monkeypatch):
    import pyarrow as pa

    rows = [(t or "", lang or "", s or "") for _, t, lang, s, *_ in sample(4)]
    batch = pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["text", "lang", "source"])

    def counted(limit):
        monkeypatch.setattr(divergence, "SLICE_BYTES", limit)
        out = Counter()
        for made in divergence._terms(iter([batch])):
            for r in made.to_pylist():
                out[r["lang"], r["source"], r["term"], "n"] += r["n"]
                out[r["lang"], r["source"], r["term"], "df"] += r["df"]
        return out

    assert counted(8 << 20) == counted(50)
