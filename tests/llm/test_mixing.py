import random
import re

import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from corpgraph.llm import mixing


def by_quotients(votes, seats, most):
    got = [0] * len(votes)
    for _ in range(seats):
        best = [(-v / (2 * g + 1), i) for i, (v, g, m) in enumerate(zip(votes, got, most)) if v > 0 and g < m]
        if not best:
            break
        got[min(best)[1]] += 1
    return got


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1000), st.integers(0, 60)), min_size=1, max_size=8), st.integers(0, 200))
def test_apportionment_is_highest_quotients(parties, seats):
    votes, most = [float(v) for v, _ in parties], [m for _, m in parties]
    assert mixing.sainte_lague(votes, seats, most) == by_quotients(votes, seats, most)
    assert mixing.sainte_lague(votes, seats) == by_quotients(votes, seats, [seats] * len(votes))


def test_targets_reshare_excess():
    assert mixing.targets([10, 100, 100], [5, 2, 1], 1.5, 2) == [20.0, 196.66666666666666, 98.33333333333333]
    assert mixing.targets([0, 0], [5, 2], 1.5, 2) == [0.0, 0.0]
    assert mixing.targets([], [], 1.5, 2) == []


def test_mix(spark):
    r = random.Random(4)
    rows = [(i, " ".join("w" for _ in range(r.randint(0, 80))), r.choice(["a", "b", "b", "b", "é", None]), 7) for i in range(3000)]
    rows += [(5000, "long " * 30000, "b", 1), (5001, None, "a", 1), (None, "no id", "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix(df.repartition(3)).collect()
    assert len(got) == len(rows)
    size = {}
    for x in got:
        size.setdefault(x.source, [0, 0, x.source_size, x.target])
        size[x.source][0] += x["size"]
        size[x.source][1] += x.taken
        assert 0 <= x.taken <= 2 * x["size"]
    order = sorted(size, key=lambda s: (s is None, s or ""))
    want = mixing.targets([size[s][0] for s in order], [[5, 2, 1][i % 3] for i in range(len(order))], 1.5, 2)
    for s, t in zip(order, want):
        total, taken, source_size, target = size[s]
        assert source_size == total and abs(target - t) < 1e-6 * max(t, 1)
        assert abs(taken - target) <= 0.01 * target + 200
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str)
    assert mixing.mix(df.limit(0)).count() == 0
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns


def test_clashing_columns_stay(spark):
    docs = spark.createDataFrame([(i, "w " * 50, "a", "c", "k", "n") for i in range(20)], "doc_id long, text string, source string, _copy string, copies string, `a.b` string")
    got = mixing.mixed_documents(docs)
    assert got.columns == docs.columns
    assert {tuple(r)[3:] for r in got.collect()} == {("c", "k", "n")}


def test_whole_documents_meet_targets(spark):
    r = random.Random(9)
    rows = [(i, f"t{i} " + "w " * r.randint(20, 200), r.choice(["a", "b", "b", "b", "c", "c", None])) for i in range(6000)]
    rows += [(None, f"n{i} " + "w " * r.randint(20, 200), "b") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    target = {x.source: x.target for x in mixing.mix(df).collect()}
    kept, words, no_id = dict.fromkeys(target, 0), {x[1]: len(x[1].split()) for x in rows}, 0
    for x in mixing.mixed_documents(df.repartition(5)).collect():
        kept[x.source] += words[x.text]
        no_id += x.doc_id is None
    assert no_id > 0
    for s, t in target.items():
        assert abs(kept[s] - t) <= 0.02 * t, (s, kept[s], t)


def test_many_parties_near_half_a_seat():
    votes = [2000.0] + [0.51] * 1000
    got = mixing.sainte_lague(votes, 2510)
    assert got == by_quotients(votes, 2510, [2510] * 1001) and sum(got) == 2510
    r = random.Random(6)
    votes = [r.choice([0.49, 0.5, 0.51, 3.0, 700.0]) for _ in range(800)]
    most = [r.randint(0, 900) for _ in votes]
    assert mixing.sainte_lague(votes, 5000, most) == by_quotients(votes, 5000, most)


def spark_hash(*values):
    """xxhash64 of Spark over longs, texts and ints (given as pairs), nulls left out."""
    h = 42
    for kind, v in values:
        if v is not None:
            raw = v.encode() if kind == "text" else v.to_bytes(8 if kind == "long" else 4, "little", signed=True)
            h = xxhash.xxh64_intdigest(raw, seed=h)
    return h - (1 << 64) * (h >= 1 << 63)


def brute_taken(rows, seed=17):
    """(doc_id, text) -> words taken, block by block."""
    count = lambda t: len(re.findall("[^\x20\x09-\x0d]+", t or ""))
    order = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    sizes = [sum(count(t) for _, t, s in rows if s == x) for x in order]
    aims = mixing.targets(sizes, [[5, 2, 1][i % 3] for i in range(len(order))], 1.5, 2)
    seats = by_quotients(aims, round(sum(aims) / mixing.BLOCK_TOKENS), [-(-2 * n // mixing.BLOCK_TOKENS) for n in sizes])
    out = {}
    for source, size, seat in zip(order, sizes, seats):
        shards: dict = {}
        n_shards = max(1, -(-size // mixing.SHARD_TOKENS))
        for i, t, s in rows:
            if s == source:
                text = spark_hash(("text", t))
                shards.setdefault(spark_hash(("long", i), ("long", text), ("int", seed)) % n_shards, []).append((spark_hash(("long", i), ("long", text), ("int", seed + 1)), i, t))
        names = sorted(shards)
        words = {k: [(i, t) for _, i, t in sorted(shards[k], key=lambda x: x[0]) for _ in range(count(t))] for k in names}
        blocks = {k: [words[k][a : a + mixing.BLOCK_TOKENS] for a in range(0, len(words[k]), mixing.BLOCK_TOKENS)] for k in names}
        for k, quota in zip(names, by_quotients([len(words[k]) for k in names], seat, [2 * len(blocks[k]) for k in names])):
            shift = (seed * 7919 + k * 104729) % max(1, len(blocks[k]))
            for j in range(quota):  # the run goes on past the last block; a whole round is a pass
                for word in blocks[k][(shift + j) % len(blocks[k])]:
                    out[word] = out.get(word, 0) + 1
    return out


def test_taken_equals_blocks_counted_one_by_one(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SHARD_TOKENS", 3000)
    r = random.Random(14)
    rows = [(i if r.random() < 0.9 else None, f"u{i} " + "w " * r.randint(0, 150), r.choice(["a", "b", "b", "c", "c", "d", None])) for i in range(900)] + [(5000, None, "a"), (5001, "", "b")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4))
    want = brute_taken(rows)
    assert sorted((str(x.doc_id), str(x.source), x["size"], x.taken) for x in got.collect()) == sorted((str(i), str(s), len((t or "").split()), want.get((i, t), 0)) for i, t, s in rows)
