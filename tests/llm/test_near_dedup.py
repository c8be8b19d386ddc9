import random
import re

import numpy as np
from pyspark.sql import functions as F

from corpgraph.llm import near_dedup

WORD = re.compile("[^\x20\x09-\x0d]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute(docs, width, percent):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = {}
    for i, text in docs:
        w = WORD.findall(lower(text))
        sets[i] = ({tuple(w)} if w else set()) if len(w) < width else {tuple(w[k : k + width]) for k in range(len(w) - width + 1)}
    lead = {i: i for i in sets}

    def top(i):
        while lead[i] != i:
            i = lead[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                    x, y = sorted((top(a), top(b)))
                    lead[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def corpus():
    r = random.Random(5)
    words = [f"w{i}" for i in range(300)]
    docs = []
    for _ in range(12):
        base = [r.choice(words) for _ in range(r.randint(40, 160))]
        for _ in range(r.randint(1, 9)):
            copy = list(base)
            for _ in range(r.randint(0, 5)):
                copy[r.randrange(len(copy))] = r.choice(words)
            docs.append(" ".join(copy))
    chain = [r.choice(words) for _ in range(60)]
    for step in range(8):  # each like the next, first and last unlike
        docs.append(" ".join(chain[step * 2 :] + [f"t{step}x{k}" for k in range(step * 2)]))
    docs += ["", None, " \n\t ", "one two", "ONE two", "one\ttwo\n", "ünï ÜNÏ", docs[0], docs[0].upper(), "long " * 5000]
    r.shuffle(docs)
    return list(enumerate(docs))


def test_components_equal_brute_force(spark):
    docs = corpus()
    for width in (4, 5):
        df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, component_id string, kept int")
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df.repartition(3), width=width).collect()}
        assert got == brute(docs, width, 80)


def test_hot_group_of_near_copies(spark):
    r = random.Random(9)
    base = [f"b{i}" for i in range(120)]
    docs = []
    for i in range(150):
        copy = list(base)
        for _ in range(r.randint(0, 4)):
            copy[r.randrange(120)] = f"r{r.randrange(10**6)}"
        docs.append((i, " ".join(copy)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_dedup.near_duplicates(df, width=4).collect()}
    assert got == brute(docs, 4, 80)


def test_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (7, None)], "doc_id long, text string")
    rows = sorted(((r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(df).collect()), key=str)
    assert rows == sorted([(None, None, True), (3, 3, True), (3, 3, True), (7, 7, True)], key=str)
    assert near_dedup.near_duplicates(df.limit(0)).count() == 0


def test_filter_keeps_columns(spark):
    df = spark.createDataFrame([(1, "a b c d e f g", "s"), (2, "a b c d e f g", "t"), (3, "z", None)], "doc_id long, text string, bucket string")
    out = near_dedup.keep_one_of_each(df)
    assert out.columns == df.columns
    assert sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_rows_that_share_an_id_are_linked(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (5, "u v w x y z"), (2, "U V W X Y Z"), (9, "A b c d e f")], "doc_id long, text string")
    assert {r.component_id for r in near_dedup.near_duplicates(df).collect()} == {2}


def test_texts_under_one_id_link_its_neighbours(spark):
    t = [f"t{i}" for i in range(40)]
    near = " ".join([*t[:39], "other"])
    rows = [(5, " ".join(f"s{i}" for i in range(30))), (5, " ".join(t)), (9, near), (11, " ".join(t)), (7, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for part in (df, df.repartition(4), df.orderBy(F.desc("text")).coalesce(1)):
        assert {(r.doc_id, r.component_id) for r in near_dedup.near_duplicates(part).collect()} == {(5, 5), (9, 5), (11, 5), (7, 7)}


def test_last_turn_finds_links_that_stars_miss(spark, monkeypatch):
    """Without any star round, every link comes from the sliced bucket join."""
    monkeypatch.setattr(near_dedup, "STARS", 0)
    monkeypatch.setattr(near_dedup, "SLICE_MEMBERS", 3)
    docs = corpus()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(df).collect()} == brute(docs, 5, 80)


def test_plans_of_the_turns_stay_small(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string")
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    near_dedup.near_duplicates(docs, width=4)
    run = store.executionsList(before, 1000)
    plans = [run.apply(i).physicalPlanDescription() for i in range(run.size())]
    turns = [p.split("== Initial Plan ==")[-1].split("\n\n")[0] for p in plans if re.search(r"Arguments: \S*/near-dedup-\w+/pairs-\d", p)]
    scans = [p.count("Scan parquet") for p in turns]
    # The driver holds a plan with all its tasks and broadcasts; a turn's plan reads tables and doesn't make them again.
    assert len(scans) > 1 and max(scans) <= 6, scans


def edited(r, base, most):
    copy = list(base)
    for _ in range(r.randint(0, most)):
        copy[r.randrange(len(copy))] = f"r{r.randrange(10**6)}"
    return copy


def test_large_group_of_which_many_are_unlike_its_centre(spark, monkeypatch):
    """Copies that link with no centre but with one another: edited alike, cut alike, with a passage of their own."""
    monkeypatch.setattr(near_dedup, "SLICE_MEMBERS", 20)
    r = random.Random(3)
    base = [f"b{i}" for i in range(150)]
    docs = [edited(r, base, 9) for _ in range(250)]
    for k in range(12):  # pairs that share edits enough to link, most of them away from the others
        one = edited(r, edited(r, base, 9), 9)
        docs += [one, edited(r, one, 2)]
    docs += [base[: 150 - k] for k in range(0, 60, 4)] + [base[: 60 + k] + [f"p{i}" for i in range(40)] + edited(r, base, 3)[60 + k :] for k in range(0, 40, 4)]
    r.shuffle(docs)
    rows = [(i, " ".join(d)) for i, d in enumerate(docs)]
    expected = brute(rows, 4, 80)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for stars in (0, near_dedup.STARS):
        monkeypatch.setattr(near_dedup, "STARS", stars)
        assert {x.doc_id: (x.n_shingles, x.component_id) for x in near_dedup.near_duplicates(df, width=4).collect()} == expected


def test_prefixes_meet_for_every_link():
    r = np.random.default_rng(2)
    asked = met = 0
    for percent, size in ((80, 60), (80, 147), (90, 200)):
        centre = np.arange(1, size + 1, dtype=np.uint64)
        sets = []
        for _ in range(60):
            keep = centre[r.random(size) > r.choice([0.02, 0.1, 0.2])][: r.integers(size // 2, size + 1)]
            sets.append(np.union1d(keep, r.integers(1000, 1000 + r.choice([20, 2000]), r.integers(0, size // 3)).astype(np.uint64)))
        for one in list(sets):
            sets += [one[r.random(len(one)) > 0.05], one[: len(one) * 9 // 10]]
        values, numbers = np.unique(np.concatenate(sets[:20]), return_counts=True)
        diffs = [near_dedup._difference(s, centre, values[numbers > 1], numbers[numbers > 1], 20) for s in sets]
        limits = [near_dedup.prefixes(len(s), len(d), size, percent) for s, d in zip(sets, diffs, strict=True)]
        for x, dx, (ex, asks, _) in zip(sets, diffs, limits, strict=True):
            assert set(dx.tolist()) == set(x.tolist()) ^ set(centre.tolist())
            if 100 * len(np.intersect1d(x, centre)) >= percent * len(np.union1d(x, centre)):
                continue
            places = {v: len(dx) - i for i, v in enumerate(dx[:asks].tolist())}
            for y, dy, (ey, _, lists) in zip(sets, diffs, limits, strict=True):
                asked += 1
                if 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y)):
                    met += 1
                    assert any(2 * (100 + percent) * min(places[v], len(dy) - i) >= ex + ey for i, v in enumerate(dy[:lists].tolist()) if v in places)
    assert 500 < met < asked / 4


def test_rows_made_grow_with_a_group_and_not_with_its_square(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SLICE_MEMBERS", 16)
    store = spark._jsparkSession.sharedState().statusStore()

    def made(n):
        r = random.Random(1)
        base = [f"b{i}" for i in range(150)]
        before = store.executionsCount()
        near_dedup.near_duplicates(spark.createDataFrame([(i, " ".join(edited(r, base, 8))) for i in range(n)], "doc_id long, text string"), width=4)
        run, rows = store.executionsList(before, 1000), {}
        for i in range(run.size()):
            at = run.apply(i).executionId()
            nodes, values = store.planGraph(at).allNodes(), store.executionMetrics(at)
            for node in (nodes.apply(k) for k in range(nodes.size())):
                for m in (node.metrics().apply(k) for k in range(node.metrics().size())):
                    if re.search("Generate|Arrow", node.name()) and m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                        key = re.sub(r"#\d+L?", "", node.desc())
                        rows[key] = rows.get(key, 0) + int(values.apply(m.accumulatorId()).replace(",", ""))
        return rows

    few, many = made(600), made(1800)
    grown = {k: (few.get(k, 0), v) for k, v in many.items() if v > max(8000, 5 * few.get(k, 0))}
    assert len(many) > 5 and not grown, grown
