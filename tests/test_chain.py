"""The linear-chain tagger: exact labels, training on labelled windows, recall on names it hasn't seen."""

import itertools

import numpy as np

from corpgraph.functions import chain
from corpgraph.plans import people, tagger

FIRSTS = ["Jane", "Alan", "Mary", "Peter", "Zoë", "Lucía", "Omar", "Ines"]
LASTS = ["Stone", "McLake", "Müller", "Brook", "O'Hara", "de la Cruz", "Vogt", "Ibarra", "Smith-Jones"]
CONTEXTS = [
    "Chief Financial Officer {n} said on Monday that Acme Corp had grown.",
    "The Board of Directors named {n} as President of Globex Holdings.",
    "On May 2, 2024, {n} signed the Purchase Agreement in New York.",
    "Mr. {n}, Vice President, left the Company.",
]


def filing(name: str, context: str) -> str:
    return f"{context.format(n=name)}\n\nBy: /s/ {name}\nName: {name}\nTitle: Chief Financial Officer\nDate: today\n"


def test_viterbi_equals_brute_force():
    rng = np.random.default_rng(4)
    for n in range(1, 7):
        for _ in range(20):
            emitted, moves = rng.normal(size=(n, 3)), rng.normal(size=(3, 3))
            able = rng.random(n) < 0.8
            got = chain.best_labels(emitted * able[:, None], moves, *chain.runs(able))

            def score(labels, emitted=emitted, able=able, moves=moves, n=n):
                inner = sum(emitted[i, y] for i, y in enumerate(labels) if able[i])
                return inner + sum(moves[a, b] for a, b in itertools.pairwise((chain.OUT, *labels, chain.OUT)))

            every = [y for y in itertools.product(range(3), repeat=n) if all(able[i] or y[i] == chain.OUT for i in range(n))]
            assert np.isclose(score(tuple(got)), max(map(score, every)))


def test_windows_carry_every_labelled_place():
    text = "Acme said Ada Stone would go. " + "x " * 400 + "By: /s/ Ada Stone\nName: Ada Stone\nTitle: President\nDate: today\n"
    cut = tagger.windows(text)
    assert [[w[a:b] for a, b in names] for w, names in cut] == [["Ada Stone"], ["Ada Stone", "Ada Stone"]]
    assert tagger.windows("") == [] and tagger.windows("nobody signs") == []


def test_recall_on_unseen_names_beats_the_pattern(spark):
    plain = ["Stone", "Lake", "Brook", "Vogt", "Marsh", "Hill"]
    train = [(filing(f"{f} {x}", c),) for f in FIRSTS[:4] for x in plain for c in CONTEXTS] + [(None,), ("",), ("no name",)]
    rows = spark.createDataFrame(train, "raw_text string")
    model = tagger.fit_tagger(rows)
    again = tagger.fit_tagger(rows.repartition(7))
    assert np.array_equal(model.weights, again.weights) and np.array_equal(model.moves, again.moves)
    held = [(f"{f} {x}", c) for f in FIRSTS[4:] for x in LASTS for c in CONTEXTS]

    def recall(tag):
        return sum(n in [t[a:b] for a, b in tag(t)] for n, c in held for t in [c.format(n=n)]) / len(held)

    assert recall(model) > recall(people.default_tagger) and recall(model) > 0.9
    clean = [c.format(n="they") for c in CONTEXTS]
    assert sum(len(model(t)) for t in clean) <= 1 and model("") == [] and model("\n \n") == []


def test_without_labels_it_finds_nobody(spark):
    model = tagger.fit_tagger(spark.createDataFrame([(None,), ("Jane Roe was here.",)], "raw_text string"))
    assert model("Jane Roe was here.") == []


def test_texts_together_equal_texts_alone(monkeypatch):
    model = chain.fit([(c.format(n=f"{f} Stone"), [(c.index("{n}"), c.index("{n}") + len(f) + 6)]) for f in FIRSTS for c in CONTEXTS])
    texts = ["", "Jane", "Jane Roe", *[c.format(n=f"{f} {x}") for f in FIRSTS for x in LASTS for c in CONTEXTS], "", " \n"]
    alone = [model(t) for t in texts]
    assert model.many(texts) == alone and model.many([]) == [] and sum(map(len, alone)) > 100
    monkeypatch.setattr(chain, "TOGETHER", 100)
    assert model.many(texts) == alone


def test_a_long_run_is_one_chain():
    model = chain.fit([("By Jane Roe now", [(3, 11)])] * 3)
    assert model("By Jane Roe now") == [(3, 11)] and isinstance(model("Word " * 20_000), list)


def test_tokens_are_those_of_the_pattern():
    rng = np.random.default_rng(8)
    texts = ["", "A.", "A.B. O'Hara-Smith's -x- U.S. 3M's x_y\n\nde la Cruz’s d'", *("".join(rng.choice(list("aB.'’-_ 1²é\n\t中İK,"), 40)) for _ in range(300))]
    for t in texts:
        codes = np.frombuffer(t.encode("utf-32-le"), np.uint32)
        starts, ends = chain.spans(codes, chain._kinds(codes))
        assert list(zip(starts.tolist(), ends.tolist(), strict=True)) == [m.span() for m in chain.TOKEN.finditer(t)], t


def test_only_words_by_a_name_are_looked_up(monkeypatch):
    model, asked, slots = chain.fit([("led by Ada Stone today", [(7, 16)])] * 4), [], chain._slots
    monkeypatch.setattr(chain, "_slots", lambda w: asked.append(w) or slots(w))
    texts = ["it grew well and was led by Ada Stone today as all had said", "nobody was here", "and van Ada"]
    assert [[t[a:b] for a, b in s][:1] for t, s in zip(texts, model.many(texts), strict=True)][0] == ["Ada Stone"]
    assert set(asked) == {"led", "by", "Ada", "Stone", "today", "as", "and", "van"}


def test_equal_filings_are_cut_once_and_in_more_than_one_task(spark):
    name = "Ada Stone"
    one = spark.createDataFrame([(filing(name, c) + str(i // 2),) for i in range(40) for c in CONTEXTS], "raw_text string").coalesce(1)
    cut = tagger.labelled_windows(one)
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate [text") < plan.index("ArrowEvalPython") < plan.index("Aggregate [raw_text")
    assert cut.count() == one.distinct().select("raw_text").rdd.flatMap(lambda r: [w for w, _ in tagger.windows(r.raw_text)]).distinct().count()


def test_mentions_are_those_of_all_patterns():
    none = lambda _: []
    assert people.mentions_in("it was ADA STONE ,  vice\n president", none) == [] and people.mentions_in("Ada Stone, Vice\nPresident", none) == [("Ada Stone", "Vice\nPresident", "low")]
    assert [m[2] for m in people.mentions_in(filing("Ada Stone", CONTEXTS[0]), none)] == ["high", "high"]
