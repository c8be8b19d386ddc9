"""Parts of names but for one letter: what must meet meets, and names that are not alike hardly do."""

import hashlib
import random

from corpgraph.functions.similarity import token_set_ratio
from corpgraph.operators import candidates, fuzzy, parts
from corpgraph.plans import brands


def test_a_part_meets_itself_but_for_one_letter():
    rng = random.Random(5)
    for size in parts.SIZES:
        part = "".join(rng.sample("ABCDEFGHIJ", size))
        changed = [part, *(part[:i] + part[i + 1 :] for i in range(size)), *(part[:i] + x + part[i:] for i in range(1, size) for x in "Q ")]
        _, asked = parts.asked([part])
        for text in changed:
            words = ["AA", *f"XY{text}Z".split(), "ZZ"]
            _, held = parts.held([words], [size], [parts._following("", words, "token_set")])
            assert set(asked.tolist()) & set(held.tolist()), (part, text)


def test_parts_dont_overlap_and_are_enough_or_none():
    made = parts.parts(["ACME", "HOLDINGS"], 3, {"ACME": 0.5})
    assert len(made) == 3 and sum(map(len, made)) <= 12 and all(p in "ACME HOLDINGS" for p in made)
    assert parts.parts(["ACME", "CO"], 2, {}) == []


def spelled(n):
    code = lambda i: hashlib.md5(str(i).encode()).hexdigest().upper()
    return [x for i in range(n) for x in (f"{code(i)} Foods", f"Foods {code(i)}", f"{code(i)}X Foods")]


def test_names_of_one_alphabet_meet_only_where_they_are_alike(spark):
    names = spelled(500)
    df = spark.createDataFrame([(x,) for x in names], "k string")
    cut = candidates.cut(df, 90, False, candidates.common_words(df, df))
    assert candidates.candidates(cut, cut, "token_set", 90, same=True).count() < 2 * 3 * len(names)  # pieces of four letters: some 70,000


def test_one_turn_after_the_other_and_shared_numbers(spark, monkeypatch):
    monkeypatch.setattr(parts, "BITS", 1 << 15)
    monkeypatch.setattr(parts, "HOT", 2)
    names = spelled(60)
    df = spark.createDataFrame([(x,) for x in names], "k string")
    got = sorted((r.k, r.match) for r in fuzzy.all_matches(df, df.select("k"), "k", "k", at_least=90).collect())
    assert got == sorted((a, b) for a in names for b in names if token_set_ratio(a, b) >= 90)


def test_names_are_made_once(spark):
    made = spark.sparkContext.accumulator(0)

    def count(frames):
        for f in frames:
            made.add(len(f))
            yield f

    df = spark.createDataFrame([(f"ACME {x}",) for x in "ABCDEFGH"], "k string")
    fuzzy.best_match(df.mapInPandas(count, "k string"), df, "k", "k", at_least=90).collect()
    assert made.value == 8


def test_sketches_differ_no_more_than_the_letters():
    rng = random.Random(7)
    for _ in range(300):
        a = "".join(rng.choices("ABCDEF0123é𐍈", k=rng.randint(0, 40)))
        b = "".join(x for x in a if rng.random() > 0.2) + "".join(rng.choices("ABX", k=rng.randint(0, 5)))
        x, y = parts.sketches([a, b]).tolist()
        assert x >= 0 and y >= 0 and (x ^ y).bit_count() <= sum(abs(a.count(c) - b.count(c)) for c in {*a, *b})


def test_a_table_and_itself_meet_once(spark):
    names = spelled(200)
    df = spark.createDataFrame([(x,) for x in names], "k string")
    cut = candidates.cut(df, 90, False, candidates.common_words(df, df))
    pairs = [(r.a, r.b) for r in candidates.candidates(cut, cut, "token_set", 90, same=True).collect()]
    assert all(a < b for a, b in pairs) and len(pairs) == len(set(pairs))
    assert set(pairs) >= {(a, b) for a in names for b in names if a < b and token_set_ratio(a, b) >= 90}
    got = sorted((r.k, r.match, r.fuzzy_score) for r in fuzzy.all_matches(df, df, "k", "k", at_least=90).collect())
    assert got == sorted((a, b, token_set_ratio(a, b)) for a in names for b in names if token_set_ratio(a, b) >= 90)


def test_names_far_apart_in_letters_make_no_pair(spark):
    letters = lambda i, at: "".join(random.Random(f"{i}{at}").choices(at, k=24))
    names = [f"{letters(i, x)}ABCDEFGH" for i, x in enumerate(("IJKL", "MNOP", "QRST", "UVWX"))]  # all share the last of four parts
    df = spark.createDataFrame([(x,) for x in names], "k string")
    cut = candidates.cut(df, 90, False, {})
    assert cut.where("array_contains(near_parts, 'ABCDEFGH')").count() == 4
    assert candidates.candidates(cut, cut, "token_set", 90, same=True).count() == 0


def test_full_bitmaps_hold_whole_parts_in_turns(spark, monkeypatch):
    monkeypatch.setattr(parts, "BITS", 1 << 10)
    names = spelled(40)
    df = spark.createDataFrame([(x,) for x in names], "k string")
    got = sorted((r.k, r.match) for r in fuzzy.all_matches(df, df, "k", "k", at_least=90).collect())
    assert got == sorted((a, b) for a in names for b in names if token_set_ratio(a, b) >= 90)


def canonical(spark, names, monkeypatch):
    """Canonical names, and how many were compared."""
    compared = []

    def counted(left, *args, **kwargs):
        compared.append(left.count())
        return fuzzy.all_matches(left, *args, **kwargs)

    monkeypatch.setattr(brands, "all_matches", counted)
    found = spark.createDataFrame([(f"{i:04}", 0, x, i) for i, x in enumerate(names)], "message_id string, position int, brand_clean string, date int")
    return sorted(r.name for r in brands.canonical_names(found).collect()), compared[0]


def test_names_of_the_same_words_are_compared_once(spark, monkeypatch):
    names = spelled(50)
    assert canonical(spark, names, monkeypatch) == (sorted(names[::3]), 100)


def test_twins_and_blanks_keep_names_of_the_same_words_apart(spark, monkeypatch):
    # Acme Foods is settled by its twin, which Foods Acme is not like; names of blanks alone are like nothing.
    names = ["ACME FOODS", "Acme Foods", "Foods Acme", "\u3000", " \u3000", " ", "  "]
    want = []
    for x in names:
        if not any(x.lower() == y.lower() or token_set_ratio(x, y) >= 90 for y in want):
            want.append(x)
    assert canonical(spark, names, monkeypatch)[0] == sorted(want)
