import random
import re

from corpgraph.llm import quality_rules as q

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)

    def covered(n):
        at = {}
        for i in range(len(w) - n + 1):
            at.setdefault(tuple(w[i : i + n]), []).append(i)
        return {i + k for p in at.values() if len(p) > 1 for i in p for k in range(n)}

    lines = [x for x in text.split("\n") if WORD.search(x)]
    twice = [x for x in lines if lines.count(x) > 1]
    chars = lambda ws: sum(map(len, ws))
    out = {"n_words": len(w), "word_chars": chars(w), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered(5)), "line_chars": sum(chars(WORD.findall(x)) for x in twice)}
    out |= {f"chars_{n}": chars([w[i] for i in covered(n)]) for n in q.MOST_COVERED}
    out["base_failed"] = len(w) < 10 or 100 * out["n_repeat_words"] > 20 * len(w)
    out["kept"] = not (out["base_failed"] or out["line_chars"] > q.MOST_LINES * chars(w) or any(out[f"chars_{n}"] > m * chars(w) for n, m in q.MOST_COVERED.items()))
    return out


def test_equal_to_brute_force(spark):
    r = random.Random(2)
    words = ["été", "b", "#c", "d|e", "日本", "longer", "x"]
    texts = ["", None, "\n\n", " a\x1f b\n", "a b c d e f g h i j k", "a\n a\na \na\na", "x" * 5000, "a b c d e f g " * 400, "\n\na b\n\na b\n"]
    for _ in range(150):
        t = ""
        for _ in range(r.randint(0, 120)):
            t += r.choice(words) + r.choice([" ", " ", "  ", "\n", "\t", "\n\n", "\r\n"])
        texts.append(t + r.choice(["", "\n", "tail"]) + (t[: len(t) // 3] if r.random() < 0.3 else ""))
    texts += [" ".join(f"u{i}x{k}" for k in range(200)) for i in range(3)]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "a b", "y")], "doc_id long, text string, n_words string")
    got = {x.doc_id: x.asDict() for x in q.apply_rules(df.repartition(3)).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        assert {k: got[i][k] for k in want} == want, (i, t)
    assert got[None]["n_words"] == 2
    assert q.apply_rules(df.limit(0)).count() == 0
    assert sum(v["kept"] for v in got.values()) >= 3
