import itertools
import random

import numpy as np

from corpgraph.llm import chat


def cheapest(roles):
    """Least cost over all assignments of roles, by trying every one."""
    best = None
    for path in itertools.product(range(3), repeat=len(roles)):
        state, cost = 0, 0
        for role, r in zip(roles, path):
            if r not in chat.STEPS[state]:
                break
            cost += chat.STEPS[state][r][0] + chat.RELABEL * (role != chat.ROLES[r])
            state = r + 1
        else:
            cost += chat.ENDS[state][0]
            best = cost if best is None else min(best, cost)
    return best


def legal(text):
    roles = [part.split("|>")[0] for part in text.split("<|") if part and not part.startswith("end")]
    body = roles[1:] if roles[0] == "system" else roles
    return body == ["user", "assistant"] * (len(body) // 2) and len(body) >= 2


def test_least_cost_and_legal(spark):
    r = random.Random(8)
    rows = []
    for conv in range(120):
        for t in range(r.randint(1, 6)):
            rows.append((conv, t, r.choice(["system", "user", "assistant", "user", "tool", None]), r.choice(["hi", "", None, "long " * 50])))
    rows += [(1000, k, "user" if k % 2 else "assistant", f"t{k}") for k in range(700)]  # one that lies in many partitions
    rows += [(None, None, "user", "x"), (None, 1, "user", "y")]
    df = spark.createDataFrame([(*x, "c") for x in rows], "conv_id long, turn long, role string, text string, cost string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = chat.repair_roles(df).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(rows)
    by = {}
    for x in sorted(got, key=lambda x: x.position):
        by.setdefault(x.conv_id, []).append(x)
    for conv, turns in by.items():
        assert [x.position for x in turns] == list(range(len(turns)))
        assert legal("".join(x.rendered for x in turns)), conv
        if len(turns) < 8:
            assert sum(x.cost for x in turns) == cheapest([x.role for x in turns]), conv
    assert sum(x.cost for x in by[1000]) == chat.RELABEL + chat.INSERT  # the first turn as system, and an answer at the end
    assert chat.repair_roles(df.limit(0)).count() == 0


def test_pieces_equal_whole():
    r = random.Random(3)
    for _ in range(200):
        roles = [r.choice(["system", "user", "assistant", None]) for _ in range(r.randint(2, 30))]
        cut = sorted(r.sample(range(1, len(roles)), min(3, len(roles) - 1)))
        pieces = [roles[a:b] for a, b in zip([0, *cut], [*cut, len(roles)])]
        ends, begin, path = chat.borders([chat.matrix(p) for p in pieces]), 0, []
        for p, end in zip(pieces, ends):
            path += chat.solve(p, begin, end)
            begin = end
        whole = chat.matrix(roles)[0][0]
        assert path == chat.solve(roles)
        least = min(whole[s] + chat.ENDS[s][0] for s in chat.ENDS)
        state, cost = 0, 0
        for role, s in zip(roles, path):
            cost += chat.STEPS[state][s - 1][0] + chat.RELABEL * (role != chat.ROLES[s - 1])
            state = s
        assert cost + chat.ENDS[state][0] == least
        assert np.array(path).min() >= 1


def test_tied_turns_keep_their_order_whatever_the_partitions(spark):
    rows = [(1, 0, "user", f"text {i % 50}") for i in range(60)] + [(1, 1, "assistant", f"a{i}") for i in range(40)] + [(2, None, None, f"n{i}") for i in range(30)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    got = []
    try:
        for n in (1, 4, 9):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            got.append(sorted(map(tuple, chat.repair_roles(df.repartition(n)).collect()), key=str))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert got[0] == got[1] == got[2] and len(got[0]) == len(rows)
