"""Chat formatting by minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant in turn,
ending with the assistant. Dynamic programming over that automaton's states finds the
cheapest way to make a conversation legal: merge a turn into the one before,
relabel it, or insert an empty turn.

Conversations are laid out by range partitioning, so one that holds a third of all
rows lies in many partitions. A partition solves the conversations that lie wholly
in it. For the at most two pieces that may go on in a neighbour it gives the least
cost between any two states (a small min-plus matrix, and how ties rank); from these the driver finds
the states at the pieces' borders, and each piece is then solved on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpgraph.llm.work import WorkArea, releasing

ROLES = ("system", "user", "assistant")
START, STATES = 0, 4  # state r + 1: after a turn of role r
MERGE, RELABEL, INSERT = 1, 2, 3
FAR = 1 << 40
#: state -> role -> (cost, roles of empty turns put before, merged)
STEPS = {
    0: {0: (0, (), False), 1: (0, (), False), 2: (INSERT, (1,), False)},
    1: {0: (MERGE, (), True), 1: (0, (), False), 2: (INSERT, (1,), False)},
    2: {1: (MERGE, (), True), 2: (0, (), False)},
    3: {1: (0, (), False), 2: (MERGE, (), True)},
}
#: Cost and empty turns to end a conversation in each state.
ENDS = {1: (2 * INSERT, (1, 2)), 2: (INSERT, (2,)), 3: (0, ())}


def _prices(role: str | None) -> list[list[tuple[int, int]]]:
    """For each state before: (state after, cost) of all ways to read a turn of this role."""
    named = ROLES.index(role) if role in ROLES else -1
    return [[(r + 1, cost + (0 if r == named else RELABEL)) for r, (cost, _, _) in STEPS[s].items()] for s in range(STATES)]


_PRICES = {role: _prices(role) for role in (*ROLES, None)}


def _price(role):
    return _PRICES[role if role in ROLES else None]


def _forward(roles: list, begin: int) -> tuple[list[int], list[list[int]]]:
    """Least cost of each state after the last turn, and after each turn the least state before it on a cheapest way."""
    cost = [FAR] * STATES
    cost[begin] = 0
    back = []
    for role in roles:
        new, link = [FAR] * STATES, [0] * STATES
        for s, ways in enumerate(_price(role)):
            for t, c in ways:
                if cost[s] + c < new[t]:
                    new[t], link[t] = cost[s] + c, s
        back.append(link)
        cost = new
    return cost, back


def _backward(back: list[list[int]], state: int) -> list[int]:
    """States from the last to the first."""
    path = []
    for link in reversed(back):
        path.append(state)
        state = link[state]
    return path


def solve(roles: list, begin: int = START, end: int | None = None) -> list[int]:
    """The states after each turn on a cheapest way from ``begin`` to ``end`` (None: any legal end). Ties: the lesser state, latest first."""
    cost, back = _forward(roles, begin)
    return _backward(back, end if end is not None else min(ENDS, key=lambda s: (cost[s] + ENDS[s][0], s)))[::-1]


def matrix(roles: list) -> np.ndarray:
    """Least cost from each state to each state over these turns, and each way's rank among those to the same state.

    Ways are ranked as ``solve`` breaks ties, so pieces can be joined to the very way
    that the whole conversation would take.
    """
    out = np.zeros((2, STATES, STATES), np.int64)
    made = [_forward(roles, s) for s in range(STATES)]
    for e in range(STATES):
        ways = [_backward(back, e) for _, back in made]
        order = sorted(map(tuple, ways))
        out[0, :, e] = [min(cost[e], FAR) for cost, _ in made]
        out[1, :, e] = [order.index(tuple(w)) for w in ways]
    return out


def borders(pieces: list[np.ndarray]) -> list[int]:
    """States between the pieces of one conversation on the way that ``solve`` finds for the whole, the end state last."""
    cost, back = np.full(STATES, FAR), []
    cost[START] = 0
    for costs, ranks in pieces:
        total = cost[:, None] + costs
        # The least of cost, then of rank, then of the state itself.
        back.append(np.array([min(range(STATES), key=lambda s: (total[s, e], ranks[s, e], s)) for e in range(STATES)]))  # noqa: B023
        cost = np.minimum(total.min(axis=0), FAR)
    state, out = min(ENDS, key=lambda s: (cost[s] + ENDS[s][0], s)), []
    for link in reversed(back):
        out.append(int(state))
        state = link[state]
    return out[::-1]


SCHEMA = "conv_id long, turn long, role string, new_role string, action string, inserted string, cost long, rendered string, position long"


def header(role: str) -> str:
    return f"<|{role}|>\n"


CLOSE = "<|end|>\n"


def repaired(rows: list[tuple], path: list[int], begin: int, last: bool, at: int) -> list[tuple]:
    """The output rows of a piece (conv_id, turn, role, text) whose turns end in the states ``path``."""
    out, state = [], begin
    for k, (conv, turn, role, text) in enumerate(rows):
        r = path[k] - 1
        cost, before, merged = STEPS[state][r]
        changed = role != ROLES[r]
        text = "" if text is None else text
        made = "\n" + text if merged else CLOSE * (state != START) + "".join(header(ROLES[b]) + CLOSE for b in before) + header(ROLES[r]) + text
        inserted = [ROLES[b] for b in before]
        if last and k == len(path) - 1:
            more, after = ENDS[path[k]]
            cost += more
            inserted += ["+" + ROLES[b] for b in after]
            made += CLOSE + "".join(header(ROLES[b]) + CLOSE for b in after)
        action = "+".join((["relabel"] if changed else []) + (["merge"] if merged else [])) or "keep"
        out.append((conv, turn, role, ROLES[r], action, ",".join(inserted), cost + RELABEL * changed, made, at + k))
        state = path[k]
    return out


LAID = SCHEMA + ", conv_key string, text string, part int, piece long, edge boolean, costs array<long>, length long"
_KINDS = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
_FIELDS = [x.split(" ") for x in LAID.split(", ")]
ROWS_OUT = 2000


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(zip(*rows, strict=True), _FIELDS, strict=True)], [n for n, _ in _FIELDS])


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Solves the conversations that lie wholly in the partition; the first and last pieces get their matrix in their first row."""
    part, piece, out = TaskContext.get().partitionId(), 0, []
    key, held = None, []

    def finish(edge: bool) -> None:
        if not edge:
            out.extend((*r, key, None, part, piece, False, None, 0) for r in repaired(held, solve([r[2] for r in held]), START, True, 0))
            return
        costs = matrix([r[2] for r in held]).reshape(-1).tolist()
        out.extend((c, t, role, None, None, None, None, None, k, key, text, part, piece, True, None if k else costs, len(held)) for k, (c, t, role, text) in enumerate(held))

    for batch in batches:
        for k, *row in zip(*[batch.column(c).to_pylist() for c in ("conv_key", "conv_id", "turn", "role", "text")], strict=True):
            if held and k != key:
                finish(piece == 0)
                piece, held = piece + 1, []
                if len(out) > ROWS_OUT:
                    yield _batch(out)
                    out = []
            key = k
            held.append(tuple(row))
    if held:
        finish(True)
    if out:
        yield _batch(out)


def _edge(rows: pd.DataFrame, plan: dict) -> pd.DataFrame:
    """Solves one edge piece between the states that the driver found."""
    rows = rows.sort_values("position")
    null = lambda c: rows[c].astype(object).where(rows[c].notna(), None).tolist()
    begin, end, last, at = plan[int(rows.part.iloc[0]), int(rows.piece.iloc[0])]
    turns = list(zip(null("conv_id"), null("turn"), null("role"), null("text"), strict=True))
    return pd.DataFrame(repaired(turns, solve([t[2] for t in turns], begin, end), begin, last, at), columns=[c.split()[0] for c in SCHEMA.split(", ")])


def repair_roles(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each turn: conv_id, turn, role, new_role, action, inserted, cost, rendered, position.

    Turns are ordered by number (nulls first), then role and a hash of the text, whatever
    the partitions. A turn is kept,
    relabelled (cost 2), merged into the turn before (1), or both; an empty turn costs
    3. ``inserted`` names the roles of empty turns before it, and with a plus sign
    those after the last turn. ``rendered`` is the turn's part of the conversation's
    text: the parts joined by position are the repaired sequence. ``position`` counts
    from 0.

    Roles other than system, user and assistant, and null, must be relabelled. Null
    texts are empty. Turns with a null conv_id are one conversation. Repeated rows
    are turns like others. Empty tables give no rows; other columns are not read.
    """
    spark = turns.sparkSession
    area = WorkArea(spark, "chat")
    rows = turns.select(F.coalesce(F.col(conv_col).cast("string"), F.lit("")).alias("conv_key"), F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    order = ["conv_key", "turn", "role", F.xxhash64("text")]
    # The identifier of a row in its file only parts equal rows, whose order is of no account.
    laid = rows.withColumn("row", F.monotonically_increasing_id()).repartitionByRange(*order, "row").sortWithinPartitions(*order, "text", "row").drop("row")
    laid = area.save(laid.mapInArrow(releasing(_first_pass), LAID), "laid")
    # At most two edge pieces a partition.
    edges = laid.where("costs is not null").select("conv_key", "part", "piece", "costs", "length").collect()
    chains: dict[str, list] = {}
    for r in sorted(edges, key=lambda r: (r.part, r.piece)):
        chains.setdefault(r.conv_key, []).append(r)
    plan = {}
    for chain in chains.values():
        begin, at = START, 0
        for k, (r, end) in enumerate(zip(chain, borders([np.array(r.costs, np.int64).reshape(2, STATES, STATES) for r in chain]), strict=True)):
            plan[r.part, r.piece] = (begin, end, k == len(chain) - 1, at)
            begin, at = end, at + r.length
    inner = laid.where("not edge").select(*[c.split()[0] for c in SCHEMA.split(", ")])
    outer = laid.where("edge").groupBy("part", "piece").applyInPandas(lambda rows: _edge(rows, plan), SCHEMA)
    return inner.unionByName(outer)
