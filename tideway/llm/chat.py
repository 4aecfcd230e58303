"""Chat formatting with minimum-cost role repair (operator 8).

Legal conversations are words of an automaton over roles: an optional system turn, then user
and assistant in turn, from the user on. A dynamic program chooses, for every turn, to keep
its role, relabel it, merge it into the turn before, or insert an empty turn before it, so
that the sum of the costs is least; the repaired turns are then rendered with a template.

The program's step is a matrix in the (min, +) algebra over the automaton's states, and such
products can be cut anywhere. So the turns are sorted over all tasks by (conversation, turn,
role, digest of the text), so that the sort's bounds hold no texts, and cut into blocks of at most BLOCK rows of one
conversation. Blocks give their matrices, FAN neighbours are combined at a time until one is
left per conversation, the best states at the cuts are handed back down, and every block
retraces its own path. A conversation of any length, and rows that all share one key, are
spread over tasks, and rendered in as many rows as there are blocks, to be joined in order.

Defined results: turns are ordered by (turn, role, MD5 of the text), nulls first, and repeated rows are
turns of their own; a null or unknown role always needs a relabel or merge, a null text is
empty; negative and equal turn numbers are like others; a null conversation id is one
conversation; an empty table gives an empty result; other columns are left alone. Of equal
costs the repair wins whose actions have the least sum of ranks (keep 0, relabel 1, merge 2,
insert 3), and of equal sums the one whose states are the lowest, from the last turn to the first.
"""

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import bound_batches, materialize, quoted, scope

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = (USER, ASSISTANT)
RELABEL, MERGE, MERGE_OTHER, INSERT = 2.0, 1.0, 2.5, 3.0
RANKS = {"keep": 0, "relabel": 1, "merge": 2, "insert": 3}
#: A price is twice the cost times UNIT plus the ranks, so that one sum compares costs first; it is exact up to 2**24 turns of a conversation.
UNIT = 1 << 26
BLOCK = 256
FAN = 64
INF = float("inf")


def price(cost: float, *actions: str) -> float:
    return 2 * cost * UNIT + sum(RANKS[a] for a in actions)


def cost_of(price_: float) -> float:
    return price_ // UNIT / 2


def moves(role: str | None) -> list[list[tuple]]:
    """For each state before a turn: (price, state after, action, inserted roles), best first."""
    own = ROLES.index(role) + 1 if role in ROLES else None
    out = []
    for state in range(4):
        found = []
        for to in (SYSTEM, USER, ASSISTANT):
            say, action = (0.0, "keep") if to == own else (RELABEL, "relabel")
            if to in LEGAL[state]:
                found.append((price(say, action), to, action, ()))
            for via in LEGAL[state]:
                if to in LEGAL[via]:
                    found.append((price(say + INSERT, action, "insert"), to, action, (via,)))
        if state != START:
            found.append((price(MERGE if state == own else MERGE_OTHER, "merge"), state, "merge", ()))
        out.append(sorted(found))
    return out


_MOVES = {r: moves(r) for r in (*ROLES, None)}


def _of(role):
    return _MOVES[role if role in ROLES else None]


def _step(role) -> np.ndarray:
    m = np.full((4, 4), INF)
    for s, found in enumerate(_of(role)):
        for cost, to, *_ in found:
            m[s, to] = min(m[s, to], cost)
    return m


_STEPS = {r: _step(r) for r in (*ROLES, None)}


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).min(1)


def matrix(roles: list) -> np.ndarray:
    m = np.where(np.eye(4) > 0, 0.0, INF)
    for r in roles:
        m = product(m, _STEPS[r if r in ROLES else None])
    return m


def path(steps: list[np.ndarray], enter: int, leave: int) -> list[int]:
    """The states at all cuts of a cheapest way from enter to leave; of equals the lowest state last to first."""
    cost = np.full(4, INF)
    cost[enter] = 0
    costs = [cost]
    for m in steps:
        costs.append((costs[-1][:, None] + m).min(0))
    states = [leave]
    for m, c in zip(reversed(steps), reversed(costs[:-1]), strict=True):
        states.append(int((c + m[:, states[-1]]).argmin()))
    return states[::-1]


def retrace(roles: list, enter: int, leave: int) -> list[tuple]:
    """(action, state after, inserted roles, price) of every turn of a block."""
    states = path([_STEPS[r if r in ROLES else None] for r in roles], enter, leave)
    out = []
    for r, a, b in zip(roles, states[:-1], states[1:], strict=True):
        paid, to, action, inserted = next(m for m in _of(r)[a] if m[1] == b)
        out.append((action, to, inserted, paid))
    return out


def _groups(batches, keys: int):
    """Runs of rows that agree in the first columns; at most one run is held."""
    key, rows = None, []
    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for row in zip(*columns, strict=True):
            if row[:keys] != key:
                if rows:
                    yield key, rows
                key, rows = row[:keys], []
            rows.append(row[keys:])
    if rows:
        yield key, rows


def _table(rows: list, schema: pa.Schema):
    for a in range(0, len(rows), 2000):
        part = rows[a : a + 2000]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*part, strict=True), schema, strict=True)], schema=schema)


def _mapped(df: DataFrame, keys: list[str], order: list, run, schema: str, types: list):
    """run(key, rows) over the groups of keys, streamed from a sort within hash partitions."""
    names = [x.split()[0] for x in schema.split(", ")]
    arrow = pa.schema(list(zip(names, types, strict=True)))

    def stream(batches):
        held = []
        for key, rows in _groups(batches, len(keys)):
            held += run(key, rows)
            if len(held) >= 2000:
                yield from _table(held, arrow)
                held = []
        if held:
            yield from _table(held, arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(stream, schema)


_MATRIX = "k string, b long, m array<double>"
_MATRIX_TYPES = [pa.string(), pa.int64(), pa.list_(pa.float64())]
_ENDS = "k string, b long, enter int, leave int"
_ENDS_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.int32()]


def _exit(m: np.ndarray) -> int:
    """The cheapest last state: one that may end, or one to be followed by an empty user turn."""
    costs = [m[START, s] + (0 if s in FINAL else price(INSERT, "insert")) for s in range(4)]
    return int(np.argmin(costs))


def _numbered(keyed: DataFrame) -> DataFrame:
    """The rows (k, turn, role, text) in blocks of at most BLOCK, numbered in order over all conversations: k, b, at (place in the task's order), role, text."""
    # a written number parts equal rows, so that the sort can spread them too; any order of them gives the same result
    rows = materialize(keyed.withColumns({"d": F.md5(F.col("text").cast("binary")), "r": F.monotonically_increasing_id()}))
    by = ["k", "turn", "role", "d", "r"]

    def cut(batches):
        task, key, own, at = TaskContext.get().partitionId(), None, -1, 0
        for batch in batches:
            blocks, places = [], []
            for k in batch.column(0).to_pylist():
                if k != key or at == BLOCK:
                    key, own, at = k, own + 1, 0
                blocks.append(own)
                places.append(at)
                at += 1
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([task] * n, pa.int32()), pa.array(blocks, pa.int64()), pa.array(places, pa.int32()), batch.column(2), batch.column(3)], names=["k", "task", "own", "at", "role", "text"])

    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by)
    rows = materialize(ranged.select("k", "turn", "role", "text").mapInArrow(cut, "k string, task int, own long, at int, role string, text string"))
    # one row per task
    tasks = rows.groupBy("task").agg((F.max("own") + 1).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = F.broadcast(tasks.select("task", before.alias("first")))
    return rows.join(tasks, "task").select("k", (F.col("own") + F.col("first")).alias("b"), "at", "role", "text")


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per block of a conversation: conv_id, block, n_turns, cost, n_relabels, n_merges, n_inserts, n_out, rendered."""
    bound_batches(turns.sparkSession)
    with scope(turns.sparkSession):
        return _repair(turns, conv_col, turn_col, role_col, text_col)


def _repair(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    kind = turns.schema[conv_col].dataType
    col = lambda c: F.col(quoted(c))
    keyed = _numbered(turns.select(
        F.coalesce(F.concat(F.lit("="), col(conv_col).cast("string")), F.lit("")).alias("k"),
        col(turn_col).cast("long").alias("turn"), col(role_col).cast("string").alias("role"), F.coalesce(col(text_col), F.lit("")).alias("text"),
    ))
    level = materialize(_mapped(keyed.select("k", "b", "at", "role"), ["k", "b"], ["at"], lambda key, rows: [(*key, matrix([r[1] for r in rows]).ravel().tolist())], _MATRIX, _MATRIX_TYPES))
    several = lambda level: not level.groupBy("k").count().filter("count > 1").isEmpty()
    levels = [level]
    as_matrix = lambda m: np.array(m).reshape(4, 4)
    while several(level):

        def combine(key, rows):
            m = as_matrix(rows[0][1])
            for _, x in rows[1:]:
                m = product(m, as_matrix(x))
            return [(*key, m.ravel().tolist())]

        up = level.select("k", F.floor(F.col("b") / FAN).cast("long").alias("p"), "b", "m")
        level = materialize(_mapped(up, ["k", "p"], ["b"], combine, _MATRIX, _MATRIX_TYPES))
        levels.append(level)

    def top(key, rows):
        return [(*key, START, _exit(as_matrix(rows[0][0])))]

    ends = _mapped(levels[-1], ["k", "b"], [], top, _ENDS, _ENDS_TYPES)
    for below in reversed(levels[:-1]):

        def hand_down(key, rows):
            states = path([as_matrix(m) for _, m, _, _ in rows], rows[0][2], rows[0][3])
            return [(key[0], b, s, t) for (b, *_), s, t in zip(rows, states[:-1], states[1:], strict=True)]

        parent = ends.select("k", F.col("b").alias("p"), "enter", "leave")
        joined = below.withColumn("p", F.floor(F.col("b") / FAN).cast("long")).join(parent, ["k", "p"]).select("k", "p", "b", "m", "enter", "leave")
        ends = materialize(_mapped(joined, ["k", "p"], ["b"], hand_down, _ENDS, _ENDS_TYPES))
    of_k = levels[0].groupBy("k").agg(F.min("b").alias("first"), F.max("b").alias("last"))
    ends = materialize(ends.join(of_k, "k").select("k", "b", "enter", "leave", (F.col("b") == F.col("last")).alias("ends"), (F.col("b") - F.col("first")).alias("block")))

    def render(key, rows):
        enter, leave, ends_here, block = rows[0][3:7]
        out, open_, paid, count = [], enter != START, 0.0, dict.fromkeys(RANKS, 0)

        def start(role: int):
            nonlocal open_
            out.append(("<|end|>\n" if open_ else "") + f"<|{ROLES[role - 1]}|>\n")
            open_ = True

        made = 0
        for (_, _, text, *_), (action, to, inserted, spent) in zip(rows, retrace([r[1] for r in rows], enter, leave), strict=True):
            for x in inserted:
                start(x)
                made, count["insert"] = made + 1, count["insert"] + 1
            if action == "merge":
                out.append("\n")
            else:
                start(to)
                made += 1
            out.append(text)
            count[action] += 1
            paid += spent
        if ends_here:
            if leave not in FINAL:
                start(USER)
                made, count["insert"], paid = made + 1, count["insert"] + 1, paid + price(INSERT, "insert")
            out.append("<|end|>\n")
        return [(key[0], block, len(rows), cost_of(paid), count["relabel"], count["merge"], count["insert"], made, "".join(out))]

    joined = keyed.join(ends, ["k", "b"]).select("k", "b", "at", "role", "text", "enter", "leave", "ends", "block")
    schema = "k string, block long, n_turns long, cost double, n_relabels long, n_merges long, n_inserts long, n_out long, rendered string"
    done = _mapped(joined, ["k", "b"], ["at"], render, schema, [pa.string(), pa.int64(), pa.int64(), pa.float64(), *[pa.int64()] * 4, pa.string()])
    conv = F.when(F.col("k") != "", F.substr("k", F.lit(2))).cast(kind).alias("conv_id")
    return materialize(done.select(conv, "block", "n_turns", "cost", "n_relabels", "n_merges", "n_inserts", "n_out", "rendered"), keep=True)
