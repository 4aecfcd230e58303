import hashlib
import itertools

import pytest
from pyspark.sql import functions as F

from tideway.llm import chat


def brute(roles):
    """Least (cost, sum of ranks) over every way to treat every turn."""
    best = (float("inf"), 0)
    options = [("emit", t, v) for t in (1, 2, 3) for v in (None, 1, 2, 3)] + [("merge",)]
    for plan in itertools.product(options, repeat=len(roles)):
        state, cost, ranks = chat.START, 0.0, 0
        for role, p in zip(roles, plan, strict=True):
            own = chat.ROLES.index(role) + 1 if role in chat.ROLES else None
            if p[0] == "merge":
                if state == chat.START:
                    cost = None
                    break
                cost, ranks = cost + (chat.MERGE if own == state else chat.MERGE_OTHER), ranks + 2
                continue
            _, to, via = p
            if via is not None:
                if via not in chat.LEGAL[state]:
                    cost = None
                    break
                state, cost, ranks = via, cost + chat.INSERT, ranks + 3
            if to not in chat.LEGAL[state]:
                cost = None
                break
            cost, ranks = cost + (0 if own == to else chat.RELABEL), ranks + (own != to)
            state = to
        if cost is not None:
            best = min(best, (cost, ranks) if state in chat.FINAL else (cost + chat.INSERT, ranks + 3))
    return best


@pytest.mark.parametrize("roles", [list(r) for n in (1, 2, 3) for r in itertools.product(["system", "user", "assistant", None], repeat=n)])
def test_least_cost(roles):
    m = chat.matrix(roles)
    leave = chat._exit(m)
    paid = m[chat.START, leave] + (0 if leave in chat.FINAL else chat.price(chat.INSERT, "insert"))
    assert chat.cost_of(paid) == brute(roles)[0] and paid == chat.price(*brute(roles)[:1]) + brute(roles)[1]
    assert sum(x[3] for x in chat.retrace(roles, chat.START, leave)) == m[chat.START, leave]


def test_blocks_agree(spark, monkeypatch):
    rows = [(c, t, ["user", "assistant", "user", "system", None, "tool"][(c * 7 + t * t) % 6], f"t{c}-{t}") for c in range(5) for t in range(1 + 9 * c)]
    rows += [(None, None, None, None), (None, 1, "user", "x"), (1, 0, "user", "again")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, k string".rsplit(",", 1)[0])
    whole = {r["conv_id"]: r for r in chat.repair(df).collect()}
    monkeypatch.setattr(chat, "BLOCK", 4)
    monkeypatch.setattr(chat, "FAN", 2)
    parts = {}
    for r in chat.repair(df).orderBy("block").collect():
        parts.setdefault(r["conv_id"], []).append(r)
    assert parts.keys() == whole.keys() and len(parts[4]) > 4
    for k, rs in parts.items():
        assert sum(r["cost"] for r in rs) == whole[k]["cost"]
        assert "".join(r["rendered"] for r in rs).count("<|end|>") == sum(r["n_out"] for r in rs)
        assert sum(r["n_turns"] for r in rs) == whole[k]["n_turns"]


def test_ties_and_one_hot_key(spark, monkeypatch):
    """Of equal costs the least sum of ranks; rows that share conversation and turn are cut by place, and no block is larger."""
    assert [x[0] for x in chat.retrace(["user"] * 3, chat.START, chat.USER)] == ["keep", "relabel", "keep"]
    monkeypatch.setattr(chat, "BLOCK", 8)
    rows = [(None, None, ["user", "assistant", None][i % 3], f"t{i % 5}") for i in range(200)] + [(7, -3, "user", "same")] * 50 + [(7, -3, None, None)] * 3
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5).withColumn("b", F.lit(1)).withColumn("k", F.lit("x"))
    got = chat.repair(df).orderBy("block").collect()
    assert max(r["n_turns"] for r in got) <= 8
    for conv, mine in ((None, [r for r in rows if r[0] is None]), (7, [r for r in rows if r[0] == 7])):
        part = [r for r in got if r["conv_id"] == conv]
        assert [r["block"] for r in part] == list(range(len(part))) and sum(r["n_turns"] for r in part) == len(mine)
        roles = [r[2] for r in sorted(mine, key=lambda r: (r[2] is not None, r[2] or "", hashlib.md5((r[3] or "").encode()).hexdigest()))]
        m = chat.matrix(roles)
        leave = chat._exit(m)
        paid = m[chat.START, leave] + (0 if leave in chat.FINAL else chat.price(chat.INSERT, "insert"))
        assert sum(r["cost"] for r in part) == chat.cost_of(paid)


def test_render_and_empty(spark):
    df = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")], "conv_id long, turn long, role string, text string")
    r = chat.repair(df).first()
    assert r["rendered"] == "<|user|>\na\nb<|end|>\n<|assistant|>\nc<|end|>\n" and r["cost"] == 1
    assert chat.repair(df.limit(0)).count() == 0


def test_sort_keys_hold_no_texts(spark, monkeypatch):
    """Equal turns with long texts: the frame that is range-partitioned is ordered by short keys."""
    rows = [("c", 1, "user", f"<{i}>" * 20_000) for i in range(30)]
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    seen = []
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, *by, f=type(df).repartitionByRange: seen.append((by, self.select(F.max(F.length("d")), F.max(F.length("role"))).first())) or f(self, *by))
    got = chat.repair(df).collect()
    (by, longest), = seen
    assert by == ("k", "turn", "role", "d", "r") and tuple(longest) == (32, 4)
    order = sorted((r[3] for r in rows), key=lambda t: hashlib.md5(t.encode()).hexdigest())
    body = "".join(r["rendered"] for r in sorted(got, key=lambda r: r["block"]))
    assert [body.index(t) for t in order] == sorted(body.index(t) for t in order)
