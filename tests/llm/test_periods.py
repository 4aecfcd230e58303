import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideway.llm import periods


def brute(words):
    """Every diagonal as a whole; of diagonals over one stretch the least lag is the period."""
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    w, found = np.array([number[x] for x in words], np.int64), {}
    for q in range(1, len(w) // 4 + 1):
        edge = np.flatnonzero(np.diff(np.r_[False, w[q:] == w[:-q], False]))
        for i, j in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True):
            if j - i + q >= max(6, 4 * q):
                found.setdefault((i, j - i + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def rewritten(words, doc_id):
    h = zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i if i < a else a + (i - a) % p] for i in range(n)]


def expected(words):
    runs = brute(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    best = sorted(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))[:1]
    top = (*best[0], best[0][1] * 1000 // best[0][2]) if best else (None,) * 4
    return (len(runs), *top, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_runs_against_all_diagonals():
    rng = random.Random(5)
    for _ in range(1500):
        k = rng.randrange(1, 5)
        w = [rng.randrange(k) for _ in range(rng.randrange(70))]
        block = [rng.randrange(k) for _ in range(rng.randrange(1, 9))]
        at = rng.randrange(len(w) + 1)
        w[at:at] = block * rng.randrange(2, 9) + block[: rng.randrange(len(block) + 1)]
        assert [tuple(r) for r in periods.runs(np.array(w)).tolist()] == brute(w)


def test_texts_of_a_batch_are_apart():
    texts = [[b"a"] * 7, [b"a"] * 5, [], [b"a", b"b"] * 5, [b"b", b"a"] * 4]
    assert [[tuple(r) for r in f.tolist()] for f in periods.text_runs(texts)] == [brute(t) for t in texts]


def test_a_word_repeated_very_often():
    n = 300_000  # all pairs would be 4.5e10
    assert periods.runs(np.zeros(n, np.int64)).tolist() == [[0, n, 1]]


def row(r):
    return tuple(r[c] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"))


@pytest.mark.parametrize("block", [2 << 20, 3000])
def test_documents(documents, rows, block, monkeypatch):
    monkeypatch.setattr(periods, "TEXT_BYTES", block)
    got = {r["doc_id"]: row(r) for r in periods.query(documents).collect()}
    assert got == {i: expected(rewritten((t or "").encode().split(), i)) for i, t in rows}
    assert any(v[0] for v in got.values())


def test_planted_words(documents, rows):
    got = documents.select("doc_id", periods.planted(F.col("text"), F.col("doc_id")).alias("t")).collect()
    want = {i: rewritten((t or "").encode().split(), i) for i, t in rows}
    assert {r["doc_id"]: (r["t"] or "").encode().split() for r in got} == want
    assert any(want[i] != (t or "").encode().split() for i, t in rows)


def test_outputs_nulls_and_names(spark):
    df = spark.createDataFrame([(None, "la " * 9, 1), (None, None, 2), (3, "", None)], "`a.id` long, `b.text` string, id long")
    got = periods.detect(df, "a.id", "b.text").collect()
    by = sorted((r["n_runs"], r["collapsed"], [tuple(x) for x in r["runs"]]) for r in got)
    assert by == [(0, "", []), (0, "", []), (1, "la", [(0, 9, 1)])]


def test_empty(empty):
    assert periods.query(empty).count() == 0
