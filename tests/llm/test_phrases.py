import random
import re
from collections import Counter

import numpy as np
import pytest

from tideway.llm import phrases


def brute(rows, least, best):
    """rows: (lang, text). The contract word for word, in integers."""
    out = []
    texts = {}
    for lang, text in rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        texts.setdefault(lang or "und", []).extend(re.findall(r"[^ \t]+", p) for p in re.split(r"[.,;:!?\n-\r]", lower))
    for lang, pieces in texts.items():
        f = Counter(tuple(p[i : i + k]) for p in pieces for k in range(1, 6) for i in range(len(p) - k + 1))
        n = sum(map(len, pieces))
        frequent = {p: a for p, a in f.items() if a >= least}
        inside = Counter()
        for p, a in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], a)
        found = []
        for p, a in frequent.items():
            if len(p) > 1 and 100 * inside[p] < 100 * a:
                score, _, l_, r = min((1000 * a * n // (f[p[:c]] * f[p[c:]]), c, f[p[:c]], f[p[c:]]) for c in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), l_, r))
        out += [(lang, i + 1, p.decode(), -a, l_, r, n, -s) for i, (s, a, p, l_, r) in enumerate(sorted(found)[:best])]
    return sorted(out)


def result(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("least,best,trie,dictionary", [(3, 2000, 1 << 20, 1 << 21), (2, 7, 5, 9), (5, 50, 400, 30)])
def test_documents(documents, least, best, trie, dictionary, monkeypatch):
    """Also with many small tries and dictionaries."""
    monkeypatch.setattr(phrases, "TRIE", trie)
    monkeypatch.setattr(phrases, "DICTIONARY", dictionary)
    small = documents.filter("n_chars < 50000")
    if trie < 10:
        small = small.filter("n_chars < 400")
    want = brute([(r["lang"], r["text"]) for r in small.collect()], least, best)
    assert result(phrases.mine(small, least=least, best=best)) == want and want


def test_ties_nulls_and_case(spark):
    rows = [(None, "A b. a B; c d\tC D!é f é f")] * 2 + [("x", None), ("x", "")]
    df = spark.createDataFrame(rows, "`l.g` string, `t.x` string")
    assert result(phrases.mine(df, "l.g", "t.x", least=2)) == brute(rows, 2, 2000)


def test_empty(empty):
    assert phrases.query(empty).count() == 0


def test_trie_against_sets():
    rng = np.random.default_rng(3)
    for _ in range(150):
        k, v = int(rng.integers(2, 6)), int(rng.integers(1, 12))
        x = rng.integers(-1, v, int(rng.integers(0, 120))).astype("<i4")
        wanted = {tuple(p) for p in rng.integers(0, v, (int(rng.integers(1, 60)), k)).tolist()}
        trie = phrases.Trie(np.array(sorted(wanted), np.int32))
        at, row = trie.walk(x)
        got = {(a, tuple(trie.phrases[r].tolist())) for a, r in zip(at.tolist(), row.tolist(), strict=True)}
        assert got == {(i, p) for i in range(len(x) - k + 1) if (p := tuple(x[i : i + k].tolist())) in wanted}


def test_distinct():
    rng = random.Random(2)
    x = np.array([rng.randrange(3) for _ in range(200)], "<i4")
    rows, times = phrases.distinct(x, np.arange(197), 4)
    assert Counter({tuple(r): n for r, n in zip(rows.tolist(), times.tolist(), strict=True)}) == Counter(tuple(x[i : i + 4].tolist()) for i in range(197))
