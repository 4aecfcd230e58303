import re
from collections import Counter, defaultdict

import numpy as np

from tideway.llm import graph, jaccard


def brute(rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^ \t\n\x0b\x0c\r]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))) if w else frozenset()
    parent = {i: i for i in sets}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for i, s in sets.items():
        shared = Counter(j for g in s for j in where[g])
        for j, n in shared.items():
            if 100 * n >= 80 * (len(s) + len(sets[j]) - n):
                a, b = top(i), top(j)
                parent[max(a, b)] = min(a, b)
        for g in s:
            where[g].append(i)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def test_against_brute_force(documents, rows):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(documents).collect()}
    assert got == brute(rows)


def test_links_that_no_pivot_sees(spark):
    """A chain of edits: neighbours link, ends do not; and a second family that shares a passage."""
    words = [f"w{i}" for i in range(200)]
    texts = []
    for k in range(8):
        texts.append(" ".join([f"n{k}x{i}" if i < 12 * k else w for i, w in enumerate(words)]))
    for k in range(6):
        texts.append(" ".join(words[150:] + [f"m{i}" for i in range(120)] + [f"z{k}y{i}" for i in range(3 * k)]))
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()}
    assert got == brute(rows)


def test_null_ids_repeats_and_clashing_columns(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(None, t, 1), (5, t, 2), (5, t, 2), (9, t + " x", 3), (7, None, 4)], "doc_id long, text string, component long")
    got = sorted(((r["doc_id"] or 0, r["component_id"]) for r in jaccard.join(df).collect()), key=str)
    assert got == [(0, None), (5, 5), (5, 5), (7, 7), (9, 5)]
    assert sorted(r["doc_id"] or 0 for r in jaccard.keep_first(df).collect()) == [0, 5, 5, 7]
    assert jaccard.keep_first(df).columns == df.columns


def test_many_rows_of_one_id(spark):
    """A third of the rows share an id and a text, a third an id and near copies, and links run through the shared ids."""
    w = [f"w{i}" for i in range(60)]
    near = lambda k: " ".join([*w[:50], f"e{k}", *w[51:]])
    other = " ".join(f"o{i}" for i in range(40))
    rows = [(8, " ".join(w))] * 2000 + [(7, near(k)) for k in range(2000)] + [(7, other), (3, other + " end"), (5, "alone"), (None, other)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["component_id"]) for r in jaccard.join(df).collect()}
    assert got == {(8, 3), (7, 3), (3, 3), (5, 5), (None, None)}
    assert jaccard.join(df).count() == len(rows)


def test_pipeline_keeps_one_row_of_each_group(spark):
    import corpus_pipeline

    t, u, v = (" ".join(f"{c}{i}" for i in range(30)) for c in "wuv")
    rows = [(None, t, 1), (5, t, 2), (5, t, 2), (9, t + " x", 3), (7, None, 4), (None, u, 5), (None, u + " x", 6), (3, v, 7), (3, u + " y", 8), (None, None, 9), (4, v, 10)]
    df = spark.createDataFrame(rows, "doc_id long, text string, component long").repartition(3)
    for docs in (df, df.union(df)):
        kept = corpus_pipeline.ngram_jaccard(spark, docs, "")
        assert kept.columns == df.columns
        assert sorted(r["component"] for r in kept.collect() if r["text"]) == [2, 7, 8]
        assert sorted(r["component"] for r in kept.collect() if not r["text"]) == sorted(r["component"] for r in docs.collect() if not r["text"])


def thue_morse(n, a="a", b="b"):
    return "".join(b if bin(i).count("1") % 2 else a for i in range(n))


def test_long_words_of_like_structure_stay_apart(spark):
    """Words on which polynomial hashes modulo a power of two collide, in both word classes."""
    from tideway.llm import decontam

    rows = [(i, " ".join(f"{p}{thue_morse(n, *ab)}" for p in ("", "x", "y", "z", "w"))) for i, (n, ab) in enumerate((n, ab) for n in (16, 63, 64, 65, 1024, 2048) for ab in ("ab", "ba"))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()} == brute(rows)
    bench = spark.createDataFrame([(str(i), t) for i, t in rows if i % 2], "item_id string, text string")
    for most in (decontam.BROADCAST_ROWS, 0):
        assert {r["row"]: r["items"] for r in decontam.find(df, bench, "doc_id", most=most).collect()} == {i: [str(i)] if i % 2 else [] for i, _ in rows}


def test_empty(empty):
    assert jaccard.join(empty).count() == 0


def test_parity_bits_bound_the_difference():
    rng = np.random.default_rng(0)
    for n in (1, 60, 500, 3000):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate([a[n // 8 :], rng.integers(0, 2**63, n // 10).astype(np.uint64)])
        x, y = (np.unpackbits(jaccard.parities(np.unique(v)).view(np.uint8), bitorder="little") for v in (a, b))
        if len(x) > len(y):
            x = x[: len(y)] ^ x[len(y) :]
        if len(y) > len(x):
            y = y[: len(x)] ^ y[len(x) :]
        assert (x ^ y).sum() <= len(np.setxor1d(a, b))


def test_components(spark):
    edges = [(5, 3), (3, 9), (9, 1), (20, 21), (22, 21), (7, 7), (None, 4)] + [(100 + i, 101 + i) for i in range(40)]
    got = {r["id"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {1: 1, 3: 1, 5: 1, 9: 1, 20: 20, 21: 20, 22: 20} | {100 + i: 100 for i in range(41)}


def test_hot_ngrams_are_ordered_last(documents, rows, monkeypatch):
    """With all buckets hot the order is another one, and the result the same."""
    monkeypatch.setattr(jaccard, "HOT", 1)
    seen = []
    monkeypatch.setattr(jaccard, "with_hot", lambda order, buckets, f=jaccard.with_hot: seen.append(f(order, buckets)) or seen[-1])
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(documents).collect()}
    assert got == brute(rows) and len(seen[0].hot) > 100
    s = np.sort(np.concatenate([seen[0].hot[:50], np.arange(50, dtype=np.uint64)]))
    assert ((seen[0].of(s) >= jaccard.SLOTS) == np.isin(s, seen[0].hot)).all() and len(set(seen[0].hot_ranks)) == len(seen[0].hot)


def test_a_hot_passage_leaves_all_prefixes_at_once(spark, monkeypatch):
    """Texts share a passage of more n-grams than a prefix holds, and an order of one rank does not know it."""
    passage = " ".join(f"p{i}" for i in range(120))
    rows = [(k, f"{passage} {' '.join(f'o{k}x{i}' for i in range(60 + k % 5))}") for k in range(60)]
    rows += [(100 + k, rows[k][1] + " end") for k in range(0, 60, 7)] + [(200, passage), (201, passage + " more"), (202, None), (203, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    monkeypatch.setattr(jaccard, "HOT", 20)
    flat = jaccard.Order(np.zeros(jaccard.SLOTS, np.int32), 0, np.zeros(0, np.uint64), np.zeros(0, np.int64))
    monkeypatch.setattr(jaccard, "order_of", lambda docs: flat)
    sizes = []

    def watched(narrow, order, f=jaccard._buckets):
        found = f(narrow, order)
        sizes.append(max((r["c"] for r in found[1].collect()), default=0))
        return found

    monkeypatch.setattr(jaccard, "_buckets", watched)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(df).collect()}
    assert got == brute(rows)
    assert len(sizes) == 2 and sizes[0] > 20 and sizes[1] <= 20
