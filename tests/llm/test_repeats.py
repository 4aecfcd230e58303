import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tideway.llm import repeats


def brute(rows, span=200):
    times = Counter()
    for _, t in rows:
        b = (t or "").encode()
        times.update(b[k : k + span] for k in range(len(b) - span + 1))
    out = {}
    for i, t in rows:
        b = (t or "").encode()
        hit = np.zeros(len(b), bool)
        for k in range(len(b) - span + 1):
            if times[b[k : k + span]] > 1:
                hit[k : k + span] = True
        kept = np.frombuffer(b, np.uint8)[~hit].tobytes()
        out[i] = (len(b), int(hit.sum()), int((hit & ~np.r_[False, hit[:-1]]).sum()) if len(b) else 0, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("limit", [256, 3, 1])
def test_against_brute_force(documents, rows, limit, monkeypatch):
    """Also with buckets that are cut into blocks (3) and into windows (1)."""
    monkeypatch.setattr(repeats, "LIMIT", limit)
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 20_000)  # the long texts are searched in pieces
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove(documents).collect()}
    assert got == brute(rows)


def test_equal_rows_and_null_ids(spark):
    t = "abcdefghij" * 3 + "".join(chr(97 + (i * i) % 26) for i in range(300))
    df = spark.createDataFrame([(1, t), (1, t), (None, "z" + t), (2, None)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in repeats.remove(df).collect())
    assert got == [(0, len(t)), (1, len(t)), (1, len(t)), (2, 0)]


def test_many_equal_rows_are_searched_once(spark, monkeypatch):
    """Rows without an id that repeat one text share a passage with another text."""
    passage = "".join(chr(97 + (i * i * i + 3 * i) % 26) for i in range(2000))[:400]
    rows = [(None, "head " + passage + " tail")] * 3000 + [(1, passage + " and more"), (2, "none of it")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    counts = []
    monkeypatch.setattr(repeats, "_search", lambda b, f=repeats._search: counts.append((b.count(), b.select("gram", "seg", "off").distinct().count())) or f(b))
    got = {(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove(df).collect()}
    assert got == {(i, *v) for i, v in brute([rows[0], *rows[2999:]]).items()} and repeats.remove(df).count() == len(rows)
    assert all(a == b for a, b in counts)


def test_empty(empty):
    assert repeats.remove(empty).count() == 0


def test_maximal_repeats_have_all_occurrences():
    core = bytes(range(33, 123)) * 3
    a, b, c = b"A" * 10 + core + b"B" * 10, b"C" * 10 + core + b"D" * 10, b"E" * 5 + core[20:] + b"F" * 5
    found = repeats.maximal_repeats([a, b, c])
    whole = [sorted(w) for n, w in found if n == len(core)]
    assert [(0, 10), (1, 10)] in whole
    part = next(sorted(w) for n, w in found if n == len(core) - 20)
    assert {(0, 30), (1, 30), (2, 5)} <= set(part)
    for n, where in found:
        texts = [(a, b, c)[m][o : o + n] for m, o in where]
        assert len(set(texts)) == 1 and n >= repeats.SPAN


def test_intervals():
    assert sorted(repeats.intervals(np.array([3, 5, 5, 1, 4, 0]), 2)) == [(3, 0, 4), (4, 4, 6), (5, 1, 4)]


def thue_morse(a, b, n):
    word = [a]
    while len(word) < n:
        word += [b if c == a else a for c in word]
    return bytes(word[:n])


def test_structured_texts_without_a_common_window(spark):
    """Two texts of 128-letter Thue-Morse blocks around one gram, with the letters swapped in the other: no 200 bytes are equal."""
    rng = random.Random(8)
    rows = []
    for k in range(60):
        gram = bytes(rng.randrange(33, 127) for _ in range(50))
        a, b = rng.sample(range(33, 127), 2)
        for one, two in ((a, b), (b, a)):
            rows.append((len(rows), (thue_morse(one, two, 150) + gram + thue_morse(two, one, 150)).decode()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in repeats.remove(df).collect()}
    assert got == brute(rows)


def test_hashes_tell_structured_stretches_apart():
    """A polynomial of single bytes modulo 2**64 gives the swapped Thue-Morse word the same hash for half of all letter pairs or more."""
    seen = set()
    for a in range(33, 53):
        for b in range(a + 1, 53):
            data = np.frombuffer(thue_morse(a, b, 2048) + thue_morse(b, a, 2048), np.uint8)
            at = np.arange(0, 4096, 128)
            h = repeats.Hasher(data).of(at, at + 128)
            first = {data[i : i + 128].tobytes(): int(x) for i, x in zip(at, h, strict=True)}
            assert len(set(first.values())) == len(first) == 2 and not seen & set(first.values())
            seen |= set(first.values())


def test_equal_stretches_have_equal_hashes():
    rng = np.random.default_rng(0)
    data = rng.integers(0, 256, 3000).astype(np.uint8)
    two = np.concatenate([rng.integers(0, 256, 77).astype(np.uint8), data, rng.integers(0, 256, 9).astype(np.uint8)])
    at = np.arange(0, 2700, 7)
    for n in (8, 50, 200, 275):
        assert (repeats.Hasher(data).of(at, at + n) == repeats.Hasher(two).of(at + 77, at + 77 + n)).all()


def test_a_search_sorts_a_text_for_each_member_not_for_each_window(monkeypatch):
    """The order of the suffixes at other distances before the gram is induced, and finds the windows that brute force finds."""
    rng, members, bucket, place = random.Random(5), [], [], []
    for k in range(40):
        base = bytes(rng.choice(b"abc") for _ in range(350))
        for _ in range(rng.choice((1, 2, 2, 3, 9))):
            near = rng.randrange(0, 100)
            far = rng.randrange(near, 151)
            text = bytearray(base)
            for _ in range(rng.choice((0, 0, 1, 1, 3))):
                text[rng.choice((rng.randrange(150), rng.randrange(200, 350)))] = rng.choice(b"abc\0")
            members.append(bytes(text[150 - far : 150 - near + repeats.SPAN]))
            bucket.append(k)
            place.append(far)
    windows = lambda i: [(bucket[i], place[i] - o, members[i][o : o + repeats.SPAN]) for o in range(len(members[i]) - repeats.SPAN + 1)]
    times = Counter(w for i in range(len(members)) for w in windows(i))
    want = {(i, o) for i in range(len(members)) for o, w in enumerate(windows(i)) if times[w] > 1}
    texts = []
    monkeypatch.setattr(repeats, "_sorted", lambda text, start, *a, f=repeats._sorted: texts.append(len(start)) or f(text, start, *a))
    size = np.array([len(m) for m in members])
    found = zip(*repeats.covered(np.frombuffer(b"".join(members), np.uint8), size, np.array(bucket), np.array(place)), strict=True)
    assert {(i, o) for i, lo, hi in found for o in range(lo, hi)} == want and 0 < len(want) < sum(times.values())
    assert texts == [len(members)]
