import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tideway.llm import packing

MODEL = str(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(MODEL)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def check(got, wanted, capacity):
    """got holds each piece of wanted (doc id, ids) once, sequences have no gaps and fit; the number of sequences."""
    bins = defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in bins.values():
        own.sort()
        assert [o for o, _ in own] == np.cumsum([0, *(n for _, n in own[:-1])]).tolist() and sum(n for _, n in own) <= capacity
    pieces = [(i, at // capacity, at, len(part := ids[at : at + capacity]), zlib.crc32(np.array(part, "<u4").tobytes())) for i, ids in wanted for at in range(0, len(ids), capacity)]
    key = lambda p: [str(x) for x in p]
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=key) == sorted(pieces, key=key)
    return len(bins)


@pytest.mark.parametrize("capacity,block", [(2048, 16_384), (64, 20), (256, 7)])
def test_documents(documents, rows, tokenizer, capacity, block, monkeypatch):
    monkeypatch.setattr(packing, "BLOCK", block)
    monkeypatch.setattr(packing.place, "__defaults__", (capacity, block))
    got = packing.pack(documents, capacity=capacity).collect()
    wanted = [(i, ids_of(tokenizer, t)) for i, t in rows]
    n = check(got, wanted, capacity)
    least = -(-sum(len(x) for _, x in wanted) // capacity)
    assert least <= n <= least + (1 if block > 100 else least // 8 + 1)


def test_words_give_the_ids_of_whole_texts(tokenizer):
    rng, own = random.Random(0), packing.WordIds(MODEL)
    parts = ["a", "B", "é", "É", "'s", "’", "<|startoftext|>", "<|endoftext|>", "<|", "|>", ".", ",", "!?", "́", "̸", " ", "\n", "\x1c", "\x85", "\xa0", "1", "²", "×", "日本", "🙂", "İ", "ẞ", "Σ", "ς", "-", "_", "\x00", "ﬁ", "가", "don't", "I'LL", "W̊", "x" * 80 + "."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(4000)] + ["", "x" * 70, "A, b.c " * 9]
    raw = [t.encode() for t in texts]
    for a in range(0, len(raw), 500):
        ids, cuts = own.encode(np.frombuffer(b"".join(raw[a : a + 500]), np.uint8), np.cumsum([0, *map(len, raw[a : a + 500])]))
        for text, x, y in zip(texts[a : a + 500], cuts[:-1], cuts[1:], strict=True):
            assert ids[x:y].tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_equal_hashes_of_other_words(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "word_hashes", lambda low, starts, ends: np.zeros(len(starts), np.uint64))
    text = b"one two three four"
    ids, _ = packing.WordIds(MODEL).encode(np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert ids.tolist() == tokenizer.encode(text.decode(), add_special_tokens=False).ids


def test_exchanges_add_to_squared_fill_and_empty_bins():
    rng = np.random.default_rng(1)
    gains = []
    for _ in range(40):
        size = rng.integers(15, 60, 60)
        search = packing.Search(size, packing.best_fit(size, 100), 100)
        before = int((search.fill**2).sum()), int((search.fill > 0).sum())
        bins = search.run()
        fill = np.bincount(bins, size)
        after = int((fill**2).sum()), int((fill > 0).sum())
        assert fill.max() <= 100 and after[0] >= before[0] and after[1] <= before[1] and fill.sum() == size.sum()
        gains.append(before[1] - after[1])
    assert sum(gains) > 0


@pytest.mark.parametrize("bins,want", [([[50, 30], [10, 8]], 1), ([[60, 30], [45, 40]], 2), ([[70, 20], [50, 30], [30]], 2)])
def test_known_exchanges(bins, want):
    size = np.array([x for b in bins for x in b])
    search = packing.Search(size, np.array([i for i, b in enumerate(bins) for _ in b]), 100)
    assert len(set(search.run().tolist())) == want


def test_equal_pieces_that_cannot_share():
    assert len(set(packing.pack_block(np.full(5000, 1100)).tolist())) == 5000
    assert packing.pack_block(np.zeros(0, np.int64)).tolist() == []


def test_null_and_repeated_ids_and_ids(spark, tokenizer):
    rows = [(None, "one two"), (None, "one two"), (5, None), (5, ""), (5, "three " * 40)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), capacity=16, ids=True).collect()
    check(got, [(i, ids_of(tokenizer, t)) for i, t in rows], 16)
    assert all(zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in got)


def test_empty_and_names(empty, spark):
    assert packing.query(empty).count() == 0
    df = spark.createDataFrame([("k", "some text", 1)], "`a.b` string, `t.x` string, item long")
    assert packing.pack(df, "a.b", "t.x").collect()[0]["a.b"] == "k"
