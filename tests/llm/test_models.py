"""The trained models against plain Python versions of what they compute."""

import math
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tideway.llm import langid, toxicity

TEXTS = ["", "one", "two words", "a b c a b c d", "Straße über, the and THE!", "x" * 300, "word " * 50 + "end", "1 2 3 été"]


def brute_logit(net, text):
    """Embeddings, filters of every width at every word (zeros beyond the end), the largest response not under 0, a logistic unit."""
    words = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)
    slots = [int(toxicity.tokens(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w.encode())]))[0][0]) for w in words]
    z = float(net.c)
    for k, width in enumerate(toxicity.WIDTHS):
        for f in range(toxicity.FILTERS):
            most = 0.0
            for i in range(len(slots)):
                r = float(net.b[k][f])
                for j in range(width):
                    if i + j < len(slots):
                        r += sum(float(net.e[slots[i + j], d]) * float(net.w[k][j, d, f]) for d in range(toxicity.DIM))
                most = max(most, r)
            z += most * float(net.v[k * toxicity.FILTERS + f])
    return z * net.scale + net.shift


def test_forward_pass():
    rng = np.random.default_rng(3)
    net = toxicity.Net()
    net.e = rng.normal(0, 1, net.e.shape).astype(np.float32)
    net.b = [rng.normal(0, 0.3, toxicity.FILTERS).astype(np.float32) for _ in toxicity.WIDTHS]
    net.scale, net.shift = 0.7, -0.2
    raw = [t.encode() for t in TEXTS]
    slots, first = toxicity.tokens(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for got, text in zip(net.logits(slots, first), TEXTS, strict=True):
        assert got == pytest.approx(brute_logit(net, text), abs=1e-3)


def test_training_steps_descend():
    """A step changes the loss of its text as the numeric gradient says."""
    net = toxicity.Net()
    net.e = np.random.default_rng(5).normal(0, 1, net.e.shape).astype(np.float32)
    slots = np.arange(7) * 11
    loss = lambda: math.log1p(math.exp(-float(net.logits(slots, np.array([0, 7]))[0])))
    for _ in range(5):
        before = loss()
        net.learn(slots, 1.0, 0.01)
        assert loss() < before


def plain_step(net, slots, y, rate):
    """Net.learn() filter by filter."""
    x = net.e[slots]
    best, pooled = [], np.zeros(len(net.v), np.float32)
    for k, h in enumerate(toxicity.WIDTHS):
        r = x @ net.w[k][0] + net.b[k]
        for j in range(1, h):
            r[: max(0, len(x) - j)] += x[j:] @ net.w[k][j]
        best.append(r.argmax(0))
        pooled[k * toxicity.FILTERS : (k + 1) * toxicity.FILTERS] = np.maximum(r.max(0), 0)
    g = np.float32(1 / (1 + np.exp(-np.clip(pooled @ net.v + net.c, -30, 30))) - y) * np.float32(rate)
    back = g * net.v * (pooled > 0)
    net.v -= g * pooled
    net.c -= g
    for k, h in enumerate(toxicity.WIDTHS):
        d = back[k * toxicity.FILTERS : (k + 1) * toxicity.FILTERS]
        net.b[k] -= d
        for j in range(h):
            at = best[k] + j
            on = np.flatnonzero((at < len(slots)) & (d != 0))
            seen = x[at[on]]
            np.add.at(net.e, slots[at[on]], -(d[on, None] * net.w[k][j][:, on].T))
            net.w[k][j][:, on] -= (d[on, None] * seen).T


def test_a_training_step_is_the_plain_one_in_less_time():
    rng = np.random.default_rng(8)
    docs = [rng.integers(0, 50, n).astype(np.int32) for n in (1, 2, 3, 4, 7, 40, 300) * 5]  # few slots, so that they repeat
    fast, slow = toxicity.Net(), toxicity.Net()
    for i, slots in enumerate(docs):
        fast.learn(slots, float(i % 2), 0.05)
        plain_step(slow, slots, float(i % 2), 0.05)
    assert toxicity.flat(fast) == pytest.approx(toxicity.flat(slow), abs=1e-5)
    longer = [rng.integers(0, toxicity.BUCKETS, 500).astype(np.int32) for _ in range(100)]

    def seconds(step):
        start = time.process_time()
        for slots in longer:
            step(slots, 1.0, 0.05)
        return time.process_time() - start

    assert min(seconds(fast.learn) for _ in range(7)) < 0.8 * min(seconds(lambda *a: plain_step(slow, *a)) for _ in range(7))


def test_scores_and_thresholds_come_from_rows_that_did_not_train(monkeypatch):
    """With labels that say nothing, a net that was judged on its own sample would look right; folds keep the scores near even."""
    rng = np.random.default_rng(7)
    texts = [f"only{i} here{i} once{i}".encode() for i in range(600)]
    labels = rng.integers(0, 2, 600).tolist()
    net, thresholds = toxicity.fit(texts, labels, ["en", None] * 300)
    p = 1 / (1 + np.exp(-toxicity.outputs(net, [toxicity.tokens(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts])))
    assert np.abs(p - 0.5).max() < 0.25 and set(thresholds) == {"en"}


def test_long_texts_and_all_rows_train(spark, monkeypatch):
    """What makes a text toxic stands in texts of over 20,000 bytes alone; the shards' nets are averaged."""
    monkeypatch.setattr(toxicity, "SHARD_ROWS", 40)
    text = F.concat(F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(30)), lambda k: F.concat(F.lit("w"), F.pmod(F.col("doc_id") * 31 + k * k, F.lit(97))))), F.when(F.col("toxic") == 1, F.concat(F.lit(" vile "), F.repeat(F.lit("and so on "), 2_500))).otherwise(""))
    rows = spark.range(0, 240, 1, 3).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 4 == 0, 1).otherwise(0).alias("toxic")).select("doc_id", "toxic", text.alias("text"), F.lit("en").alias("lang"))
    got = {r["doc_id"]: r for r in toxicity.query(rows.drop("toxic"), rows.select("doc_id", "toxic")).collect()}
    assert len(got) == 240 and all(r["predicted"] == (i % 4 == 0) for i, r in got.items()) and any(r["held_out"] for r in got.values())


def test_nets_as_rows():
    net = toxicity.Net(4)
    net.b, net.c = [b + 0.5 for b in net.b], np.float32(0.25)
    slots, first = np.arange(40) * 7, np.array([0, 11, 11, 40])
    assert np.array_equal(toxicity.unflat(toxicity.flat(net)).logits(slots, first), net.logits(slots, first))


def test_repeated_and_conflicting_labels(spark):
    docs = spark.createDataFrame([(i % 40, f"word{i % 40} " + ("vile" if i % 2 else "kind"), "en", "s") for i in range(120)] + [(None, "vile", None, None)], "doc_id long, text string, lang string, score string")
    labels = spark.createDataFrame([(i % 40, i % 2, "x") for i in range(80)] + [(3, 0, "x"), (5, None, "x"), (None, 1, "x"), (7, 2, "x")], "doc_id long, toxic int, text string")
    got = toxicity.query(docs, labels).collect()
    assert len(got) == 121 and all(0 <= r["score"] <= 1 for r in got) and len({r["score"] for r in got if r["doc_id"] == 3}) == 1


def brute_features(text):
    low = [b + 32 if 65 <= b <= 90 else b for b in text.encode()]
    b = [x if x >= 128 or chr(x).isalpha() else 32 for x in low]
    mask = (1 << 32) - 1
    out = [0] * langid.FEATURES
    for n in (1, 2, 3):
        for i in range(len(b) - n + 1):
            h = b[i] + 7 if n == 1 else b[i]
            for x in b[i + 1 : i + n]:
                h = (h * 0x01000193 & mask) ^ x
            out[((h * 0x9E3779B1 + n) & mask) >> 20] += 1
    length = math.sqrt(sum(out))
    return [math.sqrt(x) / length if length else 0.0 for x in out]


def test_features_and_decoding():
    rng = np.random.default_rng(2)
    langs = ["aa", "bb", "cc", "dd", "ee", "ff"]
    code = langid.codewords(len(langs))
    bits = code.shape[1]
    model = langid.Model(langs, code, rng.normal(0, 3, (langid.FEATURES, bits)).astype(np.float32), rng.normal(0, 0.1, bits).astype(np.float32), rng.uniform(0.2, 1, bits).astype(np.float32))
    raw = [t.encode() for t in TEXTS]
    x = langid.features(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    best, score, vague = model.predict(x)
    for i, t in enumerate(TEXTS):
        f = brute_features(t)
        assert np.allclose(x[i], f, atol=1e-5)
        margin = [sum(a * float(w) for a, w in zip(f, model.w[:, k], strict=True) if a) + float(model.bias[k]) for k in range(bits)]
        loss = [sum(float(model.weight[k]) * math.log1p(math.exp(-float(code[v, k]) * margin[k])) for k in range(bits)) for v in range(len(langs))]
        ordered = sorted(loss)
        assert loss[best[i]] == pytest.approx(ordered[0], abs=1e-3) and bool(vague[i]) == (ordered[1] - ordered[0] < langid.AMBIGUOUS)
        assert score[i] == pytest.approx(1 / sum(math.exp(ordered[0] - v) for v in loss), abs=1e-3)


def test_many_languages_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(langid, "MOST_LANGS", 3)
    df = spark.createDataFrame([(i, f"text {i}", f"l{i % 4}") for i in range(40)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        langid.sample(df, "doc_id", "text", "lang")
    assert len({v for _, v in langid.sample(df.filter(F.col("lang") != "l3"), "doc_id", "text", "lang")}) == 3


def test_odd_column_names(spark):
    rows = [(i, f"{'la le li' if i % 2 else 'sch ung ver'} word{i} text", "a" if i % 2 else "b", "x") for i in range(60)]
    df = spark.createDataFrame(rows, "`i.d` long, `t.x` string, `l.g` string, text string")
    got = langid.predict(df, F.lit(True), "i.d", "t.x", "l.g").collect()
    assert {(r["doc_id"], r["lang_pred"]) for r in got} == {(r[0], r[2]) for r in rows}
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "`i.d` long, `to.xic` int")
    assert toxicity.score(df, labels, F.lit(True), "i.d", "t.x", "l.g", "to.xic").count() == 60


def test_features_made_anew_train_the_same_model(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [bytes(rng.choice(list(b"abcdef " if i % 3 else b"uvwxyz "), 80).tolist()) for i in range(90)]
    langs = [("p", "q", "r")[i % 3] for i in range(90)]
    one = langid.fit(texts, langs)
    monkeypatch.setattr(langid, "HELD_ROWS", 10)
    monkeypatch.setattr(langid, "ROWS", 16)
    two = langid.fit(texts, langs)
    assert np.allclose(one.w, two.w, atol=1e-3) and np.allclose(one.weight, two.weight, atol=0.05)


def test_a_sample_of_many_languages_is_small(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_ROWS", 100)
    monkeypatch.setattr(langid, "LEAST_PER_LANG", 3)
    monkeypatch.setattr(langid, "SAMPLE_TOTAL", 60_000)
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("é"), "id"), 400).alias("text"), F.concat(F.lit("l"), F.col("id") % 50).alias("lang"))
    rows = langid.sample(df, "doc_id", "text", "lang")
    assert {v for _, v in rows} == {f"l{i}" for i in range(50)} and len(rows) <= 150 and sum(len(t) for t, _ in rows) <= 60_000
