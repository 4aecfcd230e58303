import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Texts of every awkward kind: null, empty, short, very long, repeated, near copies, odd characters; null and tied columns."""
    import random

    rng = random.Random(4)
    words = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra", "Sé", "tö") for b in ("ban", "cor", "den", "fil", "gam", "hor", "ñu")]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    base = make(300)
    long_ = make(30_000)
    passage = make(60)
    texts = [None, "", " \n\t ", "one", "two words", "a b c d", "a b c d", base, base, base.upper().lower(), base + " end", base.replace("ka", "xx", 3), long_, long_ + " tail", make(40) + "\n" + passage, make(90) + " " + passage + " " + make(10)]
    texts += ["x" * 5000, "ab" * 3000, "日本語 🙂 ▁ text\x00 with odd spaces", "### $$$ %%% " * 40, ("same line here\n") * 30, passage + passage]
    texts += [make(rng.randrange(20, 200)) for _ in range(20)]
    for k in range(12):
        w = base.split(" ")
        for _ in range(k * 2):
            w[rng.randrange(len(w))] = rng.choice(words)
        texts.append(" ".join(w))
    rows = [(i, t, ["en", "de", None][i % 3], ["s1", "s1", "s2", None][i % 4], len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def rows(documents):
    return [(r["doc_id"], r["text"]) for r in documents.collect()]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
