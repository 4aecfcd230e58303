"""Language identification by error-correcting output codes (operator 5).

Each language gets a codeword of bits; for each bit a binary classifier over hashed byte
n-grams (one to three bytes, letters only, ASCII lower-cased) is trained in numpy. A text's
margins are decoded to the codeword with the least weighted loss, where a bit weighs as much
as its classifier was right in training; a small lead over the runner-up flags ambiguity.

Training takes a bounded sample: for each language at most SAMPLE_PER_LANG distinct rows, or with
many languages an equal share of SAMPLE_ROWS (LEAST_PER_LANG at least), and of each text the
first SAMPLE_BYTES bytes, or with many languages an equal share of SAMPLE_TOTAL bytes. Features of
more than HELD_ROWS rows are made anew for each step, so that the driver holds the texts alone. Rows are chosen by a hash of id and text below a threshold for the
language, so that no language is gathered in one task and none is left out. The model has a
codeword and the sample a row count for each language, so more than MOST_LANGS languages are an
error, not a cut. Prediction covers every whole text; the model is a table of FEATURES x bits numbers.

Defined results: a null text, or one without a letter, gives 'und' and score 0; with no
training row at all every text gives 'und'; with one language every text with a letter gets
it; repeated rows get equal predictions; other columns are left alone.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import bound_batches, quoted
from .textbytes import LOWER, blocks, byte_class, text_buffer

FEATURES = 1 << 12
SAMPLE_PER_LANG = 400
SAMPLE_ROWS = 20_000
LEAST_PER_LANG = 20
SAMPLE_BYTES = 20_000
SAMPLE_TOTAL = 160_000_000
#: Rows of the sample whose features (FEATURES numbers each) the driver holds.
HELD_ROWS = 16_000
EPOCHS = 60
AMBIGUOUS = 0.25
MOST_LANGS = 2000
#: Texts whose features (FEATURES numbers each) are held at once.
ROWS = 512
_LETTER = byte_class(lambda b: b >= 0x80 or chr(b).isalpha())


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Square roots of the n-gram counts of each text, scaled to length 1."""
    b = np.where(_LETTER[data], LOWER[data], 0x20).astype(np.uint32)
    n = len(b)
    two = np.zeros(n, np.uint32)
    two[:-1] = b[:-1] * np.uint32(0x01000193) ^ b[1:]
    three = two.copy()
    three[:-2] = (two[:-2] * np.uint32(0x01000193)) ^ b[2:]
    slot = lambda h, s: ((h * np.uint32(0x9E3779B1) + np.uint32(s)) >> np.uint32(20)).astype(np.int64)
    grams = [slot(b + np.uint32(7), 1), slot(two, 2), slot(three, 3)]
    out = np.zeros((len(offsets) - 1, FEATURES), np.float32)
    for i, (s, e) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
        for k, g in enumerate(grams):
            if e - s > k:
                out[i] += np.bincount(g[s : e - k], minlength=FEATURES)
    np.sqrt(out, out=out)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """n codewords of +1/-1 bits: the exhaustive code up to five languages, else the best of random ones by least distance."""
    if n <= 5:
        rows = [[1 if (c >> i) & 1 else -1 for c in range(1, 1 << max(n - 1, 1))] for i in range(n)]
        return np.array(rows, np.float32).reshape(n, -1)
    rng, bits, best = np.random.default_rng(seed), int(np.ceil(10 * np.log2(n))), None
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, bits)).astype(np.float32)
        code = code[:, np.abs(code.sum(0)) < n]
        near = (code @ code.T - np.eye(n) * 1e9).max()
        if best is None or near - code.shape[1] < best[0]:
            best = (near - code.shape[1], code)
    return best[1]


class Model:
    def __init__(self, langs: list[str], code: np.ndarray, w: np.ndarray, bias: np.ndarray, weight: np.ndarray):
        self.langs, self.code, self.w, self.bias, self.weight = langs, code, w, bias, weight

    def loss(self, x: np.ndarray) -> np.ndarray:
        """Weighted logistic loss of each text against each codeword."""
        margin = x @ self.w + self.bias
        plus, minus = np.logaddexp(0, -margin), np.logaddexp(0, margin)
        on = (self.code > 0).astype(np.float32)
        return (plus * self.weight) @ on.T + (minus * self.weight) @ (1 - on).T

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the language, score, ambiguity."""
        loss = self.loss(x)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        p /= p.sum(1, keepdims=True)
        best = loss.argmin(1)
        ordered = np.sort(loss, 1)
        lead = ordered[:, 1] - ordered[:, 0] if loss.shape[1] > 1 else np.full(len(loss), np.inf)
        return best, p[np.arange(len(p)), best].astype(float), lead < AMBIGUOUS


def fit(texts: list[bytes], langs: list[str]) -> Model | None:
    """Logistic regression for every bit, by batch gradient descent with momentum; deterministic."""
    if not texts:
        return None
    names = sorted(set(langs))
    code = codewords(len(names))
    y = code[[names.index(v) for v in langs]]
    parts = [slice(a, a + ROWS) for a in range(0, len(texts), ROWS)]

    def made(part: slice) -> np.ndarray:
        return features(np.frombuffer(b"".join(texts[part]), np.uint8), np.cumsum([0, *map(len, texts[part])]))

    if len(texts) <= HELD_ROWS:
        held = np.empty((len(texts), FEATURES), np.float32)
        for part in parts:
            held[part] = made(part)
        parts, made = [slice(0, len(texts))], held.__getitem__
    w, bias = np.zeros((FEATURES, code.shape[1]), np.float32), np.zeros(code.shape[1], np.float32)
    step_w, step_b = np.zeros_like(w), np.zeros_like(bias)
    for _ in range(EPOCHS):
        sum_w, sum_b = np.zeros_like(w), np.zeros_like(bias)
        for part in parts:
            x = made(part)
            g = -y[part] / (1 + np.exp(np.clip(y[part] * (x @ w + bias), -30, 30))) / len(texts)
            sum_w += x.T @ g
            sum_b += g.sum(0)
        step_w = 0.9 * step_w - 20 * (sum_w + 1e-6 * w)
        step_b = 0.9 * step_b - 2 * sum_b
        w, bias = w + step_w, bias + step_b
    right = sum((np.sign(made(part) @ w + bias) == y[part]).sum(0) for part in parts) / len(texts)
    weight = np.clip(2 * right - 1, 0.01, 1).astype(np.float32)
    return Model(names, code, w, bias, weight / weight.mean())


def sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> list:
    """The bounded training sample, as rows (text, lang)."""
    text_, lang_ = F.col(quoted(text_col)), F.col(quoted(lang_col))
    # more characters than this are more bytes too; the bytes are cut below
    text = F.when(F.octet_length(text_) > SAMPLE_BYTES, F.substring(text_, 1, SAMPLE_BYTES)).otherwise(text_)
    use = docs.filter(lang_.isNotNull() & text_.isNotNull() & (F.octet_length(text_) > 0))
    use = use.select(lang_.cast("string").alias("lang"), text.alias("text"), F.xxhash64(F.col(quoted(id_col)).cast("string"), text_, F.lit("langid")).alias("row"))
    # one count per language: the model has a codeword for each of them anyway
    counts = use.groupBy("lang").agg(F.approx_count_distinct("row").alias("n")).limit(MOST_LANGS + 1).collect()
    if len(counts) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    share = min(SAMPLE_PER_LANG, max(SAMPLE_ROWS // max(len(counts), 1), LEAST_PER_LANG))
    # twice the share is drawn, so that the count of a language hardly falls short of it
    most = docs.sparkSession.createDataFrame([(r["lang"], int((1 << 30) * min(1.0, 2 * share / max(r["n"], 1)))) for r in counts], "lang string, most long")
    drawn = use.withColumn("draw", F.pmod("row", F.lit(1 << 30))).join(F.broadcast(most), "lang").filter(F.col("draw") < F.col("most")).drop("most")
    size = min(SAMPLE_BYTES, SAMPLE_TOTAL // (share * max(len(counts), 1)))
    drawn = drawn.withColumn("text", F.substring("text", 1, size)).dropDuplicates(["lang", "draw", "row"])
    place = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "row"))
    rows = drawn.withColumn("place", place).filter(F.col("place") <= share).orderBy("draw", "row", "lang").select("text", "lang").collect()
    return [(r["text"].encode()[:size], r["lang"]) for r in rows]


def predict(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """docs' id, lang_pred, score and ambiguous; learns from the rows for which training holds."""
    bound_batches(docs.sparkSession)
    rows = sample(docs.filter(training), id_col, text_col, lang_col)
    model = fit([t for t, _ in rows], [v for _, v in rows])
    shared = docs.sparkSession.sparkContext.broadcast(model)
    narrow = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.regexp_like(F.coalesce(F.col(quoted(text_col)), F.lit("")), F.lit(r"\p{L}")).alias("letters"), F.col(quoted(text_col)).alias("text"))

    def run(batches):
        m = shared.value
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            n = batch.num_rows
            letters = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            lang, score, vague = np.full(n, "und", object), np.zeros(n), np.zeros(n, bool)
            for a, b in blocks(offsets, rows=ROWS) if m else ():
                best, p, close = m.predict(features(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                lang[a:b] = np.array(m.langs, object)[best]
                score[a:b], vague[a:b] = p, close
            lang[~letters], score[~letters], vague[~letters] = "und", 0, False
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score), pa.array(vague)], names=["doc_id", "lang_pred", "score", "ambiguous"])

    kind = docs.schema[id_col].dataType.simpleString()
    return narrow.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, ambiguous boolean")


def query(docs: DataFrame) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % 3
    return predict(docs, fold != 1).select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 3 == 1).alias("held_out"), "lang_pred", "score", "ambiguous")
