"""Toxicity by a convolutional text classifier in numpy (operator 1).

Words are hashed into BUCKETS embeddings of DIM numbers; filters of one, two and three words
slide over a text, the largest response of each filter is kept (max pooling over the whole
text), and a logistic unit turns them into a score, scaled so that 0.5 is the balance point.
The first embedding number starts as the word's log-odds in the training rows,
less their doubt;
everything is then trained by stochastic gradient descent. Besides the common 0.5, a
threshold is calibrated for each language (best F1); the language never enters the score,
only the extra column flagged. The scale of the score and the thresholds are fitted on
rows that did not train: the rows are cut into FOLDS parts by their texts, and each part's outputs come
from a net that was trained on the others. The net that scores is trained on all of them.

Training reads every labelled row and every whole text. The rows lie in shards of SHARD_ROWS or more; in each
epoch a task trains copies of the nets on its shard, and the changes are averaged over the shards, those of a
word's embedding over the shards that changed it. Only nets, of fixed size, and sums come to the driver.

Defined results: a null or empty text, or one without a word, gets the score of an empty
text (no filter responds); without training rows of both classes every score is 0; rows with
a null label are not learnt from, nor are null texts; each text of an id is learnt from once for
each of the id's different labels; repeated rows get equal scores; a language that was not
seen uses 0.5.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import bound_batches, materialize, quoted, scope
from .textbytes import ALNUM, Words, blocks, text_buffer

BUCKETS = 1 << 18
DIM = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
#: Of the weights of all widths in a row (one word's each): the first of each width, for each its width and its place in the filter, and the responses' rows.
STARTS = np.cumsum([0, *WIDTHS[:-1]]).tolist()
WIDTH_OF, PLACE_OF = np.repeat(np.arange(len(WIDTHS)), WIDTHS), np.concatenate([np.arange(h) for h in WIDTHS])[:, None]
ROW_OF = np.array(STARTS)[:, None] * FILTERS + np.arange(FILTERS)
EPOCHS = 3
FOLDS = 3
RATE = 0.05
#: Standard errors by which log-odds are drawn towards 0: rare words start at 0.
DOUBT = 2.5
#: Rows of a shard, at least where there are as many.
SHARD_ROWS = 4000
#: Words of a shard that are held, and shuffled, at a time.
HELD_WORDS = 1 << 24
#: Newton steps of the scale, at most.
STEPS = 30
#: Thresholds that are tried.
GRID = np.linspace(0.05, 0.95, 19)
#: Languages whose thresholds are broadcast.
FEW_LANGS = 100_000


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Embedding slots of all words of a block, and the first word of each text."""
    w = Words(data, offsets, ALNUM)
    return (w.hashes >> np.uint64(46)).astype(np.int64), w.first


class Net:
    def __init__(self, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.e = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
        self.w = [rng.normal(0, 0.2, (h, DIM, FILTERS)).astype(np.float32) for h in WIDTHS]
        self.b = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.v = rng.normal(0, 0.1, len(WIDTHS) * FILTERS).astype(np.float32)
        self.w[0][0, :, 0], self.v[0] = 0, 1
        self.w[0][0, 0, 0] = 1
        self.c, self.scale, self.shift = np.float32(-2), 1.0, 0.0

    def _responses(self, x: np.ndarray, k: int, last: np.ndarray) -> np.ndarray:
        """Filter responses of width WIDTHS[k] at every word; beyond a text's end there are zeros."""
        out = x @ self.w[k][0] + self.b[k]
        for j in range(1, WIDTHS[k]):
            more = x[j:] @ self.w[k][j]
            more[np.arange(len(more)) + j > last[: len(more)]] = 0
            out[: len(more)] += more
        return out

    def pooled(self, slots: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Largest responses, not under 0, of each text of a block."""
        out = np.zeros((len(first) - 1, len(WIDTHS) * FILTERS), np.float32)
        some = np.flatnonzero(np.diff(first))
        if len(some):
            x = self.e.take(slots, axis=0)
            last = np.repeat(first[1:] - 1, np.diff(first))
            for k in range(len(WIDTHS)):
                most = np.maximum.reduceat(self._responses(x, k, last), first[some], axis=0)
                out[some, k * FILTERS : (k + 1) * FILTERS] = np.maximum(most, 0)
        return out

    def logits(self, slots, first) -> np.ndarray:
        return (self.pooled(slots, first) @ self.v + self.c) * self.scale + self.shift

    def learn(self, slots: np.ndarray, y: float, rate: float) -> None:
        """One step of gradient descent on one text with at least one word."""
        x, w, n = self.e.take(slots, axis=0), np.concatenate(self.w), len(slots)  # take: ten times as fast as indexing here
        r = (w.transpose(0, 2, 1).reshape(-1, DIM) @ x.T).reshape(len(w), FILTERS, n)  # words side by side, so that maxima run along memory
        best = np.empty((len(WIDTHS), FILTERS), np.int64)
        for k, (a, h) in enumerate(zip(STARTS, WIDTHS, strict=True)):
            for j in range(1, min(h, n)):
                r[a, :, : n - j] += r[a + j, :, j:]
            best[k] = r[a].argmax(1)
        pooled = np.maximum(r.take(ROW_OF * n + best).ravel() + np.concatenate(self.b), 0)
        g = np.float32((1 / (1 + math.exp(-min(30.0, max(-30.0, float(pooled @ self.v + self.c))))) - y) * rate)
        back = (g * self.v * (pooled > 0)).reshape(len(WIDTHS), FILTERS)
        self.v -= g * pooled
        self.c -= g
        for k in range(len(WIDTHS)):
            self.b[k] -= back[k]
        at, d = best[WIDTH_OF] + PLACE_OF, back[WIDTH_OF]
        q, f = np.nonzero((at < n) & (d != 0))
        at, d = at[q, f], d[q, f, None]
        # as numbers in a row, which numpy adds up the fastest; a slot may come more than once
        np.add.at(self.e.reshape(-1), (slots[at, None].astype(np.int64) * DIM + np.arange(DIM)).ravel(), (-d * w[q, :, f]).ravel())
        w[q, :, f] -= d * x[at]
        self.w = [w[a : a + h] for a, h in zip(STARTS, WIDTHS, strict=True)]


def start(df: np.ndarray, n0: float, n1: float) -> Net:
    """A net before training, from the numbers of rows of label 0 and 1 with a word in each slot, and of all."""
    net = Net()
    odds = np.log((df[1] + 0.5) / (n1 + 1)) - np.log((df[0] + 0.5) / (n0 + 1))
    doubt = np.sqrt(1 / (df[1] + 0.5) + 1 / (df[0] + 0.5))
    net.e[:, 0] = np.clip(np.sign(odds) * np.maximum(np.abs(odds) - DOUBT * doubt, 0), -4, 4)
    return net


def train(docs: list[np.ndarray], y: np.ndarray) -> Net:
    """A net from texts (slots of their words) and labels."""
    df = np.zeros((2, BUCKETS))
    for slots, label in zip(docs, y.astype(int), strict=True):
        df[label, np.unique(slots)] += 1
    net, rng = start(df, len(y) - y.sum(), y.sum()), np.random.default_rng(2)
    for epoch in range(EPOCHS):
        for i in rng.permutation(len(docs)):
            if len(docs[i]):
                net.learn(docs[i], y[i], RATE / (1 + epoch))
    return net


def outputs(net: Net, docs: list[np.ndarray]) -> np.ndarray:
    first = np.concatenate([[0], np.cumsum([len(d) for d in docs])])
    return np.concatenate([net.logits(np.concatenate(docs[a : a + 50]), first[a : a + 51] - first[a]) for a in range(0, len(docs), 50)])


def fit(texts: list[bytes], labels: list[int], langs: list[str | None]) -> tuple[Net, dict] | None:
    """The trained net and the threshold of each language, from rows in memory: one shard of what fit_rows() does."""
    y = np.array(labels, np.float64)
    if not len(y) or y.min() == y.max():
        return None
    docs = [tokens(np.frombuffer(t, np.uint8), np.array([0, len(t)]))[0] for t in texts]
    fold = np.empty(len(y), int)  # the classes are dealt out evenly; equal texts go together
    where: dict[bytes, int] = {}
    for label in (0, 1):
        for i in np.flatnonzero(y == label):
            fold[i] = where.setdefault(texts[i], len(where) % FOLDS)
    z = np.zeros(len(y))
    for f in range(FOLDS):
        out, rest = np.flatnonzero(fold == f), np.flatnonzero(fold != f)
        if len(out) and len(set(y[rest])) == 2:
            z[out] = outputs(train([docs[i] for i in rest], y[rest]), [docs[i] for i in out])
    net = train(docs, y)
    a, b = 1.0, 0.0
    for _ in range(STEPS):  # logistic regression on the logit, by Newton steps with a weak prior
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        s = p * (1 - p) + 1e-6
        grad = np.array([((p - y) * z).sum() + 0.1 * (a - 1), (p - y).sum() + 0.1 * b])
        hess = np.array([[(s * z * z).sum() + 0.1, (s * z).sum()], [(s * z).sum(), s.sum() + 0.1]])
        a, b = np.array([a, b]) - np.linalg.solve(hess, grad)
    net.scale, net.shift = float(a), float(b)
    p, thresholds = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30))), {}
    for lang in sorted({v for v in langs if v is not None}):
        mine = np.array([v == lang for v in langs])
        f1 = [2 * (y[mine] * (p[mine] >= t)).sum() / max(1, y[mine].sum() + (p[mine] >= t).sum()) for t in GRID]
        best = np.flatnonzero(np.array(f1) == max(f1))
        thresholds[lang] = float(GRID[best[np.argmin(np.abs(GRID[best] - 0.5))]])
    return net, thresholds


def flat(net: Net) -> np.ndarray:
    """A net as rows of DIM numbers: the embeddings, then all else."""
    rest = np.concatenate([*(w.ravel() for w in net.w), *net.b, net.v, [net.c]]).astype(np.float32)
    return np.concatenate([net.e, np.pad(rest, (0, -len(rest) % DIM)).reshape(-1, DIM)])


def unflat(rows: np.ndarray) -> Net:
    net = Net()
    net.e, rest = rows[:BUCKETS].copy(), rows[BUCKETS:].ravel()
    parts = [*net.w, *net.b, net.v]
    cuts = np.cumsum([x.size for x in parts])
    *parts, last = (x.reshape(old.shape).copy() for x, old in zip(np.split(rest, cuts)[:-1], parts, strict=True))
    net.w, net.b, net.v, net.c = parts[: len(WIDTHS)], parts[len(WIDTHS) :], last, rest[cuts[-1]]
    return net


def training_rows(docs: DataFrame, labels: DataFrame, training: Column, id_col: str, text_col: str, lang_col: str, label_col: str) -> DataFrame:
    """fold, label, lang, slots (of a text's words, as bytes) of every labelled text."""
    col = lambda c: F.col(quoted(c))
    use = labels.filter(training & col(label_col).isin(0, 1)).select(col(id_col).alias("id"), col(label_col).cast("int").alias("label")).distinct()
    texts = docs.select(col(id_col).alias("id"), col(text_col).alias("text"), col(lang_col).cast("string").alias("lang")).filter(F.col("text").isNotNull() & F.col("id").isNotNull())

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(3))
            out = []
            for a, b in blocks(offsets):
                slots, first = tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                slots = slots.astype(np.int32)
                out += [slots[i:j].tobytes() for i, j in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.binary())], names=["id", "lang", "fold", "slots"])

    kind = docs.schema[id_col].dataType.simpleString()
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int").alias("fold")  # equal texts go together
    words = texts.select("id", "lang", fold, "text").mapInArrow(run, f"id {kind}, lang string, fold int, slots binary")
    # never a broadcast of the labels, which grow with the texts: by the shuffle the shards are dealt by the hash of the id at any size
    return words.join(use.hint("merge"), "id").select("fold", "label", "lang", "slots")


def _slots(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(v.as_buffer(), np.int32) for v in batch.column("slots")]


def _start_nets(rows: DataFrame) -> dict[int, Net] | None:
    """The nets before training: by fold those that leave it out, and at FOLDS that of all rows; None without both labels."""
    n = np.zeros((FOLDS, 2))
    for fold, label, rows_ in rows.groupBy("fold", "label").count().collect():
        n[fold, label] = rows_
    if not n.sum(0).all():
        return None

    def run(batches):
        df = np.zeros((FOLDS * 2, BUCKETS), np.int64)
        for batch in batches:
            for fold, label, slots in zip(batch.column("fold").to_pylist(), batch.column("label").to_pylist(), _slots(batch), strict=True):
                df[2 * fold + label, np.unique(slots)] += 1
        at, slot = np.nonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(slot, pa.int32()), pa.array(df[at, slot])], names=["at", "slot", "n"])

    df = np.zeros((FOLDS * 2, BUCKETS))
    sums = rows.mapInArrow(run, "at int, slot int, n long").groupBy("at", "slot").agg(F.sum("n").alias("n")).toArrow()  # at most FOLDS * 2 * BUCKETS rows
    df[sums["at"].to_numpy(), sums["slot"].to_numpy()] = sums["n"].to_numpy()
    df = df.reshape(FOLDS, 2, BUCKETS)
    nets = {f: start(df.sum(0) - df[f], *(n.sum(0) - n[f])) for f in range(FOLDS) if n[f].any() and (n.sum(0) - n[f]).all()}
    return nets | {FOLDS: start(df.sum(0), *n.sum(0))}


def _epoch(shards: DataFrame, nets: dict[int, Net], epoch: int) -> dict[int, Net]:
    """The nets after one pass over all rows: the changes that each shard's copies have gone through, averaged."""
    given = shards.sparkSession.sparkContext.broadcast({k: flat(net) for k, net in nets.items()})

    def run(batches):
        own, seen, rng = {k: unflat(m) for k, m in given.value.items()}, False, np.random.default_rng((2, epoch, TaskContext.get().partitionId()))
        held: list[tuple[int, int, np.ndarray]] = []

        def learn():
            for i in rng.permutation(len(held)):
                fold, label, slots = held[i]
                for k, net in own.items():
                    if fold != k:
                        net.learn(slots, float(label), RATE / (1 + epoch))
            held.clear()

        words = 0
        for batch in batches:
            for fold, label, slots in zip(batch.column("fold").to_pylist(), batch.column("label").to_pylist(), _slots(batch), strict=True):
                if len(slots):
                    held.append((fold, label, slots))
                    words, seen = words + len(slots), True
            if words > HELD_WORDS:
                learn()
                words = 0
        learn()
        for k, net in own.items() if seen else ():
            change = flat(net) - given.value[k]
            row = np.flatnonzero(change.any(1) | (np.arange(len(change)) >= BUCKETS))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(row), k), pa.int32()), pa.array(row, pa.int32()), *(pa.array(change[row, d].astype(np.float64)) for d in range(DIM))], names=["net", "row", *(f"d{d}" for d in range(DIM))])

    columns = [f"d{d}" for d in range(DIM)]
    changes = shards.mapInArrow(run, "net int, row int, " + ", ".join(f"{c} double" for c in columns))
    means = changes.groupBy("net", "row").agg(*((F.sum(c) / F.count(F.lit(1))).cast("float").alias(c) for c in columns)).toArrow()  # at most the nets' rows
    net_of, row, change = means["net"].to_numpy(), means["row"].to_numpy(), np.stack([means[c].to_numpy() for c in columns], 1)
    out = {}
    for k in nets:
        m, mine = given.value[k].copy(), net_of == k
        m[row[mine]] += change[mine]
        out[k] = unflat(m)
    given.destroy()
    return out


def _judged(rows: DataFrame, nets: dict[int, Net]) -> DataFrame:
    """y, lang, z of every row: the output of the net that was trained without its fold, 0 where there is none."""
    given = rows.sparkSession.sparkContext.broadcast({k: flat(net) for k, net in nets.items() if k < FOLDS})

    def run(batches):
        own = {k: unflat(m) for k, m in given.value.items()}
        for batch in batches:
            docs, fold, z = _slots(batch), batch.column("fold").to_numpy(), np.zeros(batch.num_rows)
            for k, net in own.items():
                mine = np.flatnonzero(fold == k)
                if len(mine):
                    z[mine] = outputs(net, [docs[i] for i in mine])
            yield pa.RecordBatch.from_arrays([batch.column("label").cast(pa.float64()), batch.column("lang"), pa.array(z)], names=["y", "lang", "z"])

    return rows.select("fold", "label", "lang", "slots").mapInArrow(run, "y double, lang string, z double")


def fit_rows(rows: DataFrame) -> tuple[Net, DataFrame] | None:
    """The net trained on all rows, and lang, threshold of each language."""
    nets = _start_nets(rows)
    if nets is None:
        return None
    shards = rows.coalesce(max(1, rows.count() // SHARD_ROWS))
    for epoch in range(EPOCHS):
        nets = _epoch(shards, nets, epoch)
    judged, (a, b) = materialize(_judged(rows, nets)), (1.0, 0.0)
    p_of = lambda a, b: 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), a * F.col("z") + b))))
    y, z, p, s = F.col("y"), F.col("z"), F.col("p"), F.col("s")
    for _ in range(STEPS):  # logistic regression on the logit, by Newton steps with a weak prior
        at = judged.withColumn("p", p_of(a, b)).withColumn("s", p * (1 - p) + 1e-6)
        r = at.agg(F.sum((p - y) * z), F.sum(p - y), F.sum(s * z * z), F.sum(s * z), F.sum(s)).first()
        step = np.linalg.solve(np.array([[r[2] + 0.1, r[3]], [r[3], r[4] + 0.1]]), np.array([r[0] + 0.1 * (a - 1), r[1] + 0.1 * b]))
        a, b = float(a - step[0]), float(b - step[1])
        if np.abs(step).max() < 1e-9:
            break
    nets[FOLDS].scale, nets[FOLDS].shift = a, b
    over = [p >= float(t) for t in GRID]
    sums = judged.filter("lang IS NOT NULL").withColumn("p", p_of(a, b)).groupBy("lang").agg(F.sum("y").alias("y"), *(F.sum(F.when(o, y).otherwise(0.0)).alias(f"hit{i}") for i, o in enumerate(over)), *(F.sum(F.when(o, 1.0).otherwise(0.0)).alias(f"n{i}") for i, o in enumerate(over)))
    tried = [F.struct((2 * F.col(f"hit{i}") / F.greatest(F.lit(1.0), y + F.col(f"n{i}"))).alias("f1"), F.lit(-abs(i - len(GRID) // 2)).alias("near"), F.lit(-i).alias("i"), F.lit(float(t)).alias("t")) for i, t in enumerate(GRID)]
    return nets[FOLDS], materialize(sums.select("lang", F.array_max(F.array(*tried))["t"].alias("threshold")), keep=True)


def score(docs: DataFrame, labels: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", label_col: str = "toxic") -> DataFrame:
    """id, score, predicted (score >= 0.5) and flagged (by the threshold of the row's language)."""
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession
    with scope(spark):
        fitted = fit_rows(materialize(training_rows(docs, labels, training, id_col, text_col, lang_col, label_col)))
    model = spark.sparkContext.broadcast(fitted and fitted[0])
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        net = model.value
        for batch in batches:
            data, offsets = text_buffer(batch.column(2))
            out = np.zeros(batch.num_rows)
            for a, b in blocks(offsets) if net else ():
                z = net.logits(*tokens(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]))
                out[a:b] = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out), pa.array((out >= 0.5).astype(np.int32))], names=["doc_id", "lang", "score", "predicted"])

    narrow = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(lang_col)).cast("string").alias("lang"), F.col(quoted(text_col)).alias("text"))
    scored = narrow.mapInArrow(run, f"doc_id {kind}, lang string, score double, predicted int")
    if not fitted:
        return scored.select("doc_id", "score", "predicted", (F.col("score") >= 0.5).alias("flagged"))
    limits = fitted[1]
    limits = F.broadcast(limits) if limits.count() <= FEW_LANGS else limits
    return scored.join(limits, "lang", "left").select("doc_id", "score", "predicted", (F.col("score") >= F.coalesce("threshold", F.lit(0.5))).alias("flagged"))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    return score(docs, labels, fold != 0).select("doc_id", (fold == 0).alias("held_out"), "score", "predicted", "flagged")
