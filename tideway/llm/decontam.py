"""Benchmark decontamination by a prefix-filtered set join (operator 6).

Every benchmark item is cut into windows of WINDOW consecutive words (an item of fewer
words is one window). A window is a set of SHINGLE-word shingles; because a window must be
contained whole, its prefix is one shingle, and the rarest one in the corpus makes the
fewest candidates. So: count the benchmark's shingles over all documents, keep for every
window its rarest shingle (ties: smaller hash, then place) with its place in the window,
join the documents' shingles with these prefix shingles, drop candidates that would start
before or end after the text (length and positional bounds), and verify the rest by the
hash of the whole window.

The benchmark's windows are broadcast while they and their shingles are at most BROADCAST_ROWS
rows, which is checked; beyond it the same join, with the same prefixes and bounds, runs as a
shuffle join over rows with written numbers (join_windows). Only bit maps of bounded size are
broadcast then: they spare most of the documents' shingles the shuffle, and change no result.

Defined results: null texts and texts without a word have no windows and are never hit; an
item that repeats another is reported besides it; repeated documents are judged alike; a
null item id is reported as an empty string; an empty benchmark leaves everything clean.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import bound_batches, fresh, materialize, numbered, own_columns, quoted, scope
from .textbytes import ALNUM, Words, blocks, releasing, text_buffer

WINDOW = 10
SHINGLE = 5
BROADCAST_ROWS = 300_000
#: Bits of the largest map (16 MB); beyond, more shingles pass it and drop out in the join.
MOST_BITS = 1 << 27

#: One row per window: its words, hash, item, and a shingle with its place in the window. Windows under SHINGLE words are their own shingle.
WINDOWS = "item string, n int, hash long, shingle long, place int, short boolean"


def _words(data, offsets, a, b):
    return Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ALNUM)


def windows(benchmark: DataFrame, id_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """Every (window, shingle) of every item."""

    def cut(batches):
        for batch in batches:
            ids = batch.column(0).fill_null("")
            data, offsets = text_buffer(batch.column(1))
            for a, b in blocks(offsets):
                w = _words(data, offsets, a, b)
                item_of = np.repeat(np.arange(b - a), np.diff(w.first))
                k_of = np.minimum(np.diff(w.first), size)[item_of]
                for k in np.unique(k_of).tolist():  # at most size of them
                    s = min(SHINGLE, k)
                    whole, parts = w.windows(k), w.windows(s)
                    at = np.flatnonzero(k_of == k)
                    at = at[at + k <= w.first[item_of[at] + 1]]
                    for j in range(k - s + 1):
                        as_long = lambda x: pa.array(x.view(np.int64))
                        same = lambda x, t, n=len(at): pa.array(np.full(n, x), t)
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(a + item_of[at])), same(k, pa.int32()), as_long(whole[at]), as_long(parts[at + j]), same(j, pa.int32()), same(s < SHINGLE, pa.bool_())], names=["item", "n", "hash", "shingle", "place", "short"]
                        )

    return benchmark.select(F.col(quoted(id_col)).cast("string"), F.col(quoted(text_col))).mapInArrow(cut, WINDOWS)


class Index:
    """Sorted prefix shingles of a broadcast benchmark, with a filter of 2**18 flags before the search."""

    def __init__(self, rows):
        size = lambda r: (SHINGLE if not r["short"] else r["n"])
        self.by: dict[int, tuple] = {}
        for s in sorted({size(r) for r in rows}):
            mine = [r for r in rows if size(r) == s]
            shingle = np.array([r["shingle"] for r in mine], np.int64).view(np.uint64)
            order = np.argsort(shingle, kind="stable")
            flags = np.zeros(1 << 18, bool)
            flags[shingle >> np.uint64(46)] = True
            col = lambda k, t, mine=mine, order=order: np.array([r[k] for r in mine], t)[order]
            self.by[s] = (shingle[order], col("place", np.int64), col("n", np.int64), col("hash", np.int64).view(np.uint64), [mine[i]["items"] for i in order], flags)


def shingle_counts(docs: DataFrame, text_col: str, wanted) -> DataFrame:
    """(shingle, n): how often each shingle of the broadcast array occurs in all documents; counts of the tasks are summed."""

    def count(batches):
        by_size, total = wanted.value, {}
        for s, known in by_size.items():
            total[s] = np.zeros(len(known), np.int64)
        flags = {s: np.zeros(1 << 18, bool) for s in by_size}
        for s, known in by_size.items():
            flags[s][known >> np.uint64(46)] = True
        for batch in batches:
            data, offsets = text_buffer(batch.column(0))
            for a, b in blocks(offsets):
                w = _words(data, offsets, a, b)
                for s, known in by_size.items():
                    h = w.windows(s)
                    h = h[flags[s][h >> np.uint64(46)]]
                    at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                    total[s] += np.bincount(at[known[at] == h], minlength=len(known))
        for s, known in by_size.items():
            some = np.flatnonzero(total[s])
            yield pa.RecordBatch.from_arrays([pa.array(known[some].view(np.int64)), pa.array(total[s][some])], names=["shingle", "n"])

    return docs.select(quoted(text_col)).mapInArrow(releasing(count), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("uses"))


def prefixes(cut: DataFrame, counts: DataFrame) -> DataFrame:
    """One row per distinct window: its rarest shingle, and the items that hold it (sorted)."""
    rare = F.min(F.struct(F.coalesce("uses", F.lit(0)).alias("uses"), F.col("shingle"), F.col("place")))
    joined = cut.join(counts, "shingle", "left")
    return joined.groupBy("n", "hash", "short").agg(rare.alias("r"), F.array_sort(F.collect_set("item")).alias("items")).select("n", "hash", "short", "items", "r.shingle", "r.place")


def _hits(w: Words, index: Index):
    """(first word, words, items) of every verified occurrence in a block."""
    found = []
    text_of = np.repeat(np.arange(len(w.first) - 1), np.diff(w.first))
    for s, (keys, place, n, whole, items, flags) in index.by.items():
        h = w.windows(s)
        some = np.flatnonzero(flags[h >> np.uint64(46)])
        lo, hi = np.searchsorted(keys, h[some], "left"), np.searchsorted(keys, h[some], "right")
        many = hi - lo
        at = np.repeat(some, many)
        key = np.repeat(lo, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        start = at - place[key]
        t = text_of[at]
        fits = (start >= w.first[t]) & (start + n[key] <= w.first[t + 1])
        start, key, t = start[fits], key[fits], t[fits]
        for k in np.unique(n[key]):
            those = n[key] == k
            ok = w.windows(int(k))[start[those]] == whole[key[those]]
            found += [(int(x), int(k), int(y), items[z]) for x, y, z in zip(start[those][ok], t[those][ok], key[those][ok], strict=True)]
    return found


def _report(batches, index):
    for batch in batches:
        data, offsets = text_buffer(batch.column(1))
        n_words, n_hit, names, spans = [], [], [], []
        for a, b in blocks(offsets):
            w = _words(data, offsets, a, b)
            hit, items = np.zeros(len(w.hashes), bool), {}
            for start, k, text, names_ in _hits(w, index):
                hit[start : start + k] = True
                items.setdefault(text, set()).update(names_)
            below = np.concatenate([[0], np.cumsum(hit)])
            n_words += np.diff(w.first).tolist()
            n_hit += (below[w.first[1:]] - below[w.first[:-1]]).tolist()
            names += [sorted(items.get(i, ())) for i in range(b - a)]
            for i in range(b - a):
                mine = np.flatnonzero(hit[w.first[i] : w.first[i + 1]]) + w.first[i] if i in items else np.zeros(0, int)
                edge = np.flatnonzero(np.diff(mine) > 1)
                base = offsets[a + i] - offsets[a]
                spans.append([{"start": int(w.starts[p] - base), "end": int(w.ends[q] - base)} for p, q in zip(mine[np.r_[0, edge + 1]], mine[np.r_[edge, -1]], strict=True)] if len(mine) else [])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
            names=["row", "n_words", "n_hit", "items", "spans"],
        )


REPORT = "n_words long, n_hit long, items array<string>, spans array<struct<start:long,end:long>>"


def _index(docs: DataFrame, cut: DataFrame, text_col: str):
    """The broadcast index of the windows cut, each by its shingle that is rarest in docs."""
    context = docs.sparkSession.sparkContext
    distinct = cut.select("shingle", F.when(F.col("short"), F.col("n")).otherwise(SHINGLE).alias("s")).distinct().collect()
    by_size = {s: np.unique(np.array([r["shingle"] for r in distinct if r["s"] == s], np.int64).view(np.uint64)) for s in {r["s"] for r in distinct}}
    return context.broadcast(Index(prefixes(cut, shingle_counts(docs, text_col, context.broadcast(by_size))).collect()))


def find(docs: DataFrame, benchmark: DataFrame, row_col: str, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most: int = BROADCAST_ROWS) -> DataFrame:
    """row, n_words, n_hit, items (with an occurring window, sorted) and spans (byte ranges of the hit words) for every row of docs."""
    spark, row, text = docs.sparkSession, F.col(quoted(row_col)), F.col(quoted(text_col))
    bound_batches(spark)
    with scope(spark):
        cut = materialize(windows(benchmark, item_col, item_text))
        if cut.count() > most:
            marked = materialize(docs.select(row.alias("of"), text.alias("text"), F.monotonically_increasing_id().alias("__row")))
            found = join_windows(marked, cut, "__row", "text").withColumnRenamed("row", "__row")
            return materialize(marked.select("__row", F.col("of").alias("row")).join(found, "__row").drop("__row"), keep=True)
        index = _index(docs, cut, text_col)
    kind = docs.schema[row_col].dataType.simpleString()
    return docs.select(row.alias("row"), text.alias("text")).mapInArrow(lambda batches: _report(batches, index.value), f"row {kind}, {REPORT}")


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", most: int = BROADCAST_ROWS) -> DataFrame:
    """The rows of docs without a hit word, with the columns of docs."""
    bound_batches(docs.sparkSession)
    with scope(docs.sparkSession):
        cut = materialize(windows(benchmark, item_col, item_text))
        if cut.count() > most:
            row = fresh(docs, "__row")
            marked = materialize(docs.withColumn(row, F.monotonically_increasing_id()), keep=True)
            hit = join_windows(marked, cut, row, text_col).filter("n_hit > 0").select(F.col("row").alias(row))
            return marked.join(materialize(hit, keep=True), row, "left_anti").select(*own_columns(docs))
        index = _index(docs, cut, text_col)
    names, at = docs.columns, docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(at))
            clean = np.ones(batch.num_rows, bool)
            for a, b in blocks(offsets):
                for _, _, text, _ in _hits(_words(data, offsets, a, b), index.value):
                    clean[a + text] = False
            yield pa.RecordBatch.from_arrays(batch.filter(pa.array(clean)).columns, names=names)

    return numbered(docs).mapInArrow(releasing(run), docs.schema)


def _bits(keys: DataFrame, rows: int) -> np.ndarray:
    """A bit map in which the bits of all keys (longs) are set, of at most MOST_BITS bits; tasks merge its words before the driver reads them."""
    size = min(MOST_BITS, 1 << max(16, (16 * rows).bit_length()))
    at = F.col("key").bitwiseAND(F.lit(size - 1))
    words = keys.groupBy(F.shiftright(at, 5).alias("w")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST((key & {size - 1}) % 32 AS INT))")).alias("v")).toArrow()
    out = np.zeros(size // 32, np.uint32)
    out[words["w"].to_numpy()] = words["v"].to_numpy().astype(np.uint32)
    return out


def _set(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys & np.uint64(len(bits) * 32 - 1)
    return (bits[(at >> np.uint64(5)).astype(np.int64)] >> (at & np.uint64(31)).astype(np.uint32)) & np.uint32(1) > 0


def join_windows(docs: DataFrame, cut: DataFrame, row_col: str, text_col: str) -> DataFrame:
    """find() without a broadcast index: the documents' shingles are rows of shuffle joins. Rows must have distinct, written numbers row_col."""
    context, rows = docs.sparkSession.sparkContext, cut.count()
    sizes = sorted(r["n"] for r in cut.select("n").distinct().collect())  # at most WINDOW of them
    used = context.broadcast(_bits(cut.select(F.col("shingle").alias("key")), rows))
    narrow = docs.select(F.col(quoted(row_col)).alias("row"), F.col(quoted(text_col)).alias("text"))

    def count(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for a, b in blocks(offsets):
                w = _words(data, offsets, a, b)
                for s in sorted({min(SHINGLE, k) for k in sizes}):
                    h = w.windows(s)
                    h, n = np.unique(h[_set(used.value, h)], return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n.astype(np.int64))], names=["shingle", "n"])

    counts = narrow.mapInArrow(releasing(count), "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("uses"))
    rare = materialize(prefixes(cut, counts))
    # a window's prefix is looked for at its place only, so the bit is that of shingle, size and place
    mixed = F.col("shingle").bitwiseXOR((F.col("n") * 16 + F.col("place")).cast("long"))
    wanted = context.broadcast(_bits(rare.select(mixed.alias("key")), rows))

    def explode(batches):
        for batch in batches:
            ids = batch.column(0)
            data, offsets = text_buffer(batch.column(1))
            for a, b in blocks(offsets):
                w = _words(data, offsets, a, b)
                text_of = np.repeat(np.arange(b - a), np.diff(w.first))
                base = (offsets[a:b] - offsets[a])[text_of]
                for k in sizes:
                    s, whole = min(SHINGLE, k), w.windows(k)
                    h = w.windows(s)
                    for j in range(k - s + 1):
                        start = np.flatnonzero(_set(wanted.value, h ^ np.uint64(16 * k + j))) - j
                        start = start[(start >= 0) & (start + k <= len(text_of))]
                        ok = start[text_of[start] == text_of[start + k - 1]]
                        long = lambda x: pa.array(x.astype(np.int64))
                        yield pa.RecordBatch.from_arrays(
                            [ids.take(pa.array(a + text_of[ok])), pa.array(np.full(len(ok), k, np.int32)), pa.array(whole[ok].view(np.int64)), pa.array(h[ok + j].view(np.int64)), pa.array(np.full(len(ok), j, np.int32)), long(ok - w.first[text_of[ok]]), long(w.starts[ok] - base[ok]), long(w.ends[ok + k - 1] - base[ok])],
                            names=["row", "n", "hash", "shingle", "place", "word", "start", "end"],
                        )

    kind = docs.schema[row_col].dataType.simpleString()
    places = narrow.mapInArrow(releasing(explode), f"row {kind}, n int, hash long, shingle long, place int, word long, start long, end long")
    hits = materialize(places.join(rare, ["shingle", "place", "n", "hash"]).select("row", "word", (F.col("word") + F.col("n")).alias("after"), "start", "end", "items"))
    items = hits.select("row", F.explode("items").alias("item")).groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    # runs of hit words: a window that starts behind all before it opens one
    by_word = Window.partitionBy("row").orderBy("word", "after")
    before = F.max("after").over(by_word.rowsBetween(Window.unboundedPreceding, -1))
    opened = hits.select("row", "word", "after", "start", "end").withColumn("opens", F.when(F.col("word") <= before, 0).otherwise(1))
    runs = opened.withColumn("run", F.sum("opens").over(by_word.rowsBetween(Window.unboundedPreceding, 0))).groupBy("row", "run")
    runs = runs.agg((F.max("after") - F.min("word")).alias("words"), F.min("start").alias("start"), F.max("end").alias("end"))
    spans = runs.groupBy("row").agg(F.sum("words").alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"))
    empty = Index([])
    total = narrow.mapInArrow(lambda batches: _report(batches, empty), f"row {kind}, {REPORT}").select("row", "n_words")
    joined = total.join(items, "row", "left").join(spans, "row", "left")
    return joined.select("row", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>")).alias("spans"))


def query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find(docs, benchmark, "doc_id").select(
        F.col("row").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
h AS (SELECT doc_id, item_id, i, n FROM dw JOIN bw USING (n, g)),
hw AS (SELECT doc_id, count(DISTINCT i + j) AS n_hit FROM (SELECT doc_id, i, unnest(range(0, n)) AS j FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list_distinct(list(CAST(item_id AS VARCHAR)))), ',') AS items FROM h GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
