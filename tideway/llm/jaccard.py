"""N-gram Jaccard join by vertical partitioning (operator 7).

A text's set is its distinct shingles of five words. The n-grams get one global order, rare
ones first: a count sketch of SLOTS counters over all documents gives each n-gram its slot's
rank, and hashes break ties. Any order is right, and this one keeps frequent passages out of
the prefixes. In a corpus so large that a slot hides them, some come through: of the texts
that share a prefix with more than HOT others, all n-grams are counted exactly, those of more
than HOT of these texts are ordered behind all others (MOST_HOT of them, the most frequent
first, which bounds a list and no result), and the prefixes cut again, until no bucket is
over HOT but those of n-grams that are last already. Then:

1. Texts of at least 80 % similarity share an n-gram among the first 20 % of their orders
   (prefix), and at the first one that they share, enough must be left on both sides
   (positional bound, which also bounds the sizes).
2. In every bucket of a shared prefix n-gram, the member with the least place is the pivot; it
   makes candidates with the others: as many as members, not as pairs. Exact copies meet by
   the hash of their sets instead.
3. Candidates whose parity maps (about two bits per n-gram) differ in more bits than the sets
   may differ in n-grams are dropped; the others are verified on the whole sets: the order is cut into FRAGMENTS vertical parts,
   partial overlaps are counted part by part, and summed per pair.
4. Links give components. Only buckets whose other members still lie in different
   components can hide a link; their pairs across components, within the size classes that
   the bound allows, are verified too. So no link between different components is lost, and
   groups of copies are never expanded into all pairs.

Defined results: an empty or null text has an empty set and links with nothing; a text of
fewer than five words is one shingle; rows that share an id are one node, however many they
are (each is searched by a number of its own, so no id is a hot key); a null id is its own
component (null); an empty table gives an empty result; other columns are left alone.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .store import bound_batches, fresh, materialize, own_columns, quoted, scope
from .textbytes import NON_SPACE, Words, blocks, mix, releasing, text_buffer

SHINGLE = 5
SLOTS = 1 << 18
FRAGMENTS = 4
#: Texts in a bucket from which its n-gram is ordered last, and how many such n-grams the order holds (16 MB).
HOT, MOST_HOT = 10_000, 1 << 20
#: Flags of the filter that spares most texts without a candidate the shuffle; those that pass by chance drop out in the join.
FLAGS = 1 << 21


def sets(data: np.ndarray, offsets: np.ndarray):
    """The sorted distinct shingle hashes of each text of a block."""
    w = Words(data, offsets, NON_SPACE)
    full, short = w.windows(SHINGLE), {}
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist(), strict=True):
        if b - a >= SHINGLE:
            yield np.unique(full[a : b - SHINGLE + 1])
        elif b == a:
            yield full[:0]
        else:
            if b - a not in short:
                short[b - a] = w.windows(b - a)
            yield short[b - a][a : a + 1]


def _slot(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(46)).astype(np.int64)


def _long(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _each(batch, column: int):
    """(row of the batch, set) of every text."""
    data, offsets = text_buffer(batch.column(column))
    for a, b in blocks(offsets):
        yield from enumerate(sets(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), a)


class Order:
    """The global order: each slot's rank, and behind all slots the hot n-grams (sorted hashes, and in how many texts they are).

    frequent: the least rank of a slot whose n-grams may be in more than HOT texts.
    """

    def __init__(self, ranks: np.ndarray, frequent: int, hot: np.ndarray, hot_counts: np.ndarray):
        self.ranks, self.frequent, self.hot, self.hot_counts = ranks, frequent, hot, hot_counts
        self.hot_ranks = np.empty(len(hot), np.int64)
        self.hot_ranks[np.lexsort((-hot.view(np.int64), hot_counts))] = np.arange(len(hot))

    def of(self, s: np.ndarray) -> np.ndarray:
        out = self.ranks[_slot(s)].astype(np.int64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, s), len(self.hot) - 1)
            known = self.hot[at] == s
            out[known] = SLOTS + self.hot_ranks[at[known]]
        return out

    def fragment(self, s: np.ndarray) -> np.ndarray:
        return np.minimum(self.of(s) * FRAGMENTS // SLOTS, FRAGMENTS - 1)


def order_of(docs: DataFrame) -> Order:
    """The order by the slots' counts over all documents. The sketch has SLOTS counters at any size of the input."""

    def count(batches):
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            held, size = [], 0
            for _, s in _each(batch, 0):
                held.append(s)
                size += len(s)
                if size > 1 << 18:
                    total += np.bincount(_slot(np.concatenate(held)), minlength=SLOTS)
                    held, size = [], 0
            if held:
                total += np.bincount(_slot(np.concatenate(held)), minlength=SLOTS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["slot", "n"])

    rows = docs.select("text").mapInArrow(releasing(count), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SLOTS, np.int64)
    counts[rows["slot"].to_numpy()] = rows["n"].to_numpy()
    ranks, by_count = np.empty(SLOTS, np.int32), np.argsort(counts, kind="stable")
    ranks[by_count] = np.arange(SLOTS)
    return Order(ranks, int(np.searchsorted(counts[by_count], HOT, "right")), np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _within(s: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of s are in some (sorted, not empty)."""
    return some[np.minimum(np.searchsorted(some, s), len(some) - 1)] == s


def newly_hot(order: Order, buckets: DataFrame) -> np.ndarray:
    """The n-grams (sorted) of buckets (token, c) over HOT texts that the order has not behind all others yet; none once it holds MOST_HOT."""
    if len(order.hot) >= MOST_HOT:
        return order.hot[:0]
    rows = buckets.filter(F.col("c") > HOT).orderBy(F.desc("c"), "token").limit(MOST_HOT).select("token").toArrow()
    return np.setdiff1d(rows["token"].to_numpy().view(np.uint64), order.hot)


def common(docs: DataFrame, order, hot: np.ndarray) -> DataFrame:
    """token, c: in how many of the texts whose prefix holds one of hot each of their n-grams is.

    N-grams that the order's slots show to be in HOT texts at most are left out. Counts are summed a few
    million n-grams at a time before they are shuffled, so that copies of a passage come as one row.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def count(batches):
        held, size = [], 0
        for batch in batches:
            for _, s, token in _distinct(batch, order.value):
                if _within(token, shared.value).any():
                    s = s[order.value.ranks[_slot(s)] >= order.value.frequent]
                    held.append(s)
                    size += len(s)
                if size > 1 << 21:
                    yield _counts(held)
                    held, size = [], 0
        if held:
            yield _counts(held)

    return docs.select("id", "text").mapInArrow(releasing(count), "token long, c long").groupBy("token").agg(F.sum("c").alias("c"))


def _counts(held: list[np.ndarray]) -> pa.RecordBatch:
    token, c = np.unique(np.concatenate(held), return_counts=True)
    return pa.RecordBatch.from_arrays([_long(token), pa.array(c.astype(np.int64))], names=["token", "c"])


def with_hot(order: Order, counts: DataFrame) -> Order | None:
    """order with the n-grams of counts (token, c) in over HOT texts behind all others too, by their counts; None where there are no new ones."""
    rows = counts.filter(F.col("c") > HOT).orderBy(F.desc("c"), "token").limit(MOST_HOT).toArrow()
    hot, c = rows["token"].to_numpy().view(np.uint64), rows["c"].to_numpy()
    new = ~np.isin(hot, order.hot)
    hot, c = np.concatenate([order.hot, hot[new]]), np.concatenate([order.hot_counts, c[new]])
    if not new.any():
        return None
    most = np.lexsort((hot.view(np.int64), -c))[:MOST_HOT]
    at = most[np.argsort(hot[most])]
    return Order(order.ranks, order.frequent, hot[at], c[at])


def parities(s: np.ndarray) -> np.ndarray:
    """The set as bits, each the parity of the n-grams that fall on it: of two sets, as many n-grams differ at least as bits do."""
    bits = np.bincount((s & np.uint64((1 << max(6, len(s).bit_length())) - 1)).astype(np.int64), minlength=1 << max(6, len(s).bit_length())) & 1
    return np.packbits(bits.astype(bool), bitorder="little").view(np.int64)


def digests(docs: DataFrame) -> DataFrame:
    """id, n (size of the set), h1 and h2 (hash of the set) and its parity bits."""

    def run(batches):
        for batch in batches:
            n, h1, h2 = (np.zeros(batch.num_rows, np.uint64) for _ in range(3))
            bits = []
            for i, s in _each(batch, 1):
                bits.append(parities(s))
                n[i], h1[i] = len(s), s.sum(dtype=np.uint64)
                h2[i] = mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
            cuts = np.concatenate([[0], np.cumsum([len(b) for b in bits])])
            bits = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(np.concatenate(bits) if bits else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), _long(n), _long(h1), _long(h2), bits], names=["id", "n", "h1", "h2", "bits"])

    return docs.select("id", "text").mapInArrow(releasing(run), "id long, n long, h1 long, h2 long, bits array<long>")


def _distinct(batch, order: Order):
    """(row of the batch, set, prefix in the global order) of the texts that are not empty. Of copies within a batch, one is enough: copies meet by hash."""
    seen = set()
    for i, s in _each(batch, 1):
        n = len(s)
        key = s.tobytes() if n <= 16 else (n, int(s.sum(dtype=np.uint64)), int(mix(s).sum(dtype=np.uint64)))
        if n and key not in seen:
            seen.add(key)
            yield i, s, s[np.lexsort((s, order.of(s)))[: n - (4 * n + 4) // 5 + 1]]


def prefixes(docs: DataFrame, order) -> DataFrame:
    """token, id, n, pos: each text's prefix in the global order."""

    def run(batches):
        for batch in batches:
            ids, out = batch.column(0), []
            for i, s, token in _distinct(batch, order.value):
                out.append((i, len(s), token))
                if len(out) >= 2000:
                    yield _rows(ids, out)
                    out = []
            if out:
                yield _rows(ids, out)

    return docs.select("id", "text").mapInArrow(releasing(run), "token long, id long, n int, pos int")


def _rows(ids, out):
    size = np.array([len(t) for *_, t in out])
    each = lambda x: np.repeat(np.array(x), size)
    pos = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    return pa.RecordBatch.from_arrays(
        [_long(np.concatenate([t for *_, t in out])), ids.take(pa.array(each([i for i, *_ in out]))), pa.array(each([n for _, n, _ in out]).astype(np.int32)), pa.array(pos.astype(np.int32))], names=["token", "id", "n", "pos"]
    )


def _needed(n: Column, m: Column) -> Column:
    """Least overlap of two sets of sizes n and m: 100 * i >= 80 * (n + m - i)."""
    return F.ceil(4 * (n + m) / 9)


def _possible(a: str, b: str) -> Column:
    """Whether two texts whose first shared n-gram is this one can reach the needed overlap."""
    left = F.least(F.col(f"{a}.n") - F.col(f"{a}.pos"), F.col(f"{b}.n") - F.col(f"{b}.pos"))
    return left >= _needed(F.col(f"{a}.n"), F.col(f"{b}.n"))


def _differ(x: Column, y: Column) -> Column:
    """Bits in which two parity maps differ; the longer is folded to the length of the other (sizes that may link differ by one doubling at most)."""
    half = lambda z: (F.size(z) / 2).cast("int")
    fold = lambda z, other: F.when(F.size(z) > F.size(other), F.zip_with(F.slice(z, 1, half(z)), F.slice(z, half(z) + 1, half(z)), lambda p, q: p.bitwiseXOR(q))).otherwise(z)
    return F.aggregate(F.zip_with(fold(x, y), fold(y, x), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda a, b: a + b)


def verified(docs: DataFrame, pairs: DataFrame, sizes: DataFrame, order) -> DataFrame:
    """The pairs (a, b) that link, by partial overlaps of vertical fragments of their whole sets."""
    x, y = (sizes.select(F.col("id").alias(i), *(F.col(c).alias(c + i) for c in ("n", "h1", "h2", "bits"))) for i in "ab")
    open_ = pairs.join(x, "a").join(y, "b").filter("NOT (na = nb AND h1a = h1b AND h2a = h2b)")
    needed = _needed(F.col("na"), F.col("nb"))
    open_ = open_.filter((F.least("na", "nb") >= needed) & (_differ(F.col("bitsa"), F.col("bitsb")) <= F.col("na") + F.col("nb") - 2 * needed))
    open_ = materialize(open_.select("a", "b", "na", "nb").distinct())
    ends = open_.select(F.explode(F.array("a", "b")).alias("id"))
    flagged = ends.select(F.pmod(F.xxhash64("id"), F.lit(FLAGS)).alias("flag")).distinct().toArrow()["flag"].to_numpy()
    flags = np.zeros(FLAGS, bool)
    flags[flagged] = True
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(np.packbits(flags))

    def cut(batches):
        flags = np.unpackbits(shared.value).astype(bool)
        for batch in batches:
            batch = batch.filter(pa.array(flags[batch.column(2).to_numpy(zero_copy_only=False)]))
            out = []
            for i, s in _each(batch, 1):
                part = order.value.fragment(s)
                out += [(i, f, s[part == f]) for f in range(FRAGMENTS)]
                if len(out) >= 1000:
                    yield _sets(batch.column(0), out)
                    out = []
            if out:
                yield _sets(batch.column(0), out)

    narrow = docs.filter(F.col("id").isNotNull()).select("id", "text", F.pmod(F.xxhash64("id"), F.lit(FLAGS)).alias("flag"))
    parts = narrow.mapInArrow(releasing(cut), "id long, f int, tokens array<long>")
    of_b = open_.select("a", "b").join(parts.withColumnRenamed("id", "b"), "b")
    of_a = parts.select(F.col("id").alias("a"), "f", F.col("tokens").alias("of_a"))
    # written before it is grouped: a join of plain exchanges, in which Spark can split the partners of a pivot
    partial = materialize(of_b.join(of_a, ["a", "f"]).select("a", "b", "f", F.size(F.array_intersect("tokens", "of_a")).alias("i")))
    overlap = partial.groupBy("a", "b", "f").agg(F.max("i").alias("i")).groupBy("a", "b").agg(F.sum("i").alias("i"))
    return overlap.join(open_, ["a", "b"]).filter("100 * i >= 80 * (na + nb - i)").select("a", "b")


def _sets(ids, out):
    cuts = np.concatenate([[0], np.cumsum([len(s) for *_, s in out])])
    tokens = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), _long(np.concatenate([s for *_, s in out])))
    return pa.RecordBatch.from_arrays([ids.take(pa.array([i for i, *_ in out])), pa.array([f for _, f, _ in out], pa.int32()), tokens], names=["id", "f", "tokens"])


def _copies(sizes: DataFrame) -> DataFrame:
    """Edges from exact copies to the first of them."""
    first = materialize(sizes.filter("n > 0").groupBy("n", "h1", "h2").agg(F.min("id").alias("v"), F.count(F.lit(1)).alias("c")).filter("c > 1").drop("c"))
    return sizes.join(first, ["n", "h1", "h2"]).select(F.col("id").alias("u"), "v")


def _hidden(shared: DataFrame, reached: DataFrame) -> DataFrame:
    """Pairs (a, b) in one bucket but in different components, which no pivot has compared."""
    labelled = shared.filter("NOT pivot AND several").join(reached, "id", "left")
    labelled = materialize(labelled.select("token", "id", "n", "pos", F.coalesce("component", "id").alias("component")))
    mixed = materialize(labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo <> hi").select("token"))
    left = materialize(labelled.join(mixed, "token"))
    size_class = lambda n: F.floor(F.ln(n) * 20).cast("int")
    # the larger text (ties: the larger id) looks into the size classes that its place allows
    most = F.least(F.col("n"), F.floor(9 * (F.col("n") - F.col("pos")) / 4) - F.col("n"))
    fewest = F.greatest(F.ceil(F.lit(0.8) * F.col("n")), F.lit(1))
    larger = left.filter(most >= fewest).withColumn("c", F.explode(F.sequence(size_class(fewest), size_class(most))))
    smaller = left.withColumn("c", size_class(F.col("n")))
    tagged = larger.withColumn("side", F.lit(0)).unionByName(smaller.withColumn("side", F.lit(1)))
    open_ = tagged.groupBy("token", "c").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.countDistinct("side").alias("sides")).filter("lo <> hi AND sides = 2").select("token", "c")
    x, y = larger.join(open_, ["token", "c"]).alias("x"), smaller.join(open_, ["token", "c"]).alias("y")
    ordered = (F.col("x.n") > F.col("y.n")) | ((F.col("x.n") == F.col("y.n")) & (F.col("x.id") > F.col("y.id")))
    on = (F.col("x.token") == F.col("y.token")) & (F.col("x.c") == F.col("y.c")) & (F.col("x.component") != F.col("y.component")) & ordered & _possible("x", "y")
    return x.join(y, on).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _buckets(narrow: DataFrame, order) -> tuple[DataFrame, DataFrame]:
    """The prefixes with the place of each in its bucket, and the buckets of several texts: token, least (place of the pivot), c."""
    place = F.shiftleft(F.col("pos").cast("long"), 40) + F.shiftrightunsigned(F.xxhash64("id"), 24)
    rows = prefixes(narrow.filter(F.col("id").isNotNull()), order).withColumn("place", place)
    # written, so that the join has plain exchanges on both sides and Spark can split hot n-grams
    return rows, materialize(rows.groupBy("token").agg(F.min("place").alias("least"), F.count(F.lit(1)).alias("c")).filter("c > 1"))


def _groups(narrow: DataFrame, sizes: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(id, component) of the rows of narrow that link, or that the edges known (u, v) tie; non-null ids are distinct."""
    spark = narrow.sparkSession
    order = spark.sparkContext.broadcast(order_of(narrow))
    rows, buckets = _buckets(narrow, order)
    while len(hot := newly_hot(order.value, buckets)) and (refined := with_hot(order.value, common(narrow.filter(F.col("id").isNotNull()), order, hot))):
        order = spark.sparkContext.broadcast(refined)
        rows, buckets = _buckets(narrow, order)
    shared = rows.join(buckets, "token").select("token", "id", "n", "pos", (F.col("place") == F.col("least")).alias("pivot"), (F.col("c") > 2).alias("several"))
    shared = materialize(shared)
    p, m = shared.filter("pivot").alias("p"), shared.alias("m")
    star = p.join(m, (F.col("p.token") == F.col("m.token")) & (F.col("p.id") != F.col("m.id")) & _possible("p", "m"))
    pairs = star.select(F.col("p.id").alias("a"), F.col("m.id").alias("b")).distinct()
    links = _copies(sizes).union(verified(narrow, pairs, sizes.filter(F.col("id").isNotNull()), order))
    links = materialize(links.union(known) if known else links)
    reached = components(links)
    more = verified(narrow, _hidden(shared, reached), sizes, order)
    return components(links.union(more.select("a", "b")))


def _by_row(narrow: DataFrame) -> DataFrame:
    """(id, component) where ids repeat: every row is a node under a written number, tied to the first row of its id."""
    marked = materialize(narrow.filter(F.col("id").isNotNull()).select(F.monotonically_increasing_id().alias("row"), "id", "text"))
    nodes = marked.select(F.col("row").alias("id"), "text")
    first = materialize(marked.groupBy("id").agg(F.min("row").alias("v")))
    tied = marked.select("row", "id").join(first, "id").filter("row <> v").select(F.col("row").alias("u"), "v")
    groups = _groups(nodes, materialize(digests(nodes)), materialize(tied)).withColumnRenamed("id", "row")
    placed = materialize(first.select("id", F.col("v").alias("row")).join(groups, "row", "left").select("id", F.coalesce("component", "row").alias("group")))
    least = materialize(placed.groupBy("group").agg(F.min("id").alias("component")))
    return materialize(placed.join(least, "group").select("id", "component"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles and component_id of every row of docs; ids are integers."""
    spark = docs.sparkSession
    bound_batches(spark)
    narrow = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).alias("text"))
    with scope(spark):
        sizes = materialize(digests(narrow))
        repeated = sizes.filter(F.col("id").isNotNull()).groupBy("id").count().filter("count > 1")
        final = _groups(narrow, sizes) if repeated.isEmpty() else _by_row(narrow)
        found = sizes.join(final, "id", "left").select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))
        return materialize(found, keep=True)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs whose id is the first of its group, with the columns of docs; rows with a null id stay."""
    first = join(docs, id_col, text_col).filter(F.col(quoted(id_col)) == F.col("component_id")).select(F.col(quoted(id_col)).alias("__first")).distinct()
    kept = docs.join(first, docs[quoted(id_col)].cast("long") == F.col("__first"), "left_semi")
    return kept.unionByName(docs.filter(F.col(quoted(id_col)).isNull()))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group of linked rows, with the columns of docs: that of the least id, nulls last.

    Every row is a node of its own under a written number, so repeated and null ids are grouped by their texts like all others.
    """
    row = fresh(docs, "__row")
    marked = materialize(docs.withColumn(row, F.monotonically_increasing_id()))
    ids = marked.select(F.col(row).alias("__row"), F.col(quoted(id_col)).isNull().alias("none"), F.col(quoted(id_col)).alias("id"))
    groups = join(marked, row, text_col).select(F.col(row).alias("__row"), "component_id")
    first = groups.join(ids, "__row").groupBy("component_id").agg(F.min(F.struct("none", "id", "__row")).alias("r")).select("r.__row")
    gone = materialize(groups.select("__row").join(materialize(first), "__row", "left_anti").select(F.col("__row").alias(row)))
    # few rows go: those of a slot without any stay without a shuffle; at most SLOTS slots are broadcast
    slot = F.pmod(F.xxhash64(row), F.lit(SLOTS))
    slots = F.broadcast(materialize(gone.select(slot.alias(f"{row}_slot")).distinct()))
    on = slot == F.col(f"{row}_slot")
    own = own_columns(docs)
    return marked.join(slots, on, "left_anti").select(*own).union(marked.join(slots, on, "left_semi").join(gone, row, "left_anti").select(*own))


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS c FROM d UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.doc_id)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, c AS component_id FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) USING (doc_id)
"""
