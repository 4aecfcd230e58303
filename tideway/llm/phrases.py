"""Phrase collocation mining (operator 11): phrases that are frequent, and more so than their parts suggest.

1. Words are counted per language. Those of LEAST or more get numbers, of their own in each
   language, and texts become numbers: -1 for any other word, and between pieces.
2. For k = 2, 3, ... the Apriori-safe candidates are the k-word stretches whose first and last
   k - 1 words are both frequent. They are taken where they occur, as pairs of frequent words all
   told are a square, and those whose occurrences don't sum to LEAST go.
3. What is left is dealt to double-array tries of at most TRIE phrases. Each trie is broadcast;
   numpy advances the states of all text positions at once, one word after the other, and
   bincounts the accepting states; the sums over all shards of the text are the counts. The same
   pass finds the candidates of the next length from the states that are alive.
4. Every cut of a phrase is scored from these counts, in decimals of 38 digits.

Nothing depends on the corpus fitting a broadcast: more phrases are more tries, more frequent
words more dictionaries of at most DICTIONARY words, each with a pass over the numbers.

Defined results: a null or empty text has no words, a null language is `und`; repeated rows
count each; phrases end at punctuation and at line ends; ties in score go by count, then by the
phrase's bytes; a text of any length counts whole; an empty table gives an empty result; other
columns play no part.
"""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import bound_batches, materialize, quoted, scope
from .textbytes import releasing, text_buffer

LEAST = 100
LONGEST = 5
BEST = 2000
TRIE = 1 << 20
#: Slots of a trie that are tried for a state of several words before it goes to the end.
TRIES = 64
DICTIONARY = 1 << 21
#: Bytes of the words in one dictionary at most.
DICTIONARY_BYTES = 64 << 20
PUNCTUATION = re.compile(rb"[.,;:!?\n-\r]+")
WORD = re.compile(rb"[^ \t\n]+|\n")


def tokens(text: bytes) -> list[bytes]:
    """Words of a text, and a line feed between its pieces."""
    return WORD.findall(PUNCTUATION.sub(b"\n", text.lower()))


def _texts(batch: pa.RecordBatch):
    """(language, text) of each row."""
    data, offsets = text_buffer(batch.column(1))
    for lang, a, b in zip(batch.column(0).to_pylist(), offsets[:-1], offsets[1:], strict=True):
        yield lang, data[a:b].tobytes()


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, word, a of all words of docs (lang, text)."""

    def run(batches):
        for batch in batches:
            found: dict[str, Counter] = {}
            for lang, text in _texts(batch):
                found.setdefault(lang, Counter()).update(tokens(text))
            for lang, counts in found.items():
                counts.pop(b"\n", None)
                words = pa.array(list(counts), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), words, pa.array(list(counts.values()), pa.int64())], names=["lang", "word", "n"])

    parts = docs.mapInArrow(releasing(run), "lang string, word string, n long")
    return parts.groupBy("lang", "word").agg(F.sum("n").alias("a"))


def _frequent(counts: DataFrame, least: int) -> DataFrame:
    """lang, word, a, number (from 0, without gaps) of the frequent words."""
    found = materialize(counts.filter(F.col("a") >= least).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    sizes = dict(found.groupBy(part.alias("p")).count().collect())  # one row per partition
    first, total = {}, 0
    for p in sorted(sizes):
        first[p], total = total, total + sizes[p]
    starts = found.sparkSession.createDataFrame([(p, n) for p, n in first.items()], "p long, first long")
    place = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return materialize(found.withColumn("p", part).join(F.broadcast(starts), "p").select("lang", "word", "a", (F.col("first") + place).cast("int").alias("number")))


def _dictionaries(words: DataFrame):
    """Broadcasts of lang -> word -> number, in parts of bounded size."""
    total, size = words.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("word")), F.lit(0))).first()
    parts = max(1, -(-total // DICTIONARY), -(-size // DICTIONARY_BYTES))
    for part in range(parts):
        found: dict[str, dict[bytes, int]] = {}
        table = words.filter(F.pmod(F.xxhash64("word"), F.lit(parts)) == part).select("lang", "word", "number").toArrow()
        for lang, word, number in zip(*(c.to_pylist() for c in table.columns), strict=True):
            found.setdefault(lang, {})[word.encode()] = number
        yield part == parts - 1, words.sparkSession.sparkContext.broadcast(found)


def _numbered(docs: DataFrame, words: DataFrame) -> DataFrame:
    """numbers of each text of docs (lang, text): 32-bit, -1 after the last."""

    def numbering(shared, last):
        def run(batches):
            for batch in batches:
                out = []
                for (lang, text), before in zip(_texts(batch), batch.column(2), strict=True):
                    get = shared.value.get(lang, {}).get
                    found = tokens(text)
                    numbers = np.full(len(found) + 1, -1, "<i4")
                    numbers[:-1] = np.fromiter((get(w, -1) for w in found), np.int32, len(found))
                    if before.is_valid:
                        numbers = np.maximum(numbers, np.frombuffer(before.as_py(), "<i4"))
                    out.append(numbers.tobytes())
                texts = pa.nulls(len(out), pa.string()) if last else batch.column(1)
                yield pa.RecordBatch.from_arrays([batch.column(0), texts, pa.array(out, pa.binary())], names=["lang", "text", "numbers"])

        return releasing(run)

    docs = docs.withColumn("numbers", F.lit(None).cast("binary"))
    for last, shared in _dictionaries(words):
        docs = materialize(docs.mapInArrow(numbering(shared, last), "lang string, text string, numbers binary"))
    return docs.select("numbers", F.lit(None).cast("binary").alias("alive"))


class Trie:
    """A double-array trie of phrases of k words each: from state s, word w leads to t = base[s] + w where check[t] = s."""

    def __init__(self, phrases: np.ndarray):
        self.phrases = phrases = phrases[np.lexsort(phrases.T[::-1])]
        m, k = phrases.shape
        size = int(phrases.max()) + 2 if m else 1
        self.base, self.check = np.zeros(size, np.int32), np.full(size, -1, np.int32)
        self.used = np.zeros(size, bool)
        self.used[0] = True  # the root
        state = np.zeros(m, np.int64)
        for d in range(k):
            label = phrases[:, d].astype(np.int64)
            fresh = np.r_[True, (state[1:] != state[:-1]) | (label[1:] != label[:-1])][:m]
            parent, word = state[fresh], label[fresh]
            first = np.flatnonzero(np.r_[True, parent[1:] != parent[:-1]][: len(parent)])
            self._place(parent[first], word, first, np.diff(np.r_[first, len(word)]))
            slot = self.base[parent] + word
            state = slot[np.cumsum(fresh) - 1]
        self.accepts = np.full(len(self.base), -1, np.int32)
        self.accepts[state] = np.arange(m)
        del self.used

    def _grow(self, size: int) -> None:
        more = size - len(self.base)
        if more > 0:
            more += size // 4
            self.base, self.check, self.used = np.r_[self.base, np.zeros(more, np.int32)], np.r_[self.check, np.full(more, -1, np.int32)], np.r_[self.used, np.zeros(more, bool)]

    def _place(self, parents, word, first, times) -> None:
        """Give each parent a base under which the slots of its words (word[first : first + times], ascending) are free."""
        several, top = np.flatnonzero(times > 1), int(np.flatnonzero(self.used)[-1]) + 1
        draw = np.random.default_rng(0)
        for i in several[np.argsort(-times[several], kind="stable")].tolist():
            own = word[first[i] : first[i] + times[i]] - word[first[i]]
            spread = int(own[-1])
            self._grow(top + spread + 1)  # behind all that is used there is always room
            # a few states of many words need the thin end of the array, those of few words find gaps anywhere
            tried = draw.integers(max(1, top - spread) if len(own) > 8 else 1, top + 1, TRIES)
            fits = tried[~self.used[tried[:, None] + own].any(1)]
            at = int(fits.min()) if len(fits) else top
            top = max(top, at + spread + 1)
            self._set(parents[i : i + 1], np.array([at - word[first[i]]]), own + word[first[i]])
        lone = np.flatnonzero(times == 1)
        if len(lone):
            self._grow(int(self.used.sum()) + len(lone))
            at = np.flatnonzero(~self.used)[: len(lone)]
            self._set(parents[lone], at - word[first[lone]], word[first[lone]])

    def _set(self, parents, bases, own) -> None:
        self.base[parents] = bases
        self.check[bases + own] = parents
        self.used[bases + own] = True

    def walk(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, row of phrases) of every phrase in numbers: the states of all positions advance together, word by word."""
        at = np.flatnonzero(numbers[: max(0, len(numbers) - self.phrases.shape[1] + 1)] >= 0)
        state = np.zeros(len(at), np.int64)
        for d in range(self.phrases.shape[1]):
            word = numbers[at + d]
            to = self.base[state] + word.astype(np.int64)
            good = np.flatnonzero((word >= 0) & (to >= 0) & (to < len(self.check)))
            good = good[self.check[to[good]] == state[good]]
            at, state = at[good], to[good]
        return at, self.accepts[state]


def _key(rows: np.ndarray) -> list[bytes]:
    """Rows of numbers as big-endian bytes."""
    raw, width = np.ascontiguousarray(rows, ">i4").tobytes(), 4 * rows.shape[1]
    return [raw[a : a + width] for a in range(0, len(raw), width)]


def distinct(numbers: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of k numbers, times) of the stretches of numbers from each place on."""
    code = numbers[at].astype(np.int64)
    for d in range(1, k):
        _, code = np.unique(code << 32 | numbers[at + d].astype(np.int64), return_inverse=True)
    _, first, times = np.unique(code, return_index=True, return_counts=True)
    return numbers[at[first][:, None] + np.arange(k)], times


_PASS = "numbers binary, alive binary, found binary, candidate binary, n long"


def _pass(texts: DataFrame, trie: Trie | None, k: int, last: bool) -> DataFrame:
    """One pass over texts (numbers, alive: places where a frequent phrase of k - 1 words begins).

    found, n: occurrences of trie's phrases. candidate, n: of stretches of k words whose ends are frequent (last trie).
    Else the texts, with alive completed by this trie.
    """
    shared = texts.sparkSession.sparkContext.broadcast(trie)

    def batch_of(numbers=None, alive=None, found=None, candidate=None, n=None):
        columns = [numbers, alive, found, candidate, n]
        size = max(len(c) for c in columns if c is not None)
        kinds = [pa.binary()] * 4 + [pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array([None] * size if c is None else c, t) for c, t in zip(columns, kinds, strict=True)], names=["numbers", "alive", "found", "candidate", "n"])

    def run(batches):
        trie = shared.value
        sums = np.zeros(len(trie.phrases) if trie else 0, np.int64)
        for batch in batches:
            column = batch.column(0)
            numbers = np.frombuffer(b"".join(column.to_pylist()), "<i4")
            alive = numbers >= 0
            if trie:
                marks = batch.column(1)
                if marks.null_count:
                    alive = np.zeros(len(numbers), bool)
                else:
                    alive = np.frombuffer(b"".join(marks.to_pylist()), bool).copy()
                at, row = trie.walk(numbers)
                sums += np.bincount(row, minlength=len(sums))
                alive[at] = True
            if last and k:
                at = np.flatnonzero(alive[:-1] & alive[1:])
                at = at[at + k <= len(numbers)]
                rows, times = distinct(numbers, at, k)
                if len(rows):
                    yield batch_of(candidate=_key(rows), n=times)
            elif not last:
                cut = np.cumsum([0, *(len(x) for x in column.to_pylist())]) // 4
                yield batch_of(numbers=column.to_pylist(), alive=[alive[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)])
        here = np.flatnonzero(sums)
        if len(here):
            yield batch_of(found=_key(trie.phrases[here]), n=sums[here])

    passed = texts.select("numbers", "alive").mapInArrow(releasing(run), _PASS)
    return materialize(passed) if trie else passed  # without a trie there are candidates alone, which are read once


def _sums(passed: DataFrame, kind: str) -> DataFrame:
    return passed.filter(F.col(kind).isNotNull()).groupBy(F.col(kind).alias("phrase")).agg(F.sum("n").alias("a"))


def _tries(phrases: DataFrame, k: int, size: int):
    """Tries of all phrases (k numbers each as bytes), of at most about size phrases; (is it the last, trie)."""
    parts = max(1, -(-phrases.count() // size))
    for part in range(parts):
        some = phrases.select("phrase").filter(F.pmod(F.xxhash64("phrase"), F.lit(parts)) == part).toArrow()["phrase"].to_pylist()
        yield part == parts - 1, Trie(np.frombuffer(b"".join(some), ">i4").astype(np.int32).reshape(-1, k))


def frequent_phrases(texts: DataFrame, least: int, longest: int, trie: int | None = None) -> DataFrame:
    """phrase (numbers as big-endian bytes), a of all phrases of 2 to longest numbers with at least least occurrences."""
    passed, out = _pass(texts, None, 2, True), []
    for k in range(2, longest + 1):
        candidates = materialize(_sums(passed, "candidate").filter(F.col("a") >= least))
        here = texts
        for last, some in _tries(candidates, k, trie or TRIE):
            passed = _pass(here, some, k + 1 if k < longest else 0, last)
            out.append(_sums(passed, "found"))
            here = passed.filter(F.col("numbers").isNotNull())
    found = out[0]
    for more in out[1:]:
        found = found.union(more)
    return materialize(found)


def mine(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, longest: int = LONGEST, best: int = BEST) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the best phrases of each language of docs."""
    bound_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(quoted(lang_col)).cast("string"), F.lit("und")).alias("lang"), F.col(quoted(text_col)).cast("string").alias("text"))
    with scope(docs.sparkSession):
        counts = materialize(word_counts(texts))
        totals = materialize(counts.groupBy("lang").agg(F.sum("a").alias("n")))
        words = _frequent(counts, least)
        phrases = frequent_phrases(_numbered(texts, words), least, longest)
        size = F.octet_length("phrase")
        key = F.unhex(F.lpad(F.hex("number"), 8, "0"))
        f = materialize(words.select(key.alias("part"), "a").union(phrases.select("phrase", "a")))
        cuts = phrases.select("phrase", "a", F.expr("octet_length(phrase) div 4").alias("k")).withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
        cuts = cuts.select("phrase", "a", "cut", F.expr("substring(phrase, 1, 4 * cut)").alias("head"), F.expr("substring(phrase, 4 * cut + 1)").alias("tail"), F.expr("substring(phrase, 1, 4)").alias("first"))
        cuts = cuts.join(f.select(F.col("part").alias("head"), F.col("a").alias("l")), "head").join(f.select(F.col("part").alias("tail"), F.col("a").alias("r")), "tail")
        cuts = cuts.join(words.select(key.alias("first"), "lang"), "first").join(totals, "lang")
        wide = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
        score = F.expr(f"CAST(1000 AS DECIMAL(4, 0)) * ({wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')})")
        scored = cuts.groupBy("phrase", "a", "lang", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("m"))
        # phrases inside a longer one that is as frequent
        inner = phrases.filter(size > 8).select("a", "phrase", F.expr("octet_length(phrase) div 4").alias("k"))
        inner = inner.withColumn("part", F.explode(F.expr("flatten(transform(sequence(2, k - 1), w -> transform(sequence(0, k - w), i -> substring(phrase, 4 * i + 1, 4 * w))))")))
        inner = inner.groupBy("part").agg(F.max("a").alias("longer"))
        kept = materialize(scored.join(inner, scored["phrase"] == inner["part"], "left").filter("longer IS NULL OR 100 * longer < 100 * a").select("phrase", "a", "lang", "n", "m.score", "m.l", "m.r"))
        # the words back
        place = F.posexplode(F.expr("transform(sequence(0, octet_length(phrase) div 4 - 1), i -> substring(phrase, 4 * i + 1, 4))")).alias("i", "part")
        spelled = kept.select(F.col("phrase").alias("id"), place).join(words.select(key.alias("part"), "word"), "part")
        spelled = spelled.groupBy("id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("i", "word"))), lambda x: x["word"]), " ").alias("phrase"))  # at most longest words
        whole = kept.withColumnRenamed("phrase", "id").join(spelled, "id")
        ranked = _ranked(kept.withColumnRenamed("phrase", "id").join(spelled, "id"), best)
        return materialize(ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score"), keep=True)


def _ranked(rows: DataFrame, best: int) -> DataFrame:
    """rows with their rank in lang, up to best: sorted over all tasks and numbered from the tasks' counts, so that no language is one task."""
    by = [F.col("lang"), F.desc("score"), F.desc("a"), F.col("phrase")]
    sorted_ = rows.repartitionByRange(*by).sortWithinPartitions(*by).select(*rows.columns)
    kinds = rows.schema

    def number(batches):
        task, lang, at = TaskContext.get().partitionId(), None, 0
        where = kinds.names.index("lang")
        for batch in batches:
            places = []
            for v in batch.column(where).to_pylist():
                lang, at = v, at + 1 if v == lang else 1
                places.append(at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([task] * len(places), pa.int32()), pa.array(places, pa.int64())], names=[*kinds.names, "task", "place"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kinds)
    # the first best of a task are enough of it, and a full count stands for more
    placed = materialize(sorted_.mapInArrow(releasing(number), f"{schema}, task int, place long").filter(F.col("place") <= best))
    tasks = placed.groupBy("lang", "task").agg(F.max("place").alias("m"))
    before = F.coalesce(F.sum("m").over(Window.partitionBy("lang").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = F.broadcast(tasks.select("lang", "task", before.alias("before")))  # one row per task and language in it
    return placed.join(tasks, ["lang", "task"]).withColumn("rank", F.col("place") + F.col("before")).filter(F.col("rank") <= best)


def query(docs: DataFrame) -> DataFrame:
    return mine(docs)


_TABLES = ", ".join(f"""c{k} AS (SELECT lang, array_to_string(w[1:{k}], ' ') AS phrase, {k} AS k, count(*) AS f FROM t WHERE len(w) >= {k} GROUP BY ALL)""" for k in range(1, LONGEST + 1))
SQL = rf"""
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS p FROM documents WHERE text IS NOT NULL),
s AS (SELECT lang, regexp_extract_all(p, '[^ 	]+') AS w FROM pieces),
t AS (SELECT lang, w[i + 1 : i + {LONGEST}] AS w FROM (SELECT lang, w, unnest(range(len(w))) AS i FROM s)),
{_TABLES},
n AS (SELECT lang, sum(f)::BIGINT AS n FROM c1 GROUP BY lang),
f AS ({" UNION ALL ".join(f"SELECT * FROM c{k} WHERE f >= {LEAST}" for k in range(1, LONGEST + 1))}),
p AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
cut AS (SELECT *, array_to_string(w[1:c], ' ') AS head, array_to_string(w[c + 1:], ' ') AS tail FROM (SELECT *, unnest(range(1, k)) AS c FROM p)),
x AS (SELECT cut.lang, cut.phrase, cut.f AS a, c, h.f AS l, t.f AS r, n, ((1000::HUGEINT * cut.f * n) // (h.f::HUGEINT * t.f))::BIGINT AS score
  FROM cut JOIN f h ON cut.lang = h.lang AND head = h.phrase JOIN f t ON cut.lang = t.lang AND tail = t.phrase JOIN n ON cut.lang = n.lang),
y AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) = 1),
b AS (SELECT lang, array_to_string(w[i + 1 : i + m], ' ') AS phrase, max(f) AS longer FROM (SELECT *, unnest(range(k - m + 1)) AS i FROM (SELECT *, unnest(range(2, k)) AS m FROM p)) GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM y LEFT JOIN b USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 100 * a QUALIFY rank <= {BEST}
"""
