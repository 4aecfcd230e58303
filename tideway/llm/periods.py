"""Periodic run detection (operator 12): stretches of words that repeat with a period.

A run is a stretch of consecutive words with smallest period q and a length of at least
max(LEAST, TIMES * q) that no neighbouring word extends. Words of equal place on a diagonal
(word i equals word i - q) increment the match length of lag q; a diagonal that ends with
enough of them is a run. A DP over all pairs of equal words takes the square of a frequent
word's count, so the diagonals are kept sparse by context: for lags from 2**k to 2**(k+1) - 1
an earlier occurrence counts only where the last 2**(k+1) words agree, and then only the
nearest one. That loses no run and finds no false one:

- In a run of smallest period q, and at least 4q words, a context of q words or more recurs at
  multiples of q only, so the nearest earlier one lies at lag q, at every word from the first
  whose context and its earlier occurrence lie in the run. These words are consecutive.
- A stretch where it lies at lag q has period q, and no smaller one, which would be nearer.

Contexts are numbered by doubling: one of 2**(k+1) words is a pair of two of 2**k words, and
those that occur once in a text drop out. So a text of n words takes O(n log n) a level, at
most log n levels, and prose, whose contexts of a few words are unique, two or three. Numbers
are exact, nothing is hashed. Texts of a batch are searched together, under words of their own.

Defined results: words are the longest stretches without ASCII white space; a null or empty
text has no words and no runs; equal rows give equal results; a text of any length is searched
whole; an empty table gives an empty result; other columns play no part.
"""

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import bound_batches, quoted
from .textbytes import blocks, releasing, text_buffer

LEAST = 6
TIMES = 4
TEXT_BYTES = 2 << 20  # texts that are searched together


def runs(word: np.ndarray) -> np.ndarray:
    """(start, length, period) rows of all runs in a sequence of word numbers, by start, then period."""
    n, half, out = len(word), 1, [np.zeros((0, 3), np.int64)]
    code, at = np.asarray(word, np.int64), np.arange(n)
    while half * TIMES <= n and len(at):
        # contexts of twice the words, of those that are repeated; -1: not
        at = at[at >= half]
        at = at[code[at - half] >= 0]
        _, number, times = np.unique(code[at - half] * (n + 1) + code[at], return_inverse=True, return_counts=True)
        again = times[number] > 1
        at, number = at[again], number[again]
        code = np.full(n, -1, np.int64)
        code[at] = number
        # the nearest earlier occurrence of each word in its context
        order = np.argsort(number, kind="stable")
        lag = np.zeros(len(at), np.int64)
        same = number[order[1:]] == number[order[:-1]]
        lag[order[1:][same]] = (at[order[1:]] - at[order[:-1]])[same]
        here = (lag >= half) & (lag < 2 * half)
        i, q = at[here], lag[here]
        if len(i):
            # a diagonal goes on while the next word has the same lag; its match length counts the context too
            fresh = np.flatnonzero(np.r_[True, (np.diff(i) != 1) | (np.diff(q) != 0)])
            last = np.r_[fresh[1:], len(i)] - 1
            start = i[fresh] - 2 * half + 1 - q[fresh]
            found = np.stack([start, i[last] + 1 - start, q[fresh]], axis=1)
            out.append(found[found[:, 1] >= np.maximum(LEAST, TIMES * q[fresh])])
        half *= 2
    found = np.concatenate(out)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def text_runs(texts: list[list[bytes]]) -> list[np.ndarray]:
    """The runs of each of some texts, given as words."""
    numbers: list[np.ndarray] = []
    used = 0
    for words in texts:
        seen: dict[bytes, int] = {}
        numbers.append(np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words)) + used)
        used += len(seen)
    first = np.cumsum([0, *map(len, texts)])
    found = runs(np.concatenate(numbers) if numbers else np.zeros(0, np.int64))
    cut = np.searchsorted(found[:, 0], first)
    return [found[a:b] - [f, 0, 0] for a, b, f in zip(cut[:-1], cut[1:], first[:-1], strict=True)]


def collapse(words: list[bytes], found: np.ndarray) -> list[bytes]:
    """words without those that a run contains after its first period."""
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0)]


def greatest(found: np.ndarray):
    """(start, length, period) of the run with the greatest exponent length / period; ties: least start, then period."""
    return min(found.tolist(), key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if len(found) else None


_OUT = "id {kind}, n_runs long, runs array<struct<start: long, length: long, period: long>>, start long, length long, period long, exponent_milli long, collapsed string, runs_sha256 string, collapsed_sha256 string"


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_runs, runs, the greatest one, the collapsed text, and digests of the runs and of that text, per row of docs."""
    bound_batches(docs.sparkSession)
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches):
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            for a, b in blocks(offsets, TEXT_BYTES):
                texts = [data[s:e].tobytes().split() for s, e in zip(offsets[a:b], offsets[a + 1 : b + 1], strict=True)]
                rows = []
                for words, found in zip(texts, text_runs(texts), strict=True):
                    best = greatest(found) or [None] * 3
                    kept = b" ".join(collapse(words, found) if len(found) else words)
                    listed = "".join(f"{s},{n},{q}\n" for s, n, q in found.tolist())
                    milli = best[1] * 1000 // best[2] if len(found) else None
                    each = [dict(zip(("start", "length", "period"), r, strict=True)) for r in found.tolist()]
                    rows.append((len(found), each, *best, milli, kept.decode(), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()))
                kinds = [pa.int64(), run_type, *[pa.int64()] * 4, pa.string(), pa.string(), pa.string()]
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = ["id", "n_runs", "runs", "start", "length", "period", "exponent_milli", "collapsed", "runs_sha256", "collapsed_sha256"]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], names=names)

    narrow = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text"))
    kind = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(releasing(run), _OUT.format(kind=kind)).withColumnRenamed("id", id_col)


def planted(text: Column, doc_id: Column) -> Column:
    """text, in a tenth of the ids with its words repeated periodically from some word on, as the query's contract says; an id that is null is not one of them."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", -1), lambda w: w != "")

    def rewritten(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = F.pmod(g, n)
        p = F.floor((n - a) / (3 + F.pmod(g, F.lit(8)))).cast("long") + 1
        places = F.sequence(F.lit(0).cast("long"), n - 1)
        return F.array_join(F.transform(places, lambda i: F.get(w, F.when(i >= a, a + F.pmod(i - a, p)).otherwise(i).cast("int"))), " ")

    return F.when((F.pmod(h, F.lit(10)) == 0) & (F.size(words) > 0), F.element_at(F.transform(F.array(words), rewritten), 1)).otherwise(text)


def query(docs: DataFrame) -> DataFrame:
    """The runs of all documents, after planted(); digests in place of texts and lists."""
    return detect(docs.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))).drop("runs", "collapsed")


SQL = r"""
WITH h AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS o,
  CASE WHEN doc_id IS NULL THEN NULL ELSE xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(doc_id::VARCHAR)), lambda j: ord(substr(doc_id::VARCHAR, j + 1, 1))::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) END AS h FROM documents),
a AS (SELECT *, len(o) AS n, h // 10 AS g, h % 10 = 0 AND len(o) > 0 AS planted FROM h),
b AS (SELECT *, CASE WHEN planted THEN g % n END AS a FROM a),
p AS (SELECT *, CASE WHEN planted THEN 1 + (n - a) // (3 + g % 8) END AS p FROM b),
w AS (SELECT doc_id, n, i, o[CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word FROM (SELECT *, unnest(range(n)) AS i FROM p)),
m AS (SELECT x.doc_id, x.i, x.i - y.i AS q FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.word = y.word AND y.i < x.i AND 4 * (x.i - y.i) <= x.n),
d AS (SELECT doc_id, q, min(i) - q AS start, count(*) + q AS length FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m) GROUP BY doc_id, q, island),
r AS (SELECT doc_id, start, length, min(q) AS period FROM d WHERE length >= greatest(6, 4 * q) GROUP BY doc_id, start, length),
s AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed FROM r GROUP BY doc_id),
t AS (SELECT doc_id, start, length, period FROM r x WHERE NOT EXISTS (SELECT 1 FROM r y WHERE y.doc_id = x.doc_id AND (y.length * x.period > x.length * y.period OR (y.length * x.period = x.length * y.period AND (y.start < x.start OR (y.start = x.start AND y.period < x.period)))))),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM r),
k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM documents LEFT JOIN s USING (doc_id) LEFT JOIN t USING (doc_id) LEFT JOIN k USING (doc_id)
"""
