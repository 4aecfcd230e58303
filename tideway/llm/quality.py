"""Quality rules with adaptive thresholds (operator 10), built-in expressions only.

Counts per text are taken with array functions. Thresholds are not fixed: for each
language and source, a mergeable quantile sketch of every ratio, over the texts that pass
the base rules, gives a low and a high quantile, and a text goes when a ratio lies further
outside them than REACH times their distance. The sketch is a histogram over buckets of
bounded relative width, held as rows (group, metric, bucket, count): merging is a sum, so
languages and the whole corpus reuse the same rows, hot sources are pre-aggregated before
the shuffle, and its size does not follow the rows.

Each metric has quantiles of its own (METRICS): quartiles where up to a quarter of a source
may be junk; deciles for the length of words; and tails for ratios that are 0 in most texts,
where only the tail says what is usual. The quantiles of a small group lean on its language's,
and these on the corpus's, as if PRIOR rows of them were in the group: nothing switches at a
size. FLOOR is the least distance, about the rounding of a metric, so that a group of
equal texts does not reject the next one.

Defined results: a null text has no words and fails; null languages and sources form
groups of their own; a group without a text that passes the base rules has no limits, and
needs none; ties and repeated rows count once each; an empty table gives an empty result;
other columns are left alone, whatever their names.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import fresh, materialize, own_columns, quoted, scope

SPACES = " \t\n\x0b\x0c\r"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Rows by which a group's quantiles lean on those of the wider group.
PRIOR = 50
#: metric: (low quantile, high quantile, in percent; REACH; FLOOR in units of the metric; whether low values go too)
METRICS = {
    "marks": (25, 75, 6, 25, False),  # ASCII characters in words that are neither letters nor digits, per 1000 characters of words
    "word_chars": (10, 90, 3, 100, True),  # characters of words per 1000 words
    "repeats": (50, 95, 6, 100, False),  # words in repeated windows per 1000 words
    "dup_lines": (50, 98, 6, 300, False),  # repeated lines per 1000 lines with a word
}
#: Groups up to which their limits are broadcast; beyond, the join shuffles.
BROADCAST_GROUPS = 100_000
MARKS = r"[^!-/:-@\[-`{-~]+"


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more."""
    n = F.size(words)
    grams = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(n >= 3, grams)


def _covered(grams: Column) -> Column:
    ordered = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

    def covered(s: Column) -> Column:
        twice = F.filter(s, lambda e, k: (F.get(s, k - 1)["g"] == e["g"]) | (F.get(s, k + 1)["g"] == e["g"]))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2)))))

    # a one-element array names the sorted array, so that it is computed once
    return F.element_at(F.transform(F.array(ordered), covered), 1)


def with_counts(docs: DataFrame, text_col: str = "text", out: str = "q_") -> DataFrame:
    """docs with columns {out}n_words, n_chars, n_symbols, n_marks, n_lines, n_dup_lines, n_repeat_words (bigint)."""
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    words = F.when(trimmed != "", F.split(trimmed, r"[\x09-\x0D\x20]+")).otherwise(F.array().cast("array<string>"))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    step = docs.withColumns({f"{out}words": words, f"{out}lines": lines})
    step = step.withColumn(f"{out}grams", _repeat_words(F.col(f"{out}words")))
    w, ln, g = (F.col(out + x) for x in ("words", "lines", "grams"))
    step = step.withColumns({
        f"{out}n_words": F.size(w).cast("long"),
        f"{out}n_chars": F.length(F.array_join(w, "")).cast("long"),
        f"{out}n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        f"{out}n_marks": F.length(F.regexp_replace(text, MARKS, "")).cast("long"),
        f"{out}n_lines": F.size(ln).cast("long"),
        f"{out}n_dup_lines": (F.size(ln) - F.size(F.array_distinct(ln))).cast("long"),
        f"{out}n_repeat_words": F.when(g.isNotNull() & (F.size(F.array_distinct(g)) < F.size(g)), _covered(g)).otherwise(0).cast("long"),
    })
    return step.drop(f"{out}words", f"{out}lines", f"{out}grams")


def _per_mille(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.floor(1000 * part / F.greatest(whole, F.lit(1)))).otherwise(0).cast("long")


def _metric(name: str, out: str) -> Column:
    part, whole = {"marks": ("n_marks", "n_chars"), "word_chars": ("n_chars", "n_words"), "repeats": ("n_repeat_words", "n_words"), "dup_lines": ("n_dup_lines", "n_lines")}[name]
    return _per_mille(F.col(out + part), F.col(out + whole))


def _base_failed(out: str) -> Column:
    return (F.col(f"{out}n_words") < MIN_WORDS) | (100 * F.col(f"{out}n_repeat_words") > MAX_REPEAT_PERCENT * F.col(f"{out}n_words"))


def _bucket(v: Column) -> Column:
    """v with its seven leading binary digits kept: buckets of under 1/64 relative width."""
    unit = F.pow(F.lit(2), F.greatest(F.length(F.bin(v)) - 7, F.lit(0))).cast("long")
    return v - v % unit


def sketches(counted: DataFrame, lang_col: str, source_col: str, out: str = "q_") -> DataFrame:
    """Rows (lang, source, metric, bucket, n): one mergeable sketch for each group and metric, of the texts that pass the base rules."""
    values = F.map_from_arrays(F.array(*map(F.lit, METRICS)), F.array(*(_bucket(_metric(m, out)) for m in METRICS)))
    return (
        counted.filter(~_base_failed(out))
        .select(F.col(quoted(lang_col)).alias("lang"), F.col(quoted(source_col)).alias("source"), F.explode(values).alias("metric", "bucket"))
        .groupBy("lang", "source", "metric", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def merge(sketch: DataFrame, *keys: str) -> DataFrame:
    """Sketches of the coarser groups that keys name."""
    return sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, *keys: str) -> DataFrame:
    """One row per group: its rows, and the low and high quantile of each metric. A group's buckets are bounded, and so is its window."""
    of = Window.partitionBy(*keys, "metric")
    ranked = sketch.withColumns({"below": F.sum("n").over(of.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)), "rows": F.sum("n").over(of)})
    at = lambda m, percent: F.min(F.when((F.col("metric") == m) & (100 * F.col("below") >= percent * F.col("rows")), F.col("bucket")))
    each = [at(m, p).alias(f"{m}_{side}") for m, (low, high, *_) in METRICS.items() for side, p in (("low", low), ("high", high))]
    return ranked.groupBy(*keys).agg(F.max("rows").alias("rows"), *each)


def _leaning(name: str, rows: str, own: str, wide: Column) -> Column:
    """A group's quantile with PRIOR rows of the wider group's in it."""
    total = F.col(f"{own}.{rows}")
    return F.floor((total * F.col(f"{own}.{name}") + PRIOR * wide) / (total + PRIOR)).cast("long")


def limits(sketch: DataFrame) -> DataFrame:
    """One row per (lang, source): for each metric the highest value that stays, and the lowest where low ones go."""
    by_lang = quantiles(merge(sketch, "lang"), "lang").alias("l").join(quantiles(merge(sketch)).alias("t"), F.lit(True))  # t is one row
    names = [f"{m}_{side}" for m in METRICS for side in ("low", "high")]
    by_lang = by_lang.select("l.lang", *(_leaning(n, "rows", "l", F.col(f"t.{n}")).alias(n) for n in names)).alias("l")
    both = quantiles(sketch, "lang", "source").alias("o").join(by_lang, F.col("o.lang").eqNullSafe(F.col("l.lang")))
    both = both.select("o.lang", "o.source", *(_leaning(n, "rows", "o", F.col(f"l.{n}")).alias(n) for n in names))
    out = []
    for m, (*_, reach, floor, both_sides) in METRICS.items():
        low, high = F.col(f"{m}_low"), F.col(f"{m}_high")
        distance = F.greatest(reach * (high - low), F.lit(floor))
        out.append((high + distance).alias(f"{m}_most"))
        if both_sides:
            out.append((low - distance).alias(f"{m}_least"))
    return both.select("lang", "source", *out)


def judged(counted: DataFrame, lang_col: str, source_col: str, out: str = "q_") -> DataFrame:
    """counted with {out}base_failed and {out}kept. counted is read twice: materialize it first. No column of it may begin with {out}f_.

    The limits are written and counted, and broadcast up to BROADCAST_GROUPS groups, so that the texts are not shuffled.
    """
    found = materialize(limits(sketches(counted, lang_col, source_col, out)))
    few = found.count() <= BROADCAST_GROUPS
    found = found.select(*(F.col(c).alias(f"{out}f_{c}") for c in found.columns))
    inside = F.lit(True)
    for m, (*_, both_sides) in METRICS.items():
        inside &= _metric(m, out) <= F.col(f"{out}f_{m}_most")
        if both_sides:
            inside &= _metric(m, out) >= F.col(f"{out}f_{m}_least")
    on = F.col(quoted(lang_col)).eqNullSafe(F.col(f"{out}f_lang")) & F.col(quoted(source_col)).eqNullSafe(F.col(f"{out}f_source"))
    joined = counted.join(F.broadcast(found) if few else found, on, "left")
    failed = _base_failed(out)
    return joined.withColumns({f"{out}base_failed": failed, f"{out}kept": ~failed & F.coalesce(inside, F.lit(True))}).drop(*found.columns)


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per row of docs: its counts, base_failed and kept."""
    narrow = docs.select(*(F.col(quoted(c)).alias(n) for c, n in ((id_col, "doc_id"), (text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    q = lambda x: F.col("q_" + x)
    with scope(docs.sparkSession):
        counted = materialize(with_counts(narrow).drop("text"))
        columns = [q("n_words").alias("n_words"), q("n_chars").alias("word_chars"), *(q(c).alias(c) for c in ("n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"))]
        return materialize(judged(counted, "lang", "source").select("doc_id", *columns), keep=True)


def keep(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of docs that the rules keep, with the columns of docs."""
    out = fresh(docs, "__q_")
    counted = materialize(with_counts(docs, text_col, out))
    return judged(counted, lang_col, source_col, out).filter(F.col(f"{out}kept")).select(*own_columns(docs))


def _sql() -> str:
    values = {"marks": ("n_marks", "word_chars"), "word_chars": ("word_chars", "n_words"), "repeats": ("n_repeat_words", "n_words"), "dup_lines": ("n_dup_lines", "n_lines")}
    per_mille = lambda m: f"CASE WHEN {values[m][1]} > 0 THEN 1000 * {values[m][0]} // greatest({values[m][1]}, 1) ELSE 0 END"
    longs = " UNION ALL ".join(f"SELECT doc_id, lang, source, '{m}' AS metric, {per_mille(m)} AS v FROM m WHERE NOT base_failed" for m in METRICS)
    case = lambda at: "CASE metric " + " ".join(f"WHEN '{m}' THEN {spec[at]}" for m, spec in METRICS.items()) + " END"
    level = lambda keys: (
        f"SELECT {keys}metric, max(rows) AS rows, min(CASE WHEN 100 * below >= {case(0)} * rows THEN bucket END) AS low, min(CASE WHEN 100 * below >= {case(1)} * rows THEN bucket END) AS high FROM "
        f"(SELECT {keys}metric, bucket, sum(n) OVER (PARTITION BY {keys}metric ORDER BY bucket) AS below, "
        f"sum(n) OVER (PARTITION BY {keys}metric) AS rows FROM (SELECT {keys}metric, bucket, sum(n) AS n FROM k GROUP BY ALL)) GROUP BY ALL"
    )
    lean = lambda own, wide: ", ".join(f"({own}.rows * {own}.{q} + {PRIOR} * {wide}.{q}) // ({own}.rows + {PRIOR}) AS {q}" for q in ("low", "high"))
    return rf"""
WITH w AS (SELECT *, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ln FROM documents),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3))),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM g, (SELECT unnest([0, 1, 2]) AS j) WHERE c > 1 GROUP BY doc_id),
n AS (SELECT doc_id, lang, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: len(x))), 0) AS word_chars, len(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
 len(regexp_replace(coalesce(text, ''), '{MARKS}', '', 'g')) AS n_marks, len(ln) AS n_lines, len(ln) - len(list_distinct(ln)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN r USING (doc_id)),
m AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM n),
v AS ({longs}),
k AS (SELECT lang, source, metric, v - v % CAST(pow(2, greatest(len(bin(CAST(v AS BIGINT))) - 7, 0)) AS BIGINT) AS bucket, count(*) AS n FROM v GROUP BY ALL),
o AS ({level("lang, source, ")}), l AS ({level("lang, ")}), t AS ({level("")}),
lt AS (SELECT l.lang, l.metric, {lean("l", "t")} FROM l JOIN t ON l.metric = t.metric),
q AS (SELECT o.lang, o.source, o.metric, {lean("o", "lt")} FROM o JOIN lt ON o.lang IS NOT DISTINCT FROM lt.lang AND o.metric = lt.metric),
f AS (SELECT *, greatest({case(2)} * (high - low), {case(3)}) AS distance, {case(4)} AS both_sides FROM q),
bad AS (SELECT DISTINCT doc_id FROM v JOIN f ON v.lang IS NOT DISTINCT FROM f.lang AND v.source IS NOT DISTINCT FROM f.source AND v.metric = f.metric WHERE v > high + distance OR (both_sides AND v < low - distance))
SELECT m.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.doc_id IS NULL AS kept FROM m LEFT JOIN bad ON bad.doc_id = m.doc_id
"""


SQL = _sql()
