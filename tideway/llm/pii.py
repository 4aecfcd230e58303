r"""Personal data (operator 4), built-in expressions only.

Regular expressions propose spans, validators confirm them (Luhn for cards, mod-97 for
IBANs, byte range for IP addresses, digit counts for phones), and context words near a
span adjust its score. Base kinds stay at any score; the kinds that the method adds (iban,
ssn) stay from MIN_SCORE on.

Spark's expressions give the matches of a pattern but not their places. The text between
matches does: splitting at the same pattern yields the parts, and the running sum of the
lengths of parts and matches is each match's start, in code points.

Patterns are written so that Java's engine is linear in the text: possessive quantifiers
where the next character can't be given back, and a check that a match starts where a run
starts, which is where leftmost matching would start it.

Defined results: a null or empty text has no spans; rows are judged one by one, so that
repeated rows, ties and other columns have no effect; an empty table gives an empty result.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import fresh, quoted

MIN_SCORE = 0.5
CONTEXT_CHARS = 40
CHUNK = 256
BLOCK = 1024

PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?+[0-9]){15,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")
#: A text without these can hold no match, and is not searched.
NEEDS = {"email": r"@", "phone": r"\+[0-9]", "iban": r"[A-Z]{2}[0-9]{2}", "ssn": r"[0-9]-[0-9]"}
#: kind: (percent of a confirmed span, added where a context word is near, context words)
SCORES = {
    "email": (80, 20, "mail|contact|reach|write"),
    "ip": (60, 30, "ip|host|server|address|addr"),
    "card": (70, 30, "card|visa|credit|debit|payment|pay"),
    "phone": (60, 30, "phone|tel|call|mobile|fax"),
    "iban": (80, 20, "iban|bank|account|konto|compte|cuenta"),
    "ssn": (20, 50, "ssn|social|security number"),
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _let(value: Column, body) -> Column:
    """body(value), with value computed once for all its uses, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _starts(both: Column) -> Column:
    """For items {part, m}, the running sums of lengths: array<struct<start, end>> of every m."""

    def within(chunk: Column, base: Column) -> Column:
        def add(acc: Column, x: Column) -> Column:
            start = acc["at"] + F.length(x["part"])
            end = start + F.coalesce(F.length(x["m"]), F.lit(0))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end")))).alias("out"))

        nothing = F.array().cast("array<struct<start:int,end:int>>")
        return F.aggregate(chunk, F.struct(base.alias("at"), nothing.alias("out")), add, lambda acc: acc["out"])

    def length(chunk: Column) -> Column:
        return F.aggregate(chunk, F.lit(0), lambda a, x: a + F.length(x["part"]) + F.coalesce(F.length(x["m"]), F.lit(0)))

    def over(chunks: Column) -> Column:
        bases = F.aggregate(chunks, F.array(F.lit(0)), lambda acc, c: F.concat(acc, F.array(F.element_at(acc, -1) + length(c))))
        return F.flatten(_let(bases, lambda b: F.transform(chunks, lambda c, i: within(c, F.get(b, i)))))

    cut = lambda all_: F.transform(F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / CHUNK).cast("int")), lambda k: F.slice(all_, k * CHUNK + 1, F.lit(CHUNK)))
    return _let(both, lambda all_: _let(cut(all_), over))


def matches(text: Column, kind: str) -> Column:
    """array<struct<start, end, m>> of one pattern, leftmost and non-overlapping."""
    pattern = PATTERNS[kind]
    both = F.arrays_zip(F.split(text, pattern, -1).alias("part"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"))
    placed = _let(both, lambda b: F.zip_with(_starts(b), b, lambda p, x: F.struct(p["start"].alias("start"), p["end"].alias("end"), x["m"].alias("m"))))
    nothing = F.array().cast("array<struct<start:int,end:int,m:string>>")
    return F.when(F.regexp_like(text, F.lit(NEEDS.get(kind, pattern))), F.filter(placed, lambda x: x["m"].isNotNull())).otherwise(nothing)


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]+", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn checksum."""
    back = F.reverse(digits)

    def value(i: Column) -> Column:
        d = F.substr(back, i, F.lit(1)).cast("int")
        twice = 2 * d
        return F.when(i % 2 == 1, d).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, x: a + x) % 10 == 0


def mod97(m: Column) -> Column:
    """Whether an IBAN leaves 1 modulo 97."""
    s = F.replace(m, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(s, F.lit(5)), F.substr(s, F.lit(1), F.lit(4)))

    def step(a: Column, i: Column) -> Column:
        code = F.ascii(F.substr(turned, i, F.lit(1)))
        return F.when(code <= 57, (a * 10 + code - 48) % 97).otherwise((a * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def confirmed(m: Column, kind: str) -> Column:
    if kind == "ip":
        return F.forall(F.split(m, r"\."), lambda p: F.regexp_like(p, F.lit("^0*+(25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})?$")))
    if kind == "card":
        return F.when(F.length(_digits(m)).between(16, 19), luhn(_digits(m))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(m)).between(8, 15)
    if kind == "iban":
        return mod97(m)
    return F.lit(True)


def _percent(blocks: Column, x: Column, kind: str) -> Column:
    """The score of a span in percent; blocks: the text in blocks of BLOCK characters."""
    score, more, words = SCORES[kind]

    def cut(from_: Column, n: Column) -> Column:
        first = F.floor(from_ / BLOCK).cast("int")
        return F.substr(F.concat(F.get(blocks, first), F.coalesce(F.get(blocks, first + 1), F.lit(""))), from_ % BLOCK + 1, n)

    from_ = F.greatest(x["start"] - CONTEXT_CHARS, F.lit(0))
    near = F.translate(F.concat_ws(" ", cut(from_, x["start"] - from_), cut(x["end"], F.lit(CONTEXT_CHARS))), UPPER, LOWER)
    return F.lit(score) + F.when(F.regexp_like(near, F.lit(f"(?:^|[^a-z0-9_])(?:{words})")), F.lit(more)).otherwise(F.lit(0))


def with_spans(docs: DataFrame, text_col: str = "text", out: str = "pii") -> DataFrame:
    """docs with column out: array<struct<kind, start, end, percent, score>>, by kind as listed, then start."""
    prefix = fresh(docs, f"__{out}_")
    names = {kind: prefix + kind for kind in PATTERNS}
    text = F.coalesce(F.col(quoted(text_col)), F.lit(""))
    step = docs.withColumns({name: matches(text, kind) for kind, name in names.items()})

    def spans(blocks: Column) -> Column:
        def of(kind: str) -> Column:
            def span(x: Column) -> Column:
                return _let(_percent(blocks, x, kind), lambda p: F.struct(F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end"), p.alias("percent"), (p / 100).alias("score")))

            made = F.transform(F.filter(F.col(names[kind]), lambda x: confirmed(x["m"], kind)), span)
            return made if kind in BASE else F.filter(made, lambda s: s["percent"] >= 100 * MIN_SCORE)

        return F.concat(*map(of, PATTERNS))

    some = F.size(F.concat(*(F.col(n) for n in names.values()))) > 0
    blocks = F.when(some, F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}"), F.lit(0))).otherwise(F.array().cast("array<string>"))
    return step.withColumn(out, _let(blocks, spans)).drop(*names.values())


def digest(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def detect(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: counts by kind, the digest of the base spans, all spans, and their scores in percent."""
    found = with_spans(docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text")), "text", "pii").select("doc_id", "pii")
    pii = F.col("pii")
    count = lambda kind: F.size(F.filter(pii, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter(pii, lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *map(count, BASE), F.sha2(digest(base), 256).alias("base_sha256"), digest(pii).alias("spans"), F.array_join(F.transform(pii, lambda s: s["percent"].cast("string")), ",").alias("scores"), *(count(k) for k in PATTERNS if k not in BASE))


def _sql() -> str:
    """The same in DuckDB's SQL, with the plain patterns (its engine is linear)."""
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+",
        "card": r"[0-9](?:[\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
        "iban": r"\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
        "ssn": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
    }
    digits = "regexp_replace(m, '[^0-9]+', '', 'g')"
    fine = {
        "email": "true",
        "ip": "len(list_filter(string_split(m, '.'), lambda p: TRY_CAST(p AS HUGEINT) <= 255)) = 4",
        "card": f"len({digits}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, len({digits}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse({digits})[i] AS INT) "
        f"ELSE (2 * CAST(reverse({digits})[i] AS INT)) // 10 + (2 * CAST(reverse({digits})[i] AS INT)) % 10 END)) % 10 = 0",
        "phone": f"len({digits}) BETWEEN 8 AND 15",
        "iban": "CAST(array_to_string(list_transform(string_split(substr(replace(m, ' ', ''), 5) || substr(replace(m, ' ', ''), 1, 4), ''), "
        "lambda c: CASE WHEN c BETWEEN '0' AND '9' THEN c ELSE CAST(ascii(c) - 55 AS VARCHAR) END), '') AS DECIMAL(38, 0)) % 97 = 1",
        "ssn": f"p >= {100 * MIN_SCORE}",
    }
    near = f"translate(substr(text, greatest(s - {CONTEXT_CHARS}, 0) + 1, s - greatest(s - {CONTEXT_CHARS}, 0)) || ' ' || substr(text, s + len(m) + 1, {CONTEXT_CHARS}), '{UPPER}', '{LOWER}')"
    parts = []
    for at, (kind, pattern) in enumerate(plain.items()):
        score, more, words = SCORES[kind]
        parts.append(
            f"SELECT doc_id, {at} AS k, '{kind}' AS kind, s, e, p FROM (SELECT doc_id, text, m, s, s + len(m) AS e, CASE WHEN regexp_matches({near}, '(?:^|[^a-z0-9_])(?:{words})') THEN {score + more} ELSE {score} END AS p FROM (SELECT doc_id, text, ms[i] AS m, CAST("
            f"list_sum(list_transform(ps[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS s FROM (SELECT doc_id, text, ms, ps, unnest(range(1, len(ms) + 1)) AS i "
            f"FROM (SELECT doc_id, text, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS ps FROM documents WHERE text IS NOT NULL)))) WHERE {fine[kind]}"
        )
    text = "string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY k, s)"
    count = lambda kind: f"count(*) FILTER (kind = '{kind}') AS n_{kind}"
    return (
        f"SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in plain)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(scores, '') AS scores FROM documents d LEFT JOIN "
        f"(SELECT doc_id, {', '.join(map(count, plain))}, {text} FILTER (k < 4) AS base, {text} AS spans, string_agg(CAST(p AS VARCHAR), ',' ORDER BY k, s) AS scores FROM ({' UNION ALL '.join(parts)}) GROUP BY doc_id) f USING (doc_id)"
    )


SQL = _sql()
