r"""Secret scans with corpus-wide ownership frequency (operator 9).

Patterns propose candidates in every text. A hash of each candidate's value is then
aggregated over the whole corpus by distinct repositories and owners: a value that SHARED
or more of either hold is a widely copied example; any other looks like a live credential
of its owner. Texts never leave the scan: only spans and hashes are shuffled, candidates
are pre-aggregated by (hash, repository, owner), and no value reaches the driver. The
frequencies are written before they are joined back, so that Spark can split the uses of
a value that is copied very often.

Where owner_col is not given, the repository is the owner too, and both counts are equal:
documents has one such column, source, so op9's query has this one dimension.

Defined results: a null or empty text has no spans; a null repository or owner counts as
one of its own; a repeated row is judged like its copy and adds no repository; an empty
table gives an empty result; other columns are left alone.
"""

import hashlib
import re

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import bound_batches, fresh, materialize, numbered, own_columns, quoted, scope
from .textbytes import releasing

SHARED = 3
#: kind: (pattern, group that holds the value, least length of the value), in the order of ties
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    "access": (r"AKIA[A-Z0-9]+", 0, 18),
    "hex": (r"[0-9a-f]{16,}", 0, 16),
    "jwt": (r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40),
    "github": (r"gh[opsu]_[A-Za-z0-9]+", 0, 40),
}
BASE = ("assign", "access", "hex")
_COMPILED = {k: (re.compile(p, re.ASCII), g, n) for k, (p, g, n) in KINDS.items()}
#: A text without any of these has no candidate.
GATE = r"(?i:password|passwd|secret|token|api_?key)|AKIA|[0-9a-f]{16}|eyJ|gh[opsu]_"
SPANS = "array<struct<kind:string,start:int,end:int,hash:string>>"


def find(text: str) -> list[dict]:
    """Spans of one text by start, then kind as listed."""
    out = []
    for at, (kind, (pattern, group, least)) in enumerate(_COMPILED.items()):
        for m in pattern.finditer(text):
            value = m.group(group)
            if len(value) >= least:
                out.append((m.start(), at, {"kind": kind, "start": m.start(), "end": m.end(), "hash": hashlib.blake2b(value.encode(), digest_size=16).hexdigest()}))
    return [x for *_, x in sorted(out, key=lambda x: x[:2])]


_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("hash", pa.string())]))


def with_spans(docs: DataFrame, text_col: str, keep: list[str], out: str) -> DataFrame:
    """The columns keep of docs and its candidates."""
    bound_batches(docs.sparkSession)
    columns = [F.col(quoted(c)) for c in keep]
    schema = docs.select(*columns).withColumn(out, F.lit(None).cast(SPANS)).schema

    def scan(batches):
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            flagged = pc.fill_null(pc.match_substring_regex(text, GATE), False).to_pylist()
            found = [find(text[i].as_py()) if hit else [] for i, hit in enumerate(flagged)]
            arrays = [batch.column(i) for i in range(len(keep))] + [pa.array(found, _TYPE)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, out])

    return numbered(docs.select(*columns, F.col(quoted(text_col)))).mapInArrow(releasing(scan), schema)


def ownership(found: DataFrame, repo: str, owner: str, spans: str) -> DataFrame:
    """hash, n_repos, n_owners, n_uses and shared: the corpus-wide frequency of each candidate."""
    held = found.select(F.explode(spans).alias("s"), F.col(quoted(repo)).alias("repo"), F.col(quoted(owner)).alias("owner")).select("s.hash", "repo", "owner")
    once = held.groupBy("hash", "repo", "owner").agg(F.count(F.lit(1)).alias("uses"))
    distinct = lambda c: F.countDistinct(F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("")))  # noqa: E731  a null is one of its own
    stats = once.groupBy("hash").agg(distinct("repo").alias("n_repos"), distinct("owner").alias("n_owners"), F.sum("uses").alias("n_uses"))
    return stats.withColumn("shared", (F.col("n_repos") >= SHARED) | (F.col("n_owners") >= SHARED))


def _verdicts(found: DataFrame, repo: str, owner: str, row: str, spans: str) -> DataFrame:
    """row, live (array of the spans that look live, by start), n_live, n_shared of the rows with a candidate."""
    shared = materialize(ownership(found, repo, owner, spans).select("hash", "shared"))
    uses = found.select(F.col(row).alias("row"), F.explode(spans).alias("s")).select("row", "s.*")
    span = F.struct("start", "end")
    return uses.join(shared, "hash").groupBy("row").agg(
        F.array_sort(F.collect_list(F.when(~F.col("shared"), span))).alias("live"),
        F.count_if(~F.col("shared")).alias("n_live"),
        F.count_if(F.col("shared")).alias("n_shared"),
    )


def _digest(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repo_col: str = "source", owner_col: str | None = None) -> DataFrame:
    """One row per row of docs: counts by kind, digest of the base spans, all spans, n_live and n_shared."""
    named = ((id_col, "doc_id"), (text_col, "text"), (repo_col, "repo"), (owner_col or repo_col, "owner"))
    narrow = docs.select(*(F.col(quoted(c)).alias(n) for c, n in named), F.monotonically_increasing_id().alias("row"))
    with scope(docs.sparkSession):
        found = materialize(with_spans(narrow, "text", ["row", "doc_id", "repo", "owner"], "spans"))
        return materialize(_scanned(found), keep=True)


def _scanned(found: DataFrame) -> DataFrame:
    verdicts = _verdicts(found, "repo", "owner", "row", "spans")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    return found.join(verdicts, "row", "left").select("doc_id", *map(count, BASE), F.sha2(_digest(base), 256).alias("base_sha256"), _digest(F.col("spans")).alias("spans"), zero("n_live"), zero("n_shared"))


def masked(text: str, live: list[dict], mask: str) -> str:
    """text with mask for each stretch that spans (by start) cover; those that overlap share one."""
    out, at = [], 0
    for s in live:
        if s["start"] >= at:
            out += [text[at : s["start"]], mask]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, text_col: str = "text", repo_col: str = "source", owner_col: str | None = None, mask: str = "[SECRET]") -> DataFrame:
    """docs with each live-looking secret replaced by mask; examples stay. Only texts with a candidate are shuffled."""
    out = fresh(docs, "__s_")
    row, spans = f"{out}row", f"{out}spans"
    found = materialize(with_spans(docs.withColumn(row, F.monotonically_increasing_id()), text_col, [*docs.columns, row], spans))
    verdicts = _verdicts(found, repo_col, owner_col or repo_col, row, spans).select(F.col("row").alias(row), F.col("live").alias(f"{out}live"))
    names, at = docs.columns, docs.columns.index(text_col)
    n = len(names)

    def cut(batches):
        for batch in batches:
            texts = [masked(t, live, mask) if live else t for t, live in zip(batch.column(at).to_pylist(), batch.column(n).to_pylist(), strict=True)]
            columns = batch.columns[:n]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    hit = numbered(found.filter(F.size(spans) > 0).join(verdicts, row).select(*own_columns(docs), f"{out}live")).mapInArrow(releasing(cut), docs.schema)
    return found.filter(F.size(spans) == 0).select(*own_columns(docs)).union(hit)


def _sql() -> str:
    word = lambda w: "".join(f"[{c}{c.upper()}]" for c in w)
    keys = "|".join([word("password"), word("passwd"), word("secret"), word("token"), word("api") + "_?" + word("key")])
    plain = {k: p for k, (p, _, _) in KINDS.items()} | {"assign": rf"""({keys})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""}
    parts = []
    for at, (kind, (_, group, least)) in enumerate(KINDS.items()):
        p = plain[kind]
        parts.append(
            f"SELECT doc_id, source, {at} AS k, '{kind}' AS kind, s, s + len(m) AS e, v FROM (SELECT doc_id, source, ms[i] AS m, vs[i] AS v, CAST(list_sum(list_transform(ps[1:i], lambda x: len(x))) + "
            f"coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: len(x))), 0) AS BIGINT) AS s FROM (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM (SELECT doc_id, source, regexp_extract_all(text, '{p}') AS ms, "
            f"regexp_extract_all(text, '{p}', {group}) AS vs, string_split_regex(text, '{p}') AS ps FROM documents WHERE text IS NOT NULL))) WHERE len(v) >= {least}"
        )
    text = "string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k)"
    return (
        f"WITH c AS ({' UNION ALL '.join(parts)}), h AS (SELECT v, count(DISTINCT coalesce('=' || source, '')) >= {SHARED} AS shared FROM c GROUP BY v), "
        f"f AS (SELECT doc_id, {', '.join(f'count(*) FILTER (kind = {k!r}) AS n_{k}' for k in BASE)}, {text} FILTER (k < 3) AS base, {text} AS spans, count(*) FILTER (NOT shared) AS n_live, "
        f"count(*) FILTER (shared) AS n_shared FROM c JOIN h USING (v) GROUP BY doc_id) "
        f"SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in BASE)}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_shared, 0) AS n_shared "
        f"FROM documents d LEFT JOIN f USING (doc_id)"
    )


SQL = _sql()
