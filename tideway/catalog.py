"""The registered queries of extract and load, and their SQL."""

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .functions import pgtext
from .functions.schema import describe, normalize
from .operators import deliver, jdbc, load
from .plans.flow import Flow
from .sinks import files
from .sources import copytext, scan, stream
from .sources.incremental import Incremental, StateTable
from .storage import Files, arrow_at, local_mode, scratch
from .streaming.staged import append_stream, merge_stream, stream_id

BOUND = "2024-01-15 00:00:00"
LATE = "2024-01-20 12:00:00"
#: The last event time up to BOUND: a bound that is in the table, so that > and >= differ.
_HIT = f"(SELECT max(ts) FROM events WHERE ts <= TIMESTAMP '{BOUND}')"
QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Scans and sources

_SCAN = "SELECT n_name, count(*) AS customers, sum(c_custkey) AS keys FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"


@query(_SCAN)
def scan_query(spark, sf_dir):
    scan.register(spark, sf_dir, "customer", "nation")
    return scan.query(spark, _SCAN)


def _database(spark, name: str) -> dict:
    """The database that the session's spark.tideway.jdbc.url and .driver name; else an embedded one, which one JVM alone can use."""
    url = spark.conf.get("spark.tideway.jdbc.url", None)
    if url:
        return {"url": url, "driver": spark.conf.get("spark.tideway.jdbc.driver")}
    if not local_mode(spark):
        raise ValueError("on a cluster spark.tideway.jdbc.url must name a database server")
    spark._jvm.java.lang.System.setProperty("derby.stream.error.field", "java.lang.System.err")
    return {"url": f"jdbc:derby:memory:{name};create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def _database_table(spark, df: DataFrame) -> tuple[dict, str]:
    options, name = _database(spark, "tideway"), f"t_{scratch(spark).rpartition('-')[2]}"
    df.write.format("jdbc").options(**options).option("dbtable", name).mode("error").save()
    return options, name


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_custkey % 3 = 0")
def scan_partitioned(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    options, name = _database_table(spark, rows)
    top = rows.agg(F.max("o_orderkey")).first()[0]
    sql = f'SELECT "o_orderkey", "o_custkey", "o_orderstatus" FROM {name} WHERE MOD("o_custkey", 3) = 0'
    return scan.jdbc_query(spark, options, sql, partition=('"o_orderkey"', 0, int(top) + 1, 4))


@query("SELECT o_orderkey, CAST(o_orderkey AS BIGINT) * o_orderkey * o_orderkey AS cube, true AS even FROM orders")
def scan_skewed(spark, sf_dir):
    """A key with most of its rows in a small part of its range, read over eight connections; even: none of them takes more than a quarter."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey").cast("long") * F.col("o_orderkey") * F.col("o_orderkey")).alias("cube"))
    options, name = _database_table(spark, rows)
    read = scan.jdbc_query(spark, options, f"SELECT * FROM {name}", partition=('"cube"', 8))
    sizes = read.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count").alias("most"), F.sum("count").alias("n"))
    return read.crossJoin(F.broadcast(sizes)).select("o_orderkey", "cube", (4 * F.col("most") <= F.col("n")).alias("even"))


_EVENTS = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string", "value": "double", "props": "string"}


@query(" UNION ALL ".join(f"SELECT {i} AS position, '{n}' AS name, '{t}' AS type, true AS nullable, count({n}) AS n_values FROM events" for i, (n, t) in enumerate(_EVENTS.items())))
def schema_of(spark, sf_dir):
    """The fields of a table, each with its number of values."""
    events = table(spark, sf_dir, "events")
    values = events.select(F.explode(F.map_from_arrays(F.array(*map(F.lit, events.columns)), F.array(*(F.col(c).isNotNull().cast("long") for c in events.columns)))).alias("name", "there"))
    return describe(events).join(values.groupBy("name").agg(F.sum("there").alias("n_values")), "name")


@query("SELECT CAST(p_partkey AS BIGINT) AS p_partkey, CAST(p_size AS INTEGER) AS p_size, CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS VARCHAR) AS price, p_name FROM part")
def normalize_types(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    narrow = part.select("p_partkey", F.col("p_size").cast("smallint").alias("p_size"), F.col("p_retailprice").cast("decimal(12,2)").alias("price"), "p_name")
    return normalize(narrow)


# Incremental scans


@query("SELECT * FROM events")
def incremental_first_run(spark, sf_dir):
    return Incremental("ts").apply(table(spark, sf_dir, "events"))


@query(f"SELECT * FROM events WHERE ts > TIMESTAMP '{LATE}'")
def incremental_resume(spark, sf_dir):
    return Incremental("ts", initial=BOUND).apply(table(spark, sf_dir, "events"), LATE)


def _hit(events: DataFrame) -> str:
    return events.filter(F.col("ts") <= F.lit(BOUND).cast("timestamp_ntz")).agg(F.max("ts").cast("string")).first()[0]


@query(f"SELECT * FROM events WHERE ts > {_HIT}")
def incremental_initial_value(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return Incremental("ts", initial=_hit(events)).apply(events)


@query(f"SELECT * FROM events WHERE ts >= {_HIT}")
def incremental_inclusive(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return Incremental("ts", initial=_hit(events), inclusive=True).apply(events)


@query(f"SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '{LATE}' ORDER BY ts")
def incremental_ordered(spark, sf_dir):
    return Incremental("ts", initial=LATE, ordered=True).apply(table(spark, sf_dir, "events").select("event_id", "ts"))


@query(f"SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS watermark, count(*) AS n FROM events WHERE ts > TIMESTAMP '{BOUND}'")
def watermark_after_run(spark, sf_dir):
    state = scratch(spark, "state")
    flow = Flow(lambda s: table(s, sf_dir, "events"), "none", incremental=Incremental("ts", initial=BOUND), state=state, name="events")
    report = flow.run(spark)
    stored = StateTable(spark, state).read("events")
    return spark.createDataFrame([(str(stored), report.rows)], "watermark string, n long").select(F.date_format(F.col("watermark").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("watermark"), "n")


@query("SELECT * FROM events")
def watermark_chain(spark, sf_dir):
    """Two runs over a growing source cover every row once."""
    state, out = scratch(spark, "state"), scratch(spark, "table")
    for upto in (BOUND, "2999-01-01"):
        Flow(lambda s, u=upto: table(s, sf_dir, "events").filter(F.col("ts") <= F.lit(u).cast("timestamp_ntz")), "append", {"path": out}, Incremental("ts"), state, "events").run(spark)
    return load.FileTable(spark, out).read()


@query("SELECT * FROM events")
def incremental_stream(spark, sf_dir):
    """The incremental scan as a stream: two runs over a growing folder append every row once."""
    events, folder, checkpoint = table(spark, sf_dir, "events"), scratch(spark, "grown"), scratch(spark, "stream")
    t = load.FileTable(spark, scratch(spark, "table"))
    late = F.col("ts") > F.lit(LATE).cast("timestamp_ntz")
    for part in (~late, late):
        events.filter(part).write.mode("append").parquet(folder)
        append_stream(spark, stream.stream(spark, folder, "ts"), t, checkpoint)
    return t.read()


@query("SELECT event_id, epoch_us(ts) AS micros FROM events")
def watermark_zones(spark, sf_dir):
    """Three runs over a growing source with an instant as cursor, each in a session of another time zone, cover every row once."""
    state, out, before = scratch(spark, "state"), scratch(spark, "table"), spark.conf.get("spark.sql.session.timeZone")
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    try:
        for zone, upto in (("UTC", BOUND), ("America/Los_Angeles", LATE), ("Asia/Tokyo", "2999-01-01")):
            spark.conf.set("spark.sql.session.timeZone", zone)
            grown = lambda s, u=upto: table(s, sf_dir, "events").filter(F.col("ts") <= F.lit(u).cast("timestamp_ntz")).select("event_id", F.timestamp_micros(micros).alias("at"))
            Flow(grown, "append", {"path": out}, Incremental("at"), state, "events").run(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    return load.FileTable(spark, out).read().select("event_id", F.unix_micros("at").alias("micros"))


@query("SELECT event_id, epoch_us(ts) AS micros FROM events")
def encode_instants(spark, sf_dir):
    """Instants as COPY text, written in a session of one time zone and read in one of another."""
    path, before = scratch(spark, "copy"), spark.conf.get("spark.sql.session.timeZone")
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    instants = table(spark, sf_dir, "events").select("event_id", F.timestamp_micros(micros).alias("at"))
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        copytext.write(instants, path)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    return copytext.read(spark, path, instants.schema).select("event_id", F.unix_micros("at").alias("micros"))


# Sinks


@query("SELECT * FROM part")
def jsonl_roundtrip(spark, sf_dir):
    part, path = table(spark, sf_dir, "part"), scratch(spark, "jsonl")
    files.write_jsonl(part, path)
    return spark.read.schema(part.schema).json(path)


def _folder(spark) -> str:
    path = scratch(spark, "out")
    Files(spark).mkdirs(path)
    return path


@query("SELECT * FROM lineitem")
def parquet_single(spark, sf_dir):
    df, folder = table(spark, sf_dir, "lineitem"), _folder(spark)
    files.write_parquet(df, folder, "lineitem", single=True)
    return spark.read.parquet(f"{folder}/lineitem.snappy.parquet")


@query("SELECT * FROM lineitem")
def parquet_parts(spark, sf_dir):
    """Every partition a part, six at least: read back as the folder that they are in."""
    df, folder = table(spark, sf_dir, "lineitem"), _folder(spark)
    files.write_parquet(df.repartition(max(6, df.rdd.getNumPartitions())), folder, "lineitem", "zstd")
    return spark.read.parquet(folder)


@query("SELECT *, false AS over FROM lineitem")
def parquet_chunked(spark, sf_dir):
    """Every row, and whether its chunk is over the cap."""
    df, folder = table(spark, sf_dir, "lineitem"), _folder(spark)
    _, made = files.write_parquet(df, folder, "lineitem", "zstd", "256KiB")
    return spark.read.parquet(*made).withColumn("over", F.col("_metadata.file_size") > files.parse_size("256KiB"))


@query("SELECT *, false AS over FROM documents")
def parquet_chunks_early(spark, sf_dir):
    """All that is in a folder after a write of early chunks that failed half-way, and one that did not."""
    docs, folder = table(spark, sf_dir, "documents"), _folder(spark)
    ordered = docs.repartitionByRange("n_chars").sortWithinPartitions("n_chars")
    longest = docs.agg(F.max("n_chars")).first()[0]
    broken = ordered.withColumn("text", F.when(F.col("n_chars") >= longest, F.raise_error(F.lit("stopped at the longest text")).cast("string")).otherwise(F.col("text")))
    for frame in (broken, ordered):  # the first write fails in its last task, and takes back what others have handed over
        try:
            files.write_parquet(frame, folder, "documents", "gzip", "256KiB", early=True)
        except Exception:
            if frame is ordered:
                raise
    handed = files.handed_over(spark, folder).select(F.col("name").alias("__name"))
    there = spark.read.parquet(folder).withColumn("over", F.col("_metadata.file_size") > files.parse_size("256KiB")).withColumn("__name", F.col("_metadata.file_name"))
    return there.join(F.broadcast(handed), "__name", "left").drop("__name")


@query(" UNION ALL ".join(f"SELECT '{c}' AS codec, count(*) AS n, sum(o_orderkey) AS keys FROM orders" for c in files.CODECS))
def parquet_codecs(spark, sf_dir):
    df, out = table(spark, sf_dir, "orders"), None
    for codec in files.CODECS:
        folder = _folder(spark)
        _, made = files.write_parquet(df, folder, "orders", codec)
        one = spark.read.parquet(*made).agg(F.lit(codec).alias("codec"), F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))
        out = one if out is None else out.union(one)
    return out


@query("SELECT count(*) AS n FROM lineitem")
def noop_count(spark, sf_dir):
    return spark.createDataFrame([(files.write_none(table(spark, sf_dir, "lineitem")),)], "n long")


@query(f"SELECT count(*) AS n, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS watermark FROM events WHERE ts > TIMESTAMP '{LATE}'")
def run_report(spark, sf_dir):
    flow = Flow(lambda s: table(s, sf_dir, "events"), "parquet", {"folder": _folder(spark), "prefix": "events", "max_file_size": "64KiB"}, Incremental("ts", initial=LATE))
    report = flow.run(spark)
    return spark.createDataFrame([(report.rows, report.watermark)], "n long, watermark string").withColumn("watermark", F.date_format(F.col("watermark").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss.SSSSSS"))


_ESCAPED = r"replace(replace(replace(replace({}, '\', '\\'), chr(9), '\t'), chr(10), '\n'), chr(13), '\r')"


@query(rf"SELECT concat_ws(chr(9), CAST(doc_id AS VARCHAR), coalesce({_ESCAPED.format('text')}, '\N'), coalesce(lang, '\N'), CASE WHEN n_chars > 1000 THEN 't' ELSE 'f' END) AS line FROM documents")
def copy_text_render(spark, sf_dir):
    return copytext.render(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", (F.col("n_chars") > 1000).alias("long")))




@query(r"SELECT doc_id, concat(text, chr(9), '\', chr(13), chr(10), '\N') AS text, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE lang END AS lang, n_chars FROM documents")
def copy_text_roundtrip(spark, sf_dir):
    """Texts with every character that the format escapes, written and read back."""
    docs, path = table(spark, sf_dir, "documents"), scratch(spark, "copy")
    odd = docs.select("doc_id", F.concat("text", F.lit("\t\\\r\n\\N")).alias("text"), F.when(F.col("doc_id") % 7 != 0, F.col("lang")).alias("lang"), "n_chars")
    copytext.write(odd, path)
    return copytext.read(spark, path, odd.schema)


# Loads


def _target(spark, df: DataFrame) -> load.FileTable:
    t = load.FileTable(spark, scratch(spark, "table")).create(df.schema)
    t.append(df)
    return t


@query("SELECT * FROM orders UNION ALL SELECT * FROM orders WHERE o_orderkey % 10 = 0")
def atomic_append(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    t = _target(spark, orders)
    t.append(orders.filter("o_orderkey % 10 = 0"))
    return t.read()


@query("SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 10 = 0")
def atomic_append_jdbc(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    options, name = _database_table(spark, orders)
    jdbc.append(orders.filter("o_orderkey % 10 = 0"), options, name)
    return scan.jdbc_query(spark, options, f"SELECT * FROM {name}")


def _changes(orders: DataFrame) -> DataFrame:
    """A third of the orders with a new status, and as many new ones."""
    own = orders.filter("o_orderkey % 3 = 0")
    return own.withColumn("o_orderstatus", F.lit("X")).unionByName(own.withColumn("o_orderkey", -F.col("o_orderkey") - 1))


_STAGED = "SELECT * REPLACE ('X' AS o_orderstatus) FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT * REPLACE (-o_orderkey - 1 AS o_orderkey) FROM orders WHERE o_orderkey % 3 = 0"
_MERGED = f"WITH s AS ({_STAGED}) SELECT * FROM s UNION ALL SELECT * FROM orders t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)"


@query(_MERGED)
def merge_update_insert(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    t = _target(spark, orders)
    t.merge(_changes(orders), ["o_orderkey"])
    return t.read()


@query(_MERGED)
def merge_idempotent(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    t = _target(spark, orders)
    for _ in range(2):
        t.merge(_changes(orders), ["o_orderkey"])
    return t.read()


@query("SELECT * FROM nation UNION ALL SELECT n_nationkey + 100, n_name, n_regionkey FROM nation WHERE n_regionkey = 1")
def merge_all_keys(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    staged = nation.filter("n_regionkey = 1")
    staged = staged.unionByName(staged.withColumn("n_nationkey", F.col("n_nationkey") + 100))
    t = _target(spark, nation)
    t.merge(staged, nation.columns)
    return t.read()


@query(
    "WITH s AS (SELECT doc_id, 1 - toxic AS toxic FROM labels WHERE doc_id % 2 = 0 UNION ALL SELECT -doc_id - 1, toxic FROM labels WHERE doc_id % 5 = 0) "
    "SELECT coalesce(t.doc_id, s.doc_id) AS doc_id, t.quality, CASE WHEN s.doc_id IS NULL THEN t.toxic ELSE s.toxic END AS toxic FROM labels t FULL JOIN s ON t.doc_id = s.doc_id"
)
def merge_partial_columns(spark, sf_dir):
    """Staged rows without quality: matches keep theirs, new rows have none."""
    labels = table(spark, sf_dir, "labels")
    staged = labels.filter("doc_id % 2 = 0").select("doc_id", (1 - F.col("toxic")).alias("toxic"))
    staged = staged.unionByName(labels.filter("doc_id % 5 = 0").select((-F.col("doc_id") - 1).alias("doc_id"), "toxic"))
    t = _target(spark, labels)
    t.merge(staged, ["doc_id"])
    return t.read()


@query("SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS k FROM events) WHERE k = 1")
def merge_latest(spark, sf_dir):
    """The last event of every user, merged into a table of first events."""
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    t = _target(spark, events.groupBy("user_id").agg(F.min("event_id").alias("event_id"), F.min("ts").alias("ts")))
    t.merge(events, ["user_id"], on_duplicate="latest", order="ts")
    return t.read()


@query(f"SELECT o_orderkey, o_orderstatus FROM ({_MERGED})")
def merge_jdbc(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    options, name = _database_table(spark, orders)
    jdbc.execute(orders, options, f'CREATE INDEX i_{name} ON {name} ("o_orderkey")')
    jdbc.merge(_changes(orders), options, name, ["o_orderkey"])
    return scan.jdbc_query(spark, options, f"SELECT * FROM {name}")


@query("SELECT * REPLACE (CASE WHEN o_orderkey % 1000 = 7 THEN 'X' ELSE o_orderstatus END AS o_orderstatus), true AS few FROM orders")
def merge_scattered(spark, sf_dir):
    """A few keys all over a table of many files; few: no more files than keys were written anew."""
    orders, before = table(spark, sf_dir, "orders"), spark.conf.get("spark.sql.files.maxRecordsPerFile")
    t = load.FileTable(spark, scratch(spark, "table")).create(orders.schema, ["o_orderkey"])
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "50")
    try:
        t.append(orders)
    finally:
        spark.conf.set("spark.sql.files.maxRecordsPerFile", before)
    staged = orders.filter("o_orderkey % 1000 = 7").withColumn("o_orderstatus", F.lit("X"))
    t.merge(staged, ["o_orderkey"])
    few = sum(map(len, t.state()["gone"].values())) <= staged.count()
    return t.read().withColumn("few", F.lit(few))


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def stream_append(spark, sf_dir):
    """Two runs of a stream over a growing folder, of whose batches the first is run again, append every row once."""
    orders, staging, checkpoint = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), scratch(spark, "staging"), scratch(spark, "stream")
    t = load.FileTable(spark, scratch(spark, "table"))
    for part in (0, 1):
        grown = orders.filter(F.pmod("o_orderkey", F.lit(2)) == part)
        grown.write.mode("append").parquet(staging)
        append_stream(spark, spark.readStream.schema(orders.schema).parquet(staging), t, checkpoint)
        t.append(grown, batch=(stream_id(spark, checkpoint), part))
    return t.read()


@query(_MERGED)
def stream_merge(spark, sf_dir):
    orders, staging = table(spark, sf_dir, "orders"), scratch(spark, "staging")
    t, checkpoint = _target(spark, orders), scratch(spark, "stream")
    changes = _changes(orders)
    for part in (0, 1):
        changes.filter(F.pmod("o_orderkey", F.lit(2)) == part).write.mode("append").parquet(staging)
        merge_stream(spark, staging, orders.schema, t, ["o_orderkey"], checkpoint)
    return t.read()


# Delivery


def _staged_files(spark, sf_dir) -> str:
    folder = _folder(spark)
    for name in ("region", "nation", "supplier", "part", "customer"):
        files.write_parquet(table(spark, sf_dir, name), folder, name, single=True)
    return folder


_TABLES = ("customer", "nation", "part", "region", "supplier")
_NAMES = " UNION ALL ".join(f"SELECT '{t}.snappy.parquet' AS file_name, count(*) AS n, true AS whole FROM {t}" for t in _TABLES)


def _rows_of(spark, listed: DataFrame, folder: str) -> DataFrame:
    """file_name, its rows in folder, and whether as many bytes can be read there as are listed."""
    read = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    there = read.select(F.element_at(F.split("path", "/"), -1).alias("file_name"), F.octet_length("content").cast("long").alias("there"))
    name = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file_name")
    counts = None
    for t in _TABLES:  # files of different schemas
        one = spark.read.parquet(f"{folder}/{t}.snappy.parquet").select(name).groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
        counts = one if counts is None else counts.union(one)
    return listed.join(there, "file_name").join(counts, "file_name").select("file_name", "n", (F.col("length") == F.col("there")).alias("whole"))


@query(_NAMES)
def manifest_rows(spark, sf_dir):
    folder = _staged_files(spark, sf_dir)
    return _rows_of(spark, deliver.manifest(spark, folder, "*.parquet"), folder)


@query(_NAMES)
def deliver_pending(spark, sf_dir):
    staged, folder, ledger = _staged_files(spark, sf_dir), _folder(spark), scratch(spark, "ledger")
    listed = deliver.manifest(spark, staged, "*.parquet")
    deliver.deliver(listed, folder, ledger)
    return _rows_of(spark, listed, folder)


@query("SELECT true AS broke, 1 AS resumed, 0 AS again, 6 AS copies, (SELECT count(*) FROM customer) AS customers")
def deliver_resume(spark, sf_dir):
    """A copy fails once: the next call copies that file alone, a third one nothing; copies are counted by marker files."""
    staged, folder, ledger, marks = _staged_files(spark, sf_dir), _folder(spark), scratch(spark, "ledger"), _folder(spark)
    marks = Files(spark).qualified(marks)

    def breaks(path, to, name):
        import uuid

        store, root = arrow_at(marks)
        first = not any(f.base_name.startswith(name) for f in store.get_file_info(fs.FileSelector(root)))
        store.open_output_stream(f"{root}/{name}.{uuid.uuid4().hex}").close()
        if first and name.startswith("part."):
            raise RuntimeError("stopped in the middle")
        deliver.copy_file(path, to, name)

    listed, broke = deliver.manifest(spark, staged, "*.parquet"), False
    try:
        deliver.deliver(listed, folder, ledger, breaks)
    except deliver.DeliveryError:
        broke = True
    resumed, again = deliver.deliver(listed, folder, ledger, breaks), deliver.deliver(listed, folder, ledger, breaks)
    copies = len([p for p, _ in Files(spark).list(marks)])
    n = spark.read.parquet(f"{folder}/customer.snappy.parquet").agg(F.count(F.lit(1)).alias("customers"))
    return n.select(F.lit(broke).alias("broke"), F.lit(resumed).alias("resumed"), F.lit(again).alias("again"), F.lit(copies).alias("copies"), "customers")


# Text forms


@query("SELECT event_id, user_id, value, value > 50 AS big, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def decode_scalars(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = e.select(F.col("event_id").cast("string").alias("a"), F.col("user_id").cast("string").alias("b"), F.col("value").cast("string").alias("c"), F.when(F.col("value") > 50, "t").otherwise("false").alias("d"), F.date_format("ts", "yyyy-MM-dd").alias("e"))
    return text.select(
        pgtext.decode(F.col("a"), T.LongType()).alias("event_id"), pgtext.decode(F.col("b"), T.LongType()).alias("user_id"), pgtext.decode(F.col("c"), T.DoubleType()).alias("value"),
        pgtext.decode(F.col("d"), T.BooleanType()).alias("big"), pgtext.decode(F.col("e"), T.DateType()).cast("string").alias("day"),
    )


@query("SELECT l_orderkey, count(*) AS n, sum(l_partkey) AS parts, min(l_linenumber) AS least FROM lineitem GROUP BY l_orderkey")
def decode_arrays(spark, sf_dir):
    text = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_list("l_partkey").alias("p"), F.collect_list("l_linenumber").alias("l"))
    text = text.select("l_orderkey", *(pgtext.encode(F.col(c), T.ArrayType(k)).alias(c) for c, k in (("p", T.LongType()), ("l", T.IntegerType()))))
    p, ln = pgtext.decode_array(F.col("p"), T.LongType()), pgtext.decode_array(F.col("l"), T.IntegerType())
    return text.select("l_orderkey", F.size(p).cast("long").alias("n"), F.aggregate(p, F.lit(0).cast("long"), lambda a, x: a + x).alias("parts"), F.array_min(ln).alias("least"))


@query("SELECT p_partkey, [p_name, NULL, 'NULL', concat('say \"', p_brand, '\" \\, {}'), CAST(p_size AS VARCHAR)] AS items, [p_size, NULL, -p_size] AS sizes FROM part")
def decode_array_text(spark, sf_dir):
    """Array text as a database or a person may write it: spaces around items, quotes where none are needed, escapes, the word NULL quoted and not."""
    quote = lambda c: F.concat(F.lit('"'), F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    odd, size = F.concat(F.lit('say "'), F.col("p_brand"), F.lit('" \\, {}')), F.col("p_size").cast("string")
    items = F.concat(F.lit("{ "), quote(F.col("p_name")), F.lit(' , null,"NULL",'), quote(odd), F.lit(",  "), size, F.lit(" }"))
    sizes = F.concat(F.lit("{"), size, F.lit(', NULL,"-'), size, F.lit('"}'))
    part = table(spark, sf_dir, "part").select("p_partkey", items.alias("items"), sizes.alias("sizes"))
    return part.select("p_partkey", pgtext.decode_array(F.col("items"), T.StringType()).alias("items"), pgtext.decode_array(F.col("sizes"), part_type(spark, sf_dir)).alias("sizes"))


def part_type(spark, sf_dir) -> T.DataType:
    return table(spark, sf_dir, "part").schema["p_size"].dataType


@query("SELECT p_partkey, p_name, p_brand, CASE WHEN p_size % 2 = 0 THEN NULL ELSE CAST(p_size AS VARCHAR) END AS size FROM part")
def decode_hstore(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    item = lambda c: F.concat(F.lit('"'), F.replace(F.replace(F.col(c), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
    text = F.concat(F.lit('"name"=>'), item("p_name"), F.lit(', "brand"=>'), item("p_brand"), F.lit(', "size"=>'), F.when(F.col("p_size") % 2 == 0, "NULL").otherwise(F.col("p_size").cast("string")))
    json = pgtext.decode_hstore(F.col("t"))
    get = lambda k: F.get_json_object("j", f"$.{k}")
    return part.select("p_partkey", text.alias("t")).select("p_partkey", json.alias("j")).select("p_partkey", get("name").alias("p_name"), get("brand").alias("p_brand"), get("size").alias("size"))


@query("SELECT page_id, html FROM pages")
def decode_bytea(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    text = pages.select("page_id", pgtext.encode(F.col("html").cast("binary"), T.BinaryType()).alias("h"))
    return text.select("page_id", pgtext.decode_bytea(F.col("h")).cast("string").alias("html"))


@query("SELECT event_id, ts, date_trunc('millisecond', ts) AS ms FROM events")
def decode_timestamps(spark, sf_dir):
    text = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("string").alias("t"))
    return text.select("event_id", pgtext.decode_timestamp(F.col("t")).alias("ts"), pgtext.decode_timestamp(F.col("t"), milliseconds=True).alias("ms"))


@query("SELECT * FROM events")
def decode_row(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    text = {f.name: pgtext.encode(F.col(f.name), f.dataType) for f in e.schema}
    return e.select(*(c.alias(k) for k, c in text.items())).select(*pgtext.decode_row({k: F.col(k) for k in text}, e.schema))


@query("SELECT CAST(p_partkey AS VARCHAR) AS key, CASE WHEN p_size > 25 THEN 't' ELSE 'f' END AS big, p_name AS name FROM part")
def encode_scalars(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(pgtext.encode(F.col("p_partkey"), T.LongType()).alias("key"), pgtext.encode(F.col("p_size") > 25, T.BooleanType()).alias("big"), pgtext.encode(F.col("p_name"), T.StringType()).alias("name"))


@query(r"SELECT page_id, concat('\x', lower(hex(encode(url)))) AS url FROM pages")
def encode_binary_hex(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", pgtext.encode(F.col("url").cast("binary"), T.BinaryType()).alias("url"))


# Flagship


@query(
    f"WITH s AS (SELECT * REPLACE (value + 1 AS value) FROM events WHERE ts > TIMESTAMP '{BOUND}') "
    f"SELECT * FROM s UNION ALL SELECT * FROM events t WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.event_id = t.event_id)"
)
def flagship(spark, sf_dir):
    """Events past a watermark, merged by key into a snapshot, written as chunked Parquet and read back."""
    events, path = table(spark, sf_dir, "events"), scratch(spark, "table")
    snapshot = load.FileTable(spark, path).create(events.schema)
    snapshot.append(events)
    changed = lambda s: table(s, sf_dir, "events").withColumn("value", F.col("value") + 1)
    Flow(changed, "merge", {"path": path, "keys": ["event_id"]}, Incremental("ts", initial=BOUND), scratch(spark, "state"), "events").run(spark)
    folder = _folder(spark)
    _, made = files.write_parquet(snapshot.read(), folder, "events", "zstd", "64KiB")
    return spark.read.parquet(*made)
