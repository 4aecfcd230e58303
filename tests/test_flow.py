import datetime as dt
import glob
import json
import os
import re
import subprocess
import sys
import time

import pytest
from pyspark.sql import functions as F

from tideway.functions.schema import describe
from tideway.operators import deliver, jdbc, load
from tideway.plans.flow import Flow
from tideway.sinks import files
from tideway.sources import scan, stream
from tideway.sources.incremental import Incremental, StateTable, Watermark, WatermarkError, as_state, from_state
from tideway.streaming.staged import append_stream, deliver_stream, merge_stream, stream_id

T0 = dt.datetime(2026, 6, 9, 8)


def events(spark, n=6):
    rows = [(i, T0 + dt.timedelta(hours=i)) for i in range(n)] + [(99, None)]
    return spark.createDataFrame(rows, "id bigint, updated_at timestamp_ntz")


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_bounds(spark):
    e = events(spark)
    assert ids(Incremental("updated_at").apply(e)) == [0, 1, 2, 3, 4, 5, 99]
    assert ids(Incremental("updated_at").apply(e, "2026-06-09 10:00:00")) == [3, 4, 5]
    assert ids(Incremental("updated_at", inclusive=True).apply(e, "2026-06-09 10:00:00")) == [2, 3, 4, 5]
    assert ids(Incremental("updated_at", initial="2000-01-01").apply(e, "2026-06-09 12:00:00")) == [5]
    ordered = [r[0] for r in Incremental("updated_at", ordered=True).apply(e.orderBy(F.desc("id"))).collect()]
    assert ordered == [0, 1, 2, 3, 4, 5, 99]
    odd = spark.createDataFrame([("o'brien",), ("zed",)], 'we"ird string'.replace('we"ird', "w")).withColumnRenamed("w", 'we"ird')
    assert [r[0] for r in Incremental('we"ird').apply(odd, "o'brien").collect()] == ["zed"]
    assert scan.identifier('we"ird') == '"we""ird"' and scan.literal("o'brien") == "'o''brien'"


def test_filter_is_pushed_down(spark, tmp_path):
    events(spark).write.parquet(str(tmp_path / "e"))
    plan = Incremental("updated_at", initial="2026-06-09").apply(spark.read.parquet(str(tmp_path / "e")))._jdf.queryExecution().toString()
    assert "GreaterThan(updated_at" in plan


def test_flow_resumes(spark, tmp_path):
    state, out = str(tmp_path / "s"), str(tmp_path / "t")
    flow = Flow(lambda s: events(s, 3), "append", {"path": out}, Incremental("updated_at"), state)
    assert (flow.run(spark).rows, StateTable(spark, state).read("flow")) == (4, Watermark("2026-06-09 10:00:00", "timestamp_ntz"))
    again = Flow(lambda s: events(s, 6), "append", {"path": out}, Incremental("updated_at"), state)
    assert again.run(spark).rows == 3
    idle = again.run(spark)
    assert (idle.rows, idle.watermark) == (0, "2026-06-09 13:00:00")
    assert ids(load.FileTable(spark, out).read()) == [0, 1, 2, 3, 4, 5, 99]


def test_watermarks_are_instants(spark, tmp_path):
    """Three runs in sessions of three zones over a growing source, across the end of summer time, take every row once."""
    state, out = str(tmp_path / "s"), str(tmp_path / "t")
    first = dt.datetime(2024, 11, 2, 20, tzinfo=dt.UTC)
    micros = [int((first + dt.timedelta(minutes=20 * i)).timestamp()) * 1_000_000 + i for i in range(90)]
    source = lambda upto: lambda s: s.createDataFrame([(m,) for m in micros[:upto]], "m long").select(F.timestamp_micros("m").alias("at"))
    run = lambda upto: Flow(source(upto), "append", {"path": out}, Incremental("at", initial="2024-11-02T20:00:00"), state).run(spark)
    before = spark.conf.get("spark.sql.session.timeZone")
    rows = []
    try:
        for zone, upto in (("UTC", 17), ("America/Los_Angeles", 41), ("Asia/Tokyo", 70), ("America/Los_Angeles", 90)):
            spark.conf.set("spark.sql.session.timeZone", zone)
            report = run(upto)
            rows.append(report.rows)
            assert report.watermark == (first + dt.timedelta(minutes=20 * (upto - 1), microseconds=upto - 1)).isoformat(" ")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert rows == [16, 24, 29, 20]  # the first row is at the initial bound itself
    got = sorted(r[0] for r in load.FileTable(spark, out).read().select(F.unix_micros("at")).collect())
    assert got == micros[1:] and StateTable(spark, state).read("flow") == Watermark(str(micros[-1]), "timestamp")


def test_watermarks_keep_their_type(spark, tmp_path):
    state = str(tmp_path / "s")
    flow = lambda kind: Flow(lambda s: events(s).withColumn("updated_at", F.col("updated_at").cast(kind)), "none", incremental=Incremental("updated_at"), state=state)
    flow("timestamp_ntz").run(spark)
    with pytest.raises(WatermarkError, match="timestamp_ntz"):
        flow("timestamp").run(spark)
    StateTable(spark, state)._versions("old").commit(1, '{"value": "2024-01-01 00:00:00", "type": "timestamp"}')
    with pytest.raises(WatermarkError):
        StateTable(spark, state).read("old")
    values = spark.range(1).select(
        F.lit(3.5).alias("double"), F.lit("o'b").alias("string"), F.lit(b"\x00\xff").alias("binary"), F.expr("1.50").alias("decimal"), F.expr("date'2024-02-29'").alias("date"),
        F.expr("timestamp_ntz'2024-03-31 02:30:00.000001'").alias("ntz"), F.expr("timestamp'2024-03-31 02:30:00.000001Z'").alias("instant"), F.expr("-5L").alias("long"),
    )
    for f in values.schema:
        text = values.select(as_state(F.col(f.name), f.dataType)).first()[0]
        assert values.select(from_state(text, f.dataType) == F.col(f.name)).first()[0], f.name


def test_failed_write_keeps_watermark(spark, tmp_path):
    state = str(tmp_path / "s")
    bad = Flow(lambda s: events(s).withColumn("x", F.when(F.col("id") == 4, F.raise_error(F.lit("broken")).cast("int")).otherwise(1)), "append", {"path": str(tmp_path / "t")}, Incremental("updated_at"), state)
    with pytest.raises(Exception):
        bad.run(spark)
    assert StateTable(spark, state).read("flow") is None
    assert load.FileTable(spark, str(tmp_path / "t")).state()["data"] == []


def test_sizes_and_names():
    assert [files.parse_size(x) for x in ("500", "  64 ", "64KiB", "1MiB", "1MB", "500b")] == [512_000, 65_536, 65_536, 1_048_576, 1_000_000, 500]
    for bad in ("not-a-size", "", "5 parsecs"):
        with pytest.raises(ValueError):
            files.parse_size(bad)
    with pytest.raises(ValueError):
        files.chunk_size("500b")
    assert files.file_name("events", "snappy") == "events.snappy.parquet"
    assert files.file_name("orders-2024", "uncompressed") == "orders-2024.uncompressed.parquet"
    assert files.file_name("events", "zstd", 42) == "events.00000042.zstd.parquet"
    assert files.file_name("e", "lz4", 100_000_000) == "e.100000000.lz4.parquet"


def test_parquet_sink(spark, tmp_path):
    df = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")).repartition(1)
    rows, made = files.write_parquet(df, str(tmp_path), "x", "snappy", "1MiB")
    sizes = [os.path.getsize(p.removeprefix("file:")) for p in made]
    assert rows == 60_000 and len(made) > 3 and max(sizes) < 1.3 * 2**20 and min(sizes[:-1]) > 0.5 * 2**20
    assert sorted(os.listdir(tmp_path))[-1].startswith("x.0000000") and spark.read.parquet(*made).count() == 60_000
    assert files.write_parquet(df.limit(0), str(tmp_path), "none") == (0, [])
    assert files.write_parquet(df.limit(3), str(tmp_path), "one", single=True) == (3, [f"file:{tmp_path}/one.snappy.parquet"])
    rows, parts = files.write_parquet(df.repartition(3), str(tmp_path), "parts", "zstd")
    assert rows == 60_000 and [p.rpartition("/")[2] for p in parts] == [f"parts.{i:08d}.zstd.parquet" for i in (1, 2, 3)]
    before = sorted(os.listdir(tmp_path))
    with pytest.raises(Exception):
        files.write_parquet(df.withColumn("b", F.raise_error(F.lit("broken"))), str(tmp_path), "bad")
    assert sorted(os.listdir(tmp_path)) == before
    for prefix, folder, codec in (("", str(tmp_path), "snappy"), ("x", str(tmp_path / "no"), "snappy"), ("x", str(tmp_path), "rar")):
        with pytest.raises((ValueError, FileNotFoundError)):
            files.write_parquet(df, folder, prefix, codec)


def test_chunks_keep_the_cap_where_later_rows_are_wider(spark, tmp_path):
    text = lambda n: F.expr(f"array_join(transform(sequence(1, {n}), k -> sha2(concat_ws('-', id, k), 256)), '')")
    wide, huge = text(30), text(3000)
    df = spark.range(0, 23_001, 1, 1).select("id", F.when(F.col("id") == 23_000, huge).when(F.col("id") >= 20_000, wide).otherwise("x").alias("t"))
    rows, made = files.write_parquet(df, str(tmp_path), "x", "snappy", "128KiB")
    size = {p: os.path.getsize(p.removeprefix("file:")) for p in made}
    assert rows == 23_001 and sorted(x for x in os.listdir(tmp_path) if not x.startswith(".")) == sorted(p.rpartition("/")[2] for p in made)
    over = [p for p, n in size.items() if n > 128 * 1024]
    assert len(over) == 1 and [r["id"] for r in spark.read.parquet(*over).collect()] == [23_000]
    back = spark.read.parquet(*made)
    assert back.count() == rows and back.exceptAll(df).isEmpty() and df.exceptAll(back).isEmpty()


def test_jsonl_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "a int, b string")
    assert files.write_jsonl(df, str(tmp_path / "j")) == 2
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "j")).collect()) == ['{"a":1,"b":null}', '{"a":2,"b":"b"}']
    assert files.write_none(df) == 2


def test_merge_rules(spark):
    t = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "id int, name string, v int")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "id int, name string")
    out = sorted(load.merged(t, s, ["id"]).collect(), key=str)
    assert out == sorted([(1, "a", 10), (2, "B", 20), (3, "C", None), (None, "N", None), (None, "n", 0)], key=str)
    keys = spark.createDataFrame([(1, 1), (5, 5)], "a int, b int")
    assert sorted(load.merged(spark.createDataFrame([(1, 1)], "a int, b int"), keys, ["a", "b"]).collect()) == [(1, 1), (5, 5)]
    with pytest.raises(ValueError):
        load.merged(t, s, ["missing"])
    with pytest.raises(ValueError):
        load.merged(t, s, [])
    twice = s.unionByName(s)
    with pytest.raises(Exception):
        load.merged(t, twice, ["id"]).collect()
    with pytest.raises(Exception):
        load.merged(t, s, ["id"], reject_null_keys=True).collect()
    late = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], "id int, name string, v int")
    assert (2, "y", 2) in load.merged(t, late, ["id"], on_duplicate="latest", order="v").collect()


def test_file_table(spark, tmp_path):
    t = load.FileTable(spark, str(tmp_path / "t")).create(events(spark).schema)
    assert t.read().count() == 0
    t.append(events(spark, 2))
    with pytest.raises(Exception):
        t.append(events(spark).withColumn("id", F.raise_error(F.lit("broken")).cast("long")))
    assert ids(t.read()) == [0, 1, 99]
    staged = events(spark, 4).filter("id < 90")
    for _ in range(2):
        t.merge(staged, ["id"])
        assert ids(t.read()) == [0, 1, 2, 3, 99]
    t.vacuum()
    assert ids(t.read()) == [0, 1, 2, 3, 99]
    assert {f"{d}/{b}" for d in os.listdir(tmp_path / "t") if d.startswith("data-") for b in os.listdir(tmp_path / "t" / d) if "=" in b} >= set(t.state()["data"])


def derby(spark, name):
    return {"url": f"jdbc:derby:memory:{name};create=true", "driver": "org.apache.derby.jdbc.EmbeddedDriver"}


def test_jdbc(spark):
    o, df = derby(spark, "t1"), spark.range(100).select("id", F.concat(F.lit("n"), "id").alias("name"))
    df.write.format("jdbc").options(**o).option("dbtable", "target").mode("error").save()
    read = lambda **k: scan.jdbc_query(spark, o, "SELECT * FROM target", **k)
    parts = read(partition=('"id"', 0, 100, 4), fetch=10)
    assert parts.rdd.getNumPartitions() == 4 and ids(parts) == list(range(100))
    bad = df.repartition(4).withColumn("id", F.when(F.col("id") == 50, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id") + 1000))
    with pytest.raises(Exception):
        jdbc.append(bad, o, "target")
    assert read().count() == 100
    assert jdbc.append(df.withColumn("id", F.col("id") + 100), o, "target") == 100
    for _ in range(2):
        jdbc.merge(df.filter("id < 5").withColumn("name", F.lit("new")).union(spark.createDataFrame([(500, "x")], "id long, name string")), o, "target", ["id"])
    rows = read().collect()
    assert len(rows) == 201 and sum(r["name"] == "new" for r in rows) == 5
    with pytest.raises(ValueError):
        read(isolation="serializable", partition=('"id"', 0, 1, 2))


def test_no_embedded_database_on_a_cluster(spark, monkeypatch):
    """Executors can't see it, those of local-cluster neither: the queries stop before anything is written."""
    from tideway import catalog

    for master in ("local-cluster[2,1,1024]", "spark://h:7077", "yarn"):
        monkeypatch.setattr(spark.sparkContext, "master", master)
        with pytest.raises(ValueError, match="spark.tideway.jdbc.url must name a database server"):
            catalog._database(spark, "d")
    for master in ("local", "local[*]", "local[2,3]"):
        monkeypatch.setattr(spark.sparkContext, "master", master)
        assert catalog._database(spark, "d")["url"].startswith("jdbc:derby:memory:d;")


def test_equal_shares_of_a_skewed_key(spark):
    """90 % of the rows in a tenth of the range, and rows without a key: no connection takes more than a quarter."""
    o = derby(spark, "t2")
    df = spark.range(2000).select(F.when(F.col("id") % 10 > 0, F.col("id") % 500).when(F.col("id") < 1900, F.col("id") * 5).alias("k"), "id")
    df.write.format("jdbc").options(**o).option("dbtable", "skewed").mode("error").save()
    read = scan.jdbc_query(spark, o, "SELECT * FROM skewed", partition=('"k"', 8))
    sizes = [r["count"] for r in read.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 2000 and max(sizes) <= 500 and read.rdd.getNumPartitions() == 8 and read.exceptAll(df).isEmpty()
    even = scan.jdbc_query(spark, o, "SELECT * FROM skewed", partition=('"k"', 0, 9501, 8))
    assert max(r["count"] for r in even.groupBy(F.spark_partition_id()).count().collect()) > 1500
    assert scan.depth_predicates("c", []) == ["1 = 1"] and scan.depth_predicates("c", [3, 3]) == ["c < 3 OR c IS NULL", "c >= 3"]
    assert scan.depth_predicates("c", [dt.date(2024, 1, 2), dt.date(2024, 2, 1)])[1] == "c >= DATE '2024-01-02' AND c < DATE '2024-02-01'"
    assert scan.sql_value(dt.datetime(2024, 1, 2, 3)) == "TIMESTAMP '2024-01-02 03:00:00'" and scan.sql_value("o'b") == "'o''b'"
    assert scan.percentile_sql("SELECT k FROM t", '"k"', 4) == """SELECT unnest(percentile_disc(ARRAY[0.25, 0.5, 0.75]) WITHIN GROUP (ORDER BY "k")) AS cut FROM (SELECT k FROM t) k WHERE "k" IS NOT NULL"""


@pytest.mark.parametrize("cursor", ["at", "instant", "n", "day", "x", "name"])
def test_incremental_streams(spark, tmp_path, cursor):
    """Runs over a growing folder, with a driver that stops between a batch and its commit, take every row once; rows without a cursor come with the first."""
    path, check = str(tmp_path / "s"), str(tmp_path / "c")
    table = load.FileTable(spark, str(tmp_path / "t"))

    def grow(a, b, none=0):
        i = F.col("id")
        rows = spark.range(a, b).select(
            "id", F.timestamp_micros(i * 1_000_001).cast("timestamp_ntz").alias("at"), F.timestamp_micros(i * 1_000_001).alias("instant"), i.alias("n"),
            F.date_add(F.lit("2024-01-01").cast("date"), i.cast("int")).alias("day"), (i / 7).alias("x"), F.lpad(i.cast("string"), 5, "0").alias("name"),
        )
        if none:
            rows = rows.union(spark.range(none).select((-1 - F.col("id")).alias("id"), *(F.lit(None).cast(f.dataType) for f in rows.schema[1:])))
        rows.write.mode("append").parquet(path)

    run = lambda: append_stream(spark, stream.stream(spark, path, cursor), table, check)
    grow(0, 50, none=3)
    run()
    assert table.read().count() == 53
    if cursor == "at":
        for name in glob.glob(f"{check}/commits/[0-9]*") + glob.glob(f"{check}/commits/.[0-9]*"):
            os.remove(name)
    grow(50, 80, none=2)
    run()
    run()
    assert sorted(r["id"] for r in table.read().collect()) == [-3, -2, -1, *range(80)]
    last = json.loads(open(sorted(glob.glob(f"{check}/offsets/[0-9]*"), key=lambda p: int(os.path.basename(p)))[-1]).read().splitlines()[-1])
    assert last["after"] == {"at": "79000079", "instant": "79000079", "n": "79", "day": "19802", "x": repr(79 / 7), "name": "00079"}[cursor]


def test_sql_text():
    sql = jdbc.merge_sql("t", "s", ["id", "name", "updated_at"], ["id"])
    assert 'ON t."id" = s."id" WHEN MATCHED THEN UPDATE SET "name" = s."name", "updated_at" = s."updated_at" WHEN NOT MATCHED' in sql and 'VALUES (s."id", s."name", s."updated_at")' in sql
    assert "WHEN MATCHED" not in jdbc.merge_sql("t", "s", ["a", "b"], ["a", "b"]).replace("WHEN NOT MATCHED", "")
    with pytest.raises(ValueError):
        jdbc.merge_sql("t", "s", ["a"], ["missing"])
    assert scan.isolation_statement("repeatable_read").endswith("REPEATABLE READ")
    with pytest.raises(ValueError):
        scan.isolation_statement("chaos")


def test_connection_options():
    assert [scan.duration(x) for x in ("10s", "0s", "500ms", "1000ms", "10ms", "30m", "2h", "1d")] == [10_000, 0, 500, 1000, 10, 1_800_000, 7_200_000, 86_400_000]
    for bad in ("100", "10y", "abc"):
        with pytest.raises(ValueError):
            scan.duration(bad)
    o = scan.jdbc_options({"host": "h", "database": "d", "user": "u", "password": "p"})
    assert o["url"] == "jdbc:postgresql://h:5432/d?sslmode=disable" and o["user"] == "u"
    o = scan.jdbc_options({"host": ["a", "b"], "database": "d", "tls": "verify-full", "channel_binding": "require", "statement_timeout": "5s"})
    assert "//a:5432,b:5432/d" in o["url"] and "channelBinding=require" in o["url"] and "statement_timeout = 5000" in o["sessionInitStatement"]


def test_delivery(spark, tmp_path):
    staged, out, ledger = tmp_path / "s", tmp_path / "o", str(tmp_path / "l")
    staged.mkdir()
    for i in range(5):
        (staged / f"part.{i:04d}.parquet").write_bytes(b"hello%d" % i)
    listed = deliver.manifest(spark, str(staged))
    marker = str(tmp_path / "failed")

    def breaks(path, folder, name):
        if name.endswith("3.parquet") and not os.path.exists(marker):
            open(marker, "w").close()
            raise RuntimeError("stopped in the middle")
        deliver.copy_file(path, folder, name)

    with pytest.raises(deliver.DeliveryError, match="stopped in the middle"):
        deliver.deliver(listed, str(out), ledger, breaks)
    assert sorted(f for f in os.listdir(out) if not f.startswith(".")) == [f"part.{i:04d}.parquet" for i in (0, 1, 2, 4)]
    assert deliver.deliver(listed, str(out), ledger, breaks) == 1  # what the first call delivered is not copied again
    assert deliver.deliver(listed, str(out), ledger) == 0
    assert sorted(os.listdir(out)) == [f"part.{i:04d}.parquet" for i in range(5)] and (out / "part.0002.parquet").read_bytes() == b"hello2"
    (staged / "sub").mkdir()
    (staged / "sub" / "part.0001.parquet").write_bytes(b"x")
    both = listed.union(deliver.manifest(spark, str(staged / "sub")))
    with pytest.raises(ValueError):
        deliver.deliver(both, str(out), ledger)


def test_delivery_goes_on_behind_a_round_that_was_lost(spark, tmp_path):
    """A driver that stops in a round: the rounds before it are in the ledger, and only the others are copied again."""
    staged, out, ledger, copies = tmp_path / "s", tmp_path / "o", str(tmp_path / "l"), tmp_path / "copies"
    staged.mkdir()
    copies.mkdir()
    for i in range(12):
        (staged / f"f{i}").write_bytes(b"x" * (i + 1))

    def logged(path, folder, name):
        open(copies / f"{name}.{os.urandom(4).hex()}", "w").close()
        if name == "f7" and len(list(copies.glob("f7.*"))) == 1:
            raise RuntimeError("once")
        deliver.copy_file(path, folder, name)

    listed = deliver.manifest(spark, str(staged))
    with pytest.raises(deliver.DeliveryError):
        deliver.deliver(listed, str(out), ledger, logged, round_files=3)
    first = len(list(copies.iterdir()))
    done = deliver.deliver(listed, str(out), ledger, logged, round_files=3)
    assert len(list(copies.iterdir())) == 13 and first + done == 13 and len([f for f in os.listdir(out) if not f.startswith('.')]) == 12
    assert deliver.pending(listed, ledger).count() == 0


def test_two_writers(spark, tmp_path):
    """Commits that were prepared over one version are both kept, and a merge is done again over what came in between."""
    path = str(tmp_path / "t")
    df = lambda *r: spark.createDataFrame(list(r), "id long, v string")
    a, b = load.FileTable(spark, path).create(df((1, "x")).schema), load.FileTable(spark, path)
    write, between = a._write, []

    def late(frame, state):
        made = write(frame, state)
        if not between:
            between.append(1)
            b.append(df((2, "b"), (3, "b")))
        return made

    a._write = late
    a.append(df((1, "a")))
    assert sorted(map(tuple, b.read().collect())) == [(1, "a"), (2, "b"), (3, "b")]
    between.clear()
    a.merge(df((2, "a"), (9, "a")), ["id"])
    assert sorted(map(tuple, b.read().collect())) == [(1, "a"), (2, "a"), (3, "b"), (3, "b"), (9, "a")]
    between.clear()
    a.append(df((10, "z")))
    assert b.read().filter("id = 10").count() == 1 and b.state()["keys"] == ["id"] and all("=" in d for d in b.state()["data"])
    with pytest.raises(FileExistsError):
        b.create(df((1, "x")).schema)
    state = StateTable(spark, str(tmp_path / "state"))
    for v in ("1", "2", "3"):
        state.store("a/b", Watermark(v, "string"))
    assert state.read("a/b") == Watermark("3", "string") and state.read("a") is None


def test_merge_rewrites_touched_buckets_only(spark, tmp_path):
    t = load.FileTable(spark, str(tmp_path / "t")).create(spark.createDataFrame([], "id long, v string").schema, ["id"], buckets=8)
    t.append(spark.range(1000).select("id", F.lit("old").alias("v")).union(spark.createDataFrame([(None, "n")] * 40, "id long, v string")))
    before = t.state()["data"]
    assert len([d for d in before if "=-" in d]) >= 1 and len([d for d in before if "=-" not in d]) == 8
    t.merge(spark.createDataFrame([(5, "new"), (2000, "new"), (None, "m")], "id int, v string"), ["id"])
    after = t.state()["data"]
    assert len(set(before) - set(after)) <= 2 and len(set(before) & set(after)) >= 6 and t.read().count() == 1042
    assert t.read().filter("v = 'new'").count() == 2 and t.read().filter("id = 5").count() == 1
    t.vacuum()
    assert t.read().count() == 1042


def test_merge_rewrites_files_with_hits_only(spark, tmp_path):
    t = load.FileTable(spark, str(tmp_path / "t")).create(spark.createDataFrame([], "id long, v string").schema, ["id"], buckets=8)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "100")
    try:
        t.append(spark.range(100_000).select("id", F.lit("old").alias("v")))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    there = lambda: {p for d in t._paths(t.state(), t.state()["data"]) for p in ([d.removeprefix("file:")] if d.endswith(".parquet") else glob.glob(f"{d}/*.parquet"))}
    before = there()
    assert len(before) >= 1000
    keys = [k * 9_999 + 3 for k in range(10)]
    staged = spark.createDataFrame([(k, "new") for k in keys] + [(500_000, "new")], "id long, v string")
    for turn in range(2):
        t.merge(staged, ["id"])
        after = there()
        assert len(before - after) <= 10 + turn and t.read().count() == 100_001
        assert sorted(r["id"] for r in t.read().filter("v = 'new'").collect()) == [*sorted(keys), 500_000]
    t.merge(spark.createDataFrame([(700_000, "far")], "id long, v string"), ["id"])
    assert after <= there() and t.read().count() == 100_002
    many = spark.range(0, 100_000, 7).select("id", F.lit("many").alias("v"))
    t.merge(many, ["id"])
    assert t.read().filter("v = 'many'").count() == many.count() and t.read().select("id").distinct().count() == t.read().count() == 100_002
    t.vacuum()
    assert t.read().count() == 100_002


@pytest.mark.parametrize("few", [0, 100_000])
def test_merges_and_reads_list_no_files_on_the_driver(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(load, "FEW_FILES", few)
    seen, plain = [], load.Files.list
    monkeypatch.setattr(load.Files, "list", lambda self, path: [f for f in plain(self, path) if path.endswith("_versions") or not seen.append(f)])
    t = load.FileTable(spark, str(tmp_path / "a table")).create(spark.createDataFrame([], "id long, v string").schema, ["id"], buckets=4)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
    try:
        t.append(spark.range(2000).select("id", F.lit("old").alias("v")))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    first = t.read()
    for turn, step in enumerate((400, 300, 500)):
        t.merge(spark.range(7, 2000, step).select("id", F.lit(f"new {turn}").alias("v")), ["id"])
        want = {i: next((f"new {k}" for k, s in [(2, 500), (1, 300), (0, 400)] if k <= turn and (i - 7) % s == 0 and i >= 7), "old") for i in range(2000)}
        assert sorted(map(tuple, t.read().collect())) == sorted(want.items())
        if turn == 1:
            assert len(seen) < 20 and first.filter("v = 'old'").count() == 2000
            t.vacuum()  # then a folder holds fewer files than names that are gone from it or live
    assert 0 < sum(map(len, t.state()["gone"].values())) <= 20
    t.merge(spark.range(2000).select("id", F.lit("all").alias("v")), ["id"])
    assert t.read().filter("v = 'all'").count() == t.read().count() == 2000


def test_a_first_merge_chooses_buckets_by_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(load, "BUCKET_BYTES", 2000)
    t = load.FileTable(spark, str(tmp_path / "t"))
    t.append(spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")))
    t.merge(spark.createDataFrame([(5, "new")], "id long, v string"), ["id"])
    assert 16 < t.state()["buckets"] <= 4096 and t.read().count() == 20_000 and t.read().filter("v = 'new'").count() == 1


def test_stream_appends_are_once(spark, tmp_path):
    """A batch that is run again after its commit, and one whose run was stopped before it."""
    source, check = str(tmp_path / "s"), str(tmp_path / "c")
    table = load.FileTable(spark, str(tmp_path / "t"))
    rows = lambda: spark.readStream.schema("id long").parquet(source)
    spark.range(0, 100).write.parquet(source)
    append_stream(spark, rows(), table, check)
    assert table.append(spark.range(0, 100), batch=(stream_id(spark, check), 0)) == 0
    commit = sorted(glob.glob(f"{check}/commits/[0-9]*"))[-1]
    os.remove(commit)  # the driver stopped behind the table's commit, before the stream's
    for crc in glob.glob(f"{check}/commits/.*crc"):
        os.remove(crc)
    append_stream(spark, rows(), table, check)
    assert table.read().count() == 100
    spark.range(100, 150).write.mode("append").parquet(source)
    write, table._write = table._write, lambda *a: (_ for _ in ()).throw(RuntimeError("stopped"))
    with pytest.raises(Exception, match="stopped"):
        append_stream(spark, rows(), table, check)
    table._write = write
    for _ in range(2):
        append_stream(spark, rows(), table, check)
    assert table.read().count() == table.read().distinct().count() == 150


def test_latest_is_the_same_on_every_run(spark):
    rows = [(1, 5, c) for c in "badce"] + [(1, None, "z"), (2, None, "y"), (None, 1, "n"), (None, 1, "n")]
    one = {tuple(load.latest_by(spark.createDataFrame(p, "k int, o int, v string").repartition(n), ["k"], "o").orderBy("k", "v").collect()) for p, n in ((rows, 1), (rows[::-1], 3), (rows[3:] + rows[:3], 2))}
    assert len(one) == 1 and [r["k"] for r in next(iter(one))] == [None, None, 1, 2]


def test_early_chunks_count_from_their_tasks_commit(spark, tmp_path):
    """The second task waits until a follower sees the chunks of the first one."""
    folder, seen = str(tmp_path / "f"), str(tmp_path / "seen")
    os.mkdir(folder)
    text = F.expr("array_join(transform(sequence(1, 4), k -> sha2(concat_ws('-', id, k), 256)), '')")
    df = spark.range(0, 20_000, 1, 2).select("id", text.alias("t"))

    def wait(batches):
        import pyarrow as pa

        for batch in batches:
            first, counted = batch.column(0)[0].as_py() < 10_000, 0
            for _ in range(600):
                if first or counted:
                    break
                time.sleep(0.1)
                lists = glob.glob(f"{folder}/_handover/run=*/part-*.json")
                counted = sum(json.loads(line)["rows"] for p in lists for line in open(p))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([counted] * batch.num_rows, pa.int64())], names=["id", "t", "seen"])

    rows, made = files.write_parquet(df.mapInArrow(wait, "id long, t string, seen long"), folder, "x", "snappy", "256KiB", early=True)
    assert rows == 20_000 and max(os.path.getsize(p.removeprefix("file:")) for p in made) <= 256 * 1024
    assert spark.read.parquet(*made).agg(F.max("seen")).first()[0] == 10_000
    kept = {f for f in os.listdir(folder) if not f.startswith(".")}
    assert kept == {"_handover", *(p.rpartition("/")[2] for p in made)}
    with pytest.raises(Exception):
        files.write_parquet(df.withColumn("t", F.when(F.col("id") == 19_999, F.raise_error(F.lit("broken"))).otherwise(F.col("t"))), folder, "y", "snappy", "256KiB", early=True)
    assert {f for f in os.listdir(folder) if not f.startswith(".")} == kept and files.handed_over(spark, folder).count() == len(made)
    for _ in range(2):
        deliver_stream(spark, folder, str(tmp_path / "o"), str(tmp_path / "l"), str(tmp_path / "c"), early=True)
    assert spark.read.parquet(str(tmp_path / "o")).count() == 20_000 and seen


def test_one_file_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """Its row groups are those that the tasks wrote, in their order."""
    import pyarrow.parquet as pq

    monkeypatch.setattr(files, "PART_BYTES", 50_000)
    df = spark.range(0, 40_000, 1, 4).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h"), F.when(F.col("id") % 3 > 0, F.concat(F.lit("v"), F.col("id") % 5)).alias("v"), F.array(F.col("id"), F.lit(None)).alias("a"))
    for codec in files.CODECS:
        for _ in range(2):  # the second replaces the first
            assert files.write_parquet(df, str(tmp_path), "one", codec, single=True) == (40_000, [f"file:{tmp_path}/one.{codec}.parquet"])
        path = f"{tmp_path}/one.{codec}.parquet"
        if codec != "lz4":
            read = pq.ParquetFile(path)
            assert read.metadata.num_row_groups == 4 and read.read().column("id").to_pylist() == list(range(40_000))
        back = spark.read.parquet(path)
        assert back.exceptAll(df).isEmpty() and back.count() == 40_000 and back.filter("id BETWEEN 19990 AND 20009 AND v = 'v1'").count() == df.filter("id BETWEEN 19990 AND 20009 AND v = 'v1'").count()
    assert all(f.startswith("one.") for f in os.listdir(tmp_path) if not f.startswith("."))


def test_parquet_parts_grow_with_the_table(spark, monkeypatch):
    """No part gets more as the table grows: with eleven scan partitions there are as many parts."""
    from tideway import catalog

    rows = spark.range(0, 1100, 1, 11)
    monkeypatch.setattr(catalog, "table", lambda *_: rows)
    back = catalog.QUERIES["parquet_parts"](spark, "")
    assert back.count() == 1100 and len(back.inputFiles()) == 11


def test_tasks_that_outlive_a_failed_write_publish_nothing(spark, tmp_path):
    """The second task fails once the first has made a chunk; the first goes on for a while."""
    folder = str(tmp_path)

    def slow(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.column(0)[0].as_py():
                while not glob.glob(f"{folder}/x.*"):
                    time.sleep(0.05)
                raise RuntimeError("broken")
            for _ in range(100):
                time.sleep(0.05)
                yield pa.RecordBatch.from_arrays([pa.array([os.urandom(30).hex() for _ in range(1000)])], names=["t"])

    with pytest.raises(Exception, match="broken"):
        files.write_parquet(spark.range(0, 2, 1, 2).mapInArrow(slow, "t string"), folder, "x", "snappy", "64KiB", early=True)
    time.sleep(8)
    assert [f for f in os.listdir(folder) if f != "_handover" and not f.endswith(".crc")] == [] and files.handed_over(spark, folder).isEmpty()


_RETRIED = """
import os, sys
from pyspark.sql import SparkSession, functions as F
from pyspark import TaskContext
from tideway.sinks import files
from tideway.streaming.staged import deliver_stream

spark = SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
root = sys.argv[1]

def narrower(batches):
    import pyarrow as pa
    again = TaskContext.get().attemptNumber()
    for batch in batches:
        if not again and batch.column(0)[-1].as_py() >= 45_000:
            raise RuntimeError("the first attempt of this task fails")
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([str(i) * (1 if again else 40) for i in batch.column(0).to_pylist()])], names=["id", "t"])

df = spark.range(0, 50_000, 1, 2).mapInArrow(narrower, "id long, t string")
for early in (True, False):
    folder = f"{root}/{early}"
    os.mkdir(folder)
    rows, made = files.write_parquet(df, folder, "x", "snappy", "64KiB", early=early)
    there = [f for f in os.listdir(folder) if f.endswith(".parquet")]
    print(early, rows, spark.read.parquet(folder).count(), spark.read.parquet(folder).distinct().count(), len(there) == len(made))
deliver_stream(spark, f"{root}/True", f"{root}/out", f"{root}/ledger", f"{root}/check", early=True)
print(spark.read.parquet(f"{root}/out").count())
"""


def test_chunks_of_a_task_that_is_tried_again_count_once(tmp_path):
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = subprocess.run([sys.executable, "-c", _RETRIED, str(tmp_path)], cwd=here, env=os.environ | {"PYTHONPATH": here}, capture_output=True, text=True, timeout=300)
    assert out.stdout.splitlines() == ["True 50000 50000 50000 True", "False 50000 50000 50000 True", "50000"], out.stderr[-2000:]


def test_two_attempts_at_one_time_write_files_of_their_own(spark, tmp_path, monkeypatch):
    """As under speculation: both write the same task's chunks into one folder, one is ended."""
    import pyarrow as pa

    class Context:
        partitionId = staticmethod(lambda: 3)

    monkeypatch.setattr(files.TaskContext, "get", lambda: Context)
    batches = [pa.RecordBatch.from_arrays([pa.array([os.urandom(30).hex() for _ in range(1000)])], names=["t"]) for _ in range(6)]
    one, two = (files._rolling(str(tmp_path), "x", "snappy", 64 * 1024)(iter(b)) for b in (batches, batches[::-1]))
    names, other = [next(one)], [next(two)]
    names += one
    other += [next(two)]
    two.close()
    assert sorted(os.listdir(tmp_path)) == sorted(b["name"][0].as_py() for b in names) and len(other) == 2
    assert spark.read.parquet(str(tmp_path)).count() == 6000


@pytest.fixture
def mounted(spark, tmp_path):
    """A folder under a scheme that Hadoop knows and pyarrow does not."""
    name = f"m{os.urandom(4).hex()}"
    (tmp_path / "mounted").mkdir()
    conf = spark._jsc.hadoopConfiguration()
    conf.set(f"fs.viewfs.mounttable.{name}.link./at", f"file://{tmp_path}/mounted")
    return f"viewfs://{name}/at", tmp_path / "mounted"


def test_chunks_and_copies_on_a_store_that_only_spark_knows(spark, mounted, tmp_path):
    at, local = mounted
    text = lambda n: F.expr(f"array_join(transform(sequence(1, {n}), k -> sha2(concat_ws('-', id, k), 256)), '')")
    df = spark.range(0, 6_000, 1, 2).select("id", F.when(F.col("id") >= 5_500, text(30)).otherwise("x").alias("t"))
    for early in (False, True):
        folder = f"{at}/{early}"
        os.mkdir(local / str(early))
        rows, made = files.write_parquet(df, folder, "x", "snappy", "128KiB", early=early)
        there = [p for p in os.listdir(local / str(early)) if p.endswith(".parquet")]
        assert rows == 6_000 and len(there) == len(made) > 5 and max(os.path.getsize(local / str(early) / p) for p in there) <= 128 * 1024
        assert spark.read.parquet(folder).exceptAll(df).isEmpty() and spark.read.parquet(folder).count() == rows
    assert files.handed_over(spark, f"{at}/True").count() == len(made)
    raw = {"a.txt": b"one\ntwo\n", "b.bin": bytes(range(256)) * 3, "c": b"x", "d": b"end\xff", "e f=%": b"\n", "g": bytes([200, 128]) * 2, "h": "größe".encode(), "z": b"\x00"}
    os.mkdir(local / "raw")
    for name, data in raw.items():
        (local / "raw" / name).write_bytes(data)
    listed = deliver.manifest(spark, f"{at}/raw")
    assert deliver.deliver(listed, f"{at}/out", str(tmp_path / "ledger")) == len(raw)
    assert {p.name: p.read_bytes() for p in (local / "out").iterdir() if not p.name.startswith(".")} == raw
    assert deliver.deliver(listed, f"{at}/out", str(tmp_path / "ledger")) == 0


def test_a_large_file_is_copied_by_several_tasks(spark, tmp_path, monkeypatch):
    staged, out, ledger, marks = tmp_path / "s", tmp_path / "o", str(tmp_path / "l"), tmp_path / "m"
    staged.mkdir()
    marks.mkdir()
    data = os.urandom(800_001)
    (staged / "large").write_bytes(data)
    (staged / "other").write_bytes(data[:300_000])
    (staged / "small").write_bytes(b"small")
    copy, at = deliver.copy_stretch, str(marks)

    def marked(source, target, start, length):
        from pyspark import TaskContext

        name = os.path.basename(source)
        if name == "other" and start and not glob.glob(f"{at}/other-*-again"):
            open(f"{at}/other-{start}-again", "w").close()
            raise RuntimeError("stopped in the middle")
        open(f"{at}/{name}-{start}-{TaskContext.get().partitionId()}", "w").close()
        copy(source, target, start, length)

    monkeypatch.setattr(deliver, "copy_stretch", marked)
    go = lambda: deliver.deliver(deliver.manifest(spark, str(staged)), str(out), ledger, part_bytes=100_000)
    with pytest.raises(deliver.DeliveryError, match="stopped in the middle"):
        go()
    assert sorted(os.listdir(out)) == ["large", "small"] and (out / "large").read_bytes() == data
    tasks = {f.name.rpartition("-")[2] for f in marks.glob("large-*")}
    assert len(list(marks.glob("large-*"))) == 9 and len(tasks) >= 8
    assert (go(), go()) == (1, 0) and (out / "other").read_bytes() == data[:300_000] and len(list(marks.glob("large-*"))) == 9


def test_a_replaced_file_goes_again(spark, tmp_path):
    staged, out, ledger = tmp_path / "s", tmp_path / "o", str(tmp_path / "l")
    staged.mkdir()
    (staged / "a").write_bytes(b"first")
    (staged / "b").write_bytes(b"other")
    go = lambda f: deliver.deliver(deliver.manifest(spark, str(f)), str(out), ledger)
    assert (go(staged), go(staged)) == (2, 0)
    (staged / "a").write_bytes(b"again")
    os.utime(staged / "a", (1_900_000_000, 1_900_000_000))
    assert go(staged) == 1 and (out / "a").read_bytes() == b"again" and go(staged) == 0
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "b").write_bytes(b"from elsewhere")
    with pytest.raises(ValueError, match="before"):
        go(tmp_path / "t")


def test_streams(spark, tmp_path):
    staging, table = str(tmp_path / "s"), load.FileTable(spark, str(tmp_path / "t")).create(events(spark).schema)
    for n in (2, 4, 4):
        events(spark, n).filter("id < 90").write.mode("append").parquet(staging)
        merge_stream(spark, staging, events(spark).schema, table, ["id"], str(tmp_path / "c"), on_duplicate="latest", order="updated_at")
    assert ids(table.read()) == [0, 1, 2, 3]
    for _ in range(2):
        deliver_stream(spark, staging, str(tmp_path / "o"), str(tmp_path / "l"), str(tmp_path / "d"))
    assert len(os.listdir(tmp_path / "o")) == len([f for f in os.listdir(staging) if f.endswith(".parquet")])


def test_describe(spark):
    assert [tuple(r) for r in describe(events(spark)).collect()] == [(0, "id", "bigint", True), (1, "updated_at", "timestamp_ntz", True)]


def test_tasks_list_and_read_the_files_of_a_table_of_many(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(load, "MANY_FILES", 50)
    monkeypatch.setattr(load, "TASK_FILES", 30)
    seen, plain = [], load.Files.list
    monkeypatch.setattr(load.Files, "list", lambda self, path: [f for f in plain(self, path) if path.endswith("_versions") or not seen.append(f)])
    kinds = "CAST(id % 3 AS byte) AS b, CAST(id AS short) AS s, CAST(id AS float) / 3 AS f, CAST(id AS double) / 7 AS d, CAST(id AS decimal(20, 3)) AS n, CAST(id AS decimal(7, 2)) AS m, CAST('t' || id AS binary) AS x, id % 2 = 0 AS o, DATE '0001-01-01' + CAST(id AS int) AS day"
    kinds += ", TIMESTAMP '0100-02-03 04:05:06.789012' + make_interval(0, 0, 0, CAST(id AS int)) AS ts, TIMESTAMP_NTZ '9999-12-31 23:59:59.999999' AS ntz, array(id, NULL) AS a, named_struct('t', TIMESTAMP '2024-01-01 00:00:00', 'l', array('p', NULL)) AS st, map('k', id) AS mp"
    for nested in (False, True):  # maps are read by Spark's own scan
        columns = kinds if nested else kinds.rpartition(", map")[0]
        spark.sql(f"SELECT id, IF(id % 5 = 0, NULL, 'v' || id) AS v, {columns} FROM range(2000)").write.parquet(str(tmp_path / f"rows {nested}"))
        rows = spark.read.parquet(str(tmp_path / f"rows {nested}"))
        t = load.FileTable(spark, str(tmp_path / f"a table {nested}")).create(rows.schema, ["id"], buckets=4)
        spark.conf.set("spark.sql.files.maxRecordsPerFile", "10")
        try:
            t.append(rows)
        finally:
            spark.conf.unset("spark.sql.files.maxRecordsPerFile")
        whole = lambda df: {r["id"]: r for r in df.collect()}
        first, want = t.read(), whole(rows)
        assert (sum(t.state()["files"].values()) >= 200) != nested and whole(first) == want and first.count() == 2000
        assert first.dtypes == rows.dtypes and (len(first.inputFiles()) > 0) == nested
        for turn, step in enumerate((400, 7, 90)):  # few files, nearly all, and again
            staged = rows.filter(f"id % {step} = 3").withColumn("v", F.lit(f"new {turn}"))
            t.merge(staged.unionByName(staged.limit(1).withColumn("id", F.lit(5000 + turn).cast("long"))), ["id"])
            want |= whole(staged)
            got = t.read()
            assert {i: r for i, r in whole(got).items() if i < 5000} == want and got.count() == 2001 + turn
            assert set(t.state()["files"]) <= set(t.state()["data"])
        assert first.filter("v LIKE 'new%'").count() == 0  # of its own version
        t.vacuum()
        assert t.read().count() == 2003
        t.merge(rows, ["id"])
        assert {i: r for i, r in whole(t.read()).items() if i < 5000} == whole(rows) and t.read().count() == 2003
    assert not [path for path, _ in seen if re.search(r"/part-\d{6}\.snappy", path)]  # the small ones


def test_small_files_are_written_without_spark_s_writer_and_once(spark, tmp_path, monkeypatch):
    """Files of a few rows: as many rows in each as the cap says, of every type, in folders of their tasks' own; a write that fails leaves none."""
    columns = "CAST(id AS decimal(20, 3)) AS n, CAST(id AS decimal(7, 2)) AS m, CAST('t' || id AS binary) AS x, DATE '0001-01-01' + CAST(id AS int) AS day, TIMESTAMP '0100-02-03 04:05:06.789012' AS ts, TIMESTAMP_NTZ '9999-12-31 23:59:59.999999' AS ntz, array(id, NULL) AS a, named_struct('t', TIMESTAMP '2024-01-01 00:00:00') AS st"
    rows = spark.sql(f"SELECT IF(id % 50 = 0, NULL, id) AS id, IF(id % 5 = 0, NULL, 'v' || id) AS v, {columns} FROM range(3000)")
    rows.write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    t = load.FileTable(spark, str(tmp_path / "a table")).create(rows.schema, ["id"], buckets=4)
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "70")
    try:
        assert t.append(rows) == 3000
        with pytest.raises(Exception, match="not now"):
            t.append(rows.withColumn("v", F.when(F.col("id") == 2999, F.raise_error(F.lit("not now"))).otherwise(F.col("v"))))
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    files = [f for d in t.state()["data"] for f in glob.glob(f"{t.path}/{d}/*")]
    assert not glob.glob(f"{t.path}/*/*/.*") and set(files) == set(glob.glob(f"{t.path}/data-*/*/*")) and sum(t.state()["files"].values()) == len(files)
    sizes = [spark.read.parquet(f).count() for f in files]
    assert max(sizes) == 70 and sum(sizes) == 3000 and sum(n < 70 for n in sizes) <= len(t.state()["data"])
    for many in (20_000, 5):  # by Spark's scan, and by tasks
        monkeypatch.setattr(load, "MANY_FILES", many)
        assert sorted(map(str, t.read().collect())) == sorted(map(str, rows.collect())) and t.read().filter("id = 7").count() == 1
    t.merge(rows.filter("id % 1000 = 7").withColumn("v", F.lit("X")), ["id"])
    assert t.read().filter("v = 'X'").count() == 3 and t.read().count() == 3000 and 0 < sum(map(len, t.state()["gone"].values())) <= 3
