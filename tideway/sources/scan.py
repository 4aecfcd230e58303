"""Scans: a query over registered tables, or over a database through JDBC."""

import datetime as dt
import re
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FETCH = 1000
ISOLATION = {"read_committed": "READ COMMITTED", "repeatable_read": "REPEATABLE READ", "serializable": "SERIALIZABLE"}
_UNITS = {"ms": 1, "s": 1000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}


def identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def literal(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def duration(text: str) -> int:
    """Milliseconds of a number with a unit (ms, s, m, h, d)."""
    m = re.fullmatch(r"([0-9]+)(ms|s|m|h|d)", text.strip())
    if not m:
        raise ValueError(f"not a duration: {text!r}")
    return int(m[1]) * _UNITS[m[2]]


def isolation_statement(level: str) -> str:
    if level not in ISOLATION:
        raise ValueError(f"unknown isolation level {level!r}; one of {', '.join(ISOLATION)}")
    return f"SET SESSION CHARACTERISTICS AS TRANSACTION ISOLATION LEVEL {ISOLATION[level]}"


def jdbc_options(config: dict) -> dict[str, str]:
    """URL and options of Spark's JDBC source for a PostgreSQL connection. The driver does TLS, channel binding and keepalives."""
    hosts = config["host"] if isinstance(config["host"], list) else [config["host"]]
    ports = config.get("port", 5432)
    ports = ports if isinstance(ports, list) else [ports] * len(hosts)
    if len(ports) != len(hosts):
        raise ValueError("as many ports as hosts, or one for all")
    named = {
        "ApplicationName": config.get("application_name"),
        "connectTimeout": duration(config["connect_timeout"]) // 1000 if "connect_timeout" in config else None,
        "options": config.get("options"),
        "targetServerType": config.get("target_session"),
        "tcpKeepAlive": {True: "true", False: "false"}.get(config.get("keepalives")),
        "channelBinding": config.get("channel_binding"),
        "sslmode": config.get("tls", "disable"),
    }
    query = "&".join(f"{k}={v}" for k, v in named.items() if v is not None)
    session = [f"SET {identifier(k)} = {literal(str(v))}" for k, v in config.get("session", {}).items()]
    if "statement_timeout" in config:
        session.append(f"SET statement_timeout = {duration(config['statement_timeout'])}")
    options = {"url": f"jdbc:postgresql://{','.join(f'{h}:{p}' for h, p in zip(hosts, ports, strict=True))}/{config['database']}?{query}", "driver": "org.postgresql.Driver"}
    options |= {k: config[k] for k in ("user", "password") if k in config}
    return options | ({"sessionInitStatement": "; ".join(session)} if session else {})


def register(spark: SparkSession, folder: str, *tables: str) -> None:
    """Register Parquet tables of a folder as views, for query()."""
    for t in tables:
        spark.read.parquet(f"{folder}/{t}.parquet").createOrReplaceTempView(t)


def query(spark: SparkSession, sql: str) -> DataFrame:
    """The result of a query over registered tables; a bad query fails here, before any row is read."""
    return spark.sql(sql)


def sql_value(value) -> str:
    """A bound as SQL: numbers as they are, dates and times as typed literals, anything else as text."""
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool):
        return str(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP {literal(value.isoformat(' '))}"
    if isinstance(value, dt.date):
        return f"DATE {literal(value.isoformat())}"
    return literal(str(value))


def depth_predicates(column: str, cuts: list) -> list[str]:
    """Conditions that part a table at ascending cuts; every row, those with a NULL too, meets one of them."""
    cuts = [sql_value(c) for c in dict.fromkeys(cuts)]
    if not cuts:
        return ["1 = 1"]
    first, last = f"{column} < {cuts[0]} OR {column} IS NULL", f"{column} >= {cuts[-1]}"
    return [first, *(f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts[:-1], cuts[1:], strict=True)), last]


def percentile_sql(sql: str, column: str, n: int) -> str:
    """One query for the n - 1 cuts of PostgreSQL that leave equal shares."""
    shares = ", ".join(str(i / n) for i in range(1, n))
    return f"SELECT unnest(percentile_disc(ARRAY[{shares}]) WITHIN GROUP (ORDER BY {column})) AS cut FROM ({sql}) k WHERE {column} IS NOT NULL"


def depth_cuts(spark: SparkSession, options: dict, sql: str, column: str, n: int, fetch: int = FETCH) -> list:
    """The n - 1 values of a query's column that part its rows into equal shares: by the database where it has percentiles, else by a pass of Spark's over that column alone."""
    if n < 2:
        return []
    if options["url"].startswith("jdbc:postgresql:"):
        return [r[0] for r in jdbc_query(spark, options, percentile_sql(sql, column, n), fetch).collect()]
    keys = jdbc_query(spark, options, f"SELECT {column} AS {identifier('k')} FROM ({sql}) k", fetch)
    if isinstance(keys.schema["k"].dataType, (T.StringType, T.BinaryType)):
        raise TypeError("equal shares need a column of numbers, dates or times")
    return keys.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 10_000)).first()[0] or []


def jdbc_query(spark: SparkSession, options: dict, sql: str, fetch: int = FETCH, isolation: str | None = None, partition: tuple | None = None, session_statement: str | None = None) -> DataFrame:
    """A query of the database. partition: (column, lower, upper, number of connections) for parts of equal width, (column, number) for parts of equal numbers of rows.

    With an isolation level the read is one transaction and so one connection: several would each see a snapshot of their own.
    """
    if isolation and partition:
        raise ValueError("one snapshot needs one connection: give isolation or partition, not both")
    start = session_statement or (isolation_statement(isolation) if isolation else None)
    given = options | {"fetchsize": str(fetch)} | ({"sessionInitStatement": start} if start else {})
    if partition and len(partition) == 2:
        column, n = partition
        where = depth_predicates(column, depth_cuts(spark, given, sql, column, n, fetch))
        return spark.read.jdbc(options["url"], f"({sql}) src", predicates=where, properties={k: str(v) for k, v in given.items() if k != "url"})
    reader = spark.read.format("jdbc").options(**given).option("dbtable", f"({sql}) src")
    if partition:
        column, lower, upper, n = partition
        reader = reader.option("partitionColumn", column).option("lowerBound", lower).option("upperBound", upper).option("numPartitions", n)
    return reader.load()


def text_numerics(schema: T.StructType) -> str:
    """customSchema that reads decimal columns as text."""
    return ", ".join(f"{f.name} STRING" for f in schema if isinstance(f.dataType, T.DecimalType))
