"""Cutting lineage through tables in the shared folder."""

import atexit
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import Files, scratch

#: The open scopes of this thread or task: lists of paths, the innermost last.
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("scopes", default=())
#: Tables that results read, and what can delete them.
_results: dict[str, Files] = {}
#: Bytes at which an Arrow batch of texts ends; without it 10,000 rows are one, however long.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Let Arrow batches end at BATCH_BYTES; a session's own setting stays."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def materialize(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write df as Parquet into the shared folder and return the written table.

    The table outlives any executor, and later readers do not recompute df. keep: it also outlives the innermost scope();
    one that outlives all scopes is a result's, and goes by release() or with this Python process.
    """
    spark = df.sparkSession
    path = scratch(spark, "table")
    open_ = _scopes.get()
    outer = open_[-2:-1] if keep else open_[-1:]
    for made in outer:
        made.append(path)
    if not outer:
        _results[path] = Files(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def scope(spark: SparkSession):
    """The tables that are materialized in the block are deleted at its end, but for kept ones; what leaves the block must read these alone. Threads have scopes of their own."""
    made: list[str] = []
    token = _scopes.set((*_scopes.get(), made))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in made:
            Files(spark).delete(path)


def release() -> None:
    """Delete the tables that the results of operators read; none of these results can be used afterwards."""
    while _results:
        path, files = _results.popitem()
        files.delete(path)


@atexit.register
def _at_end() -> None:
    try:
        release()
    except Exception:  # the JVM has gone before
        pass


def own_columns(df: DataFrame) -> list[Column]:
    """The columns of df by their quoted names, whatever they hold."""
    return [F.col(quoted(c)) for c in df.columns]


def numbered(df: DataFrame) -> DataFrame:
    """df with columns c0, c1, ...: mapInArrow takes no names with dots."""
    return df.toDF(*(f"c{i}" for i in range(len(df.columns))))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fresh(df: DataFrame, prefix: str) -> str:
    """prefix, with more underscores before it until no column of df starts with it."""
    while any(c.lower().startswith(prefix.lower()) for c in df.columns):
        prefix = "_" + prefix
    return prefix
