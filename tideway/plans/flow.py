"""A flow: a source, an optional incremental cursor, a sink, and a report of the run."""

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..sinks.files import counted
from ..sources.incremental import Incremental, StateTable, Watermark

#: Sinks by name: functions of (rows, options) that write all rows or none.
SINKS: dict[str, Callable[[DataFrame, dict], object]] = {}


def sink(name: str):
    """Register a sink."""

    def add(f):
        SINKS[name] = f
        return f

    return add


@sink("none")
def _none(df: DataFrame, options: dict):
    df.write.format("noop").mode("overwrite").save()


@sink("jsonl")
def _jsonl(df: DataFrame, options: dict):
    df.write.mode(options.get("mode", "overwrite")).option("ignoreNullFields", "false").json(options["path"])


@sink("parquet")
def _parquet(df: DataFrame, options: dict):
    from ..sinks.files import write_parquet

    return write_parquet(df, **options)


@sink("copytext")
def _copytext(df: DataFrame, options: dict):
    from ..sources.copytext import write

    write(df, options["path"])


@sink("append")
def _append(df: DataFrame, options: dict):
    from ..operators.load import FileTable

    FileTable(df.sparkSession, options["path"]).append(df)


@sink("merge")
def _merge(df: DataFrame, options: dict):
    from ..operators.load import FileTable

    FileTable(df.sparkSession, options["path"]).merge(df, options["keys"], **options.get("how", {}))


@dataclass
class Report:
    rows: int
    watermark: str | None = None


@dataclass
class Flow:
    """run() reads the new rows, writes them, and only then stores the watermark."""

    source: Callable[[SparkSession], DataFrame]
    sink: str
    options: dict = field(default_factory=dict)
    incremental: Incremental | None = None
    state: str | None = None
    name: str = "flow"

    def run(self, spark: SparkSession) -> Report:
        df = self.source(spark)
        if self.incremental is None:
            df, seen = counted(df)
            SINKS[self.sink](df, self.options)
            return Report(seen.get["rows"])
        table = StateTable(spark, self.state) if self.state else None
        last = table.read(self.name) if table else None
        rows, seen = self.incremental.observe(self.incremental.apply(df, last))
        SINKS[self.sink](rows, self.options)
        found = seen.get
        kind = df.schema[self.incremental.cursor].dataType.simpleString()
        mark = Watermark(found["watermark"], kind) if found["watermark"] is not None else last
        if table:
            table.store(self.name, mark)
        return Report(found["rows"], str(mark) if mark else None)
