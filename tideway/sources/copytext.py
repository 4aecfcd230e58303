r"""COPY text: one line per row, cells between tabs, \N for NULL."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pgtext import decode_row, encode, escape, unescape

NULL = "\\N"


def render(df: DataFrame) -> DataFrame:
    """df as lines: a frame of one column, line."""
    cells = [F.coalesce(escape(encode(F.col(f"`{f.name}`"), f.dataType)), F.lit(NULL)) for f in df.schema]
    return df.select(F.concat_ws("\t", *cells).alias("line"))


def parse(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Lines (first column) as rows of schema; a line with another number of cells raises."""
    cells = F.split(F.col(lines.columns[0]), "\t", -1)
    n = len(schema)
    checked = lines.select(F.when(F.size(cells) == n, cells).otherwise(F.raise_error(F.concat(F.lit(f"a line has not {n} cells: "), F.col(lines.columns[0])))).alias("c"))
    cell = {f.name: F.when(F.get("c", F.lit(i)) != NULL, unescape(F.get("c", F.lit(i)))) for i, f in enumerate(schema)}
    return checked.select(*decode_row(cell, schema))


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return parse(spark.read.text(path, lineSep="\n"), schema)


def write(df: DataFrame, path: str) -> None:
    render(df).write.text(path, lineSep="\n")
