"""The portable set of column types, and schemas as rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Marks a string column that holds an hstore value as JSON.
HSTORE = {"source_type": "hstore"}

#: Database type names and the Spark types that they are read as; anything else is text.
DATABASE_TYPES = {
    "int2": T.IntegerType(),
    "int4": T.IntegerType(),
    "int8": T.LongType(),
    "float4": T.FloatType(),
    "float8": T.DoubleType(),
    "bool": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
    "bytea": T.BinaryType(),
}


def field(name: str, database_type: str) -> T.StructField:
    """The nullable field that a column of a database type is read as; arrays are written type[]."""
    if database_type == "hstore":
        return T.StructField(name, T.StringType(), True, HSTORE)
    if database_type.endswith("[]"):
        return T.StructField(name, T.ArrayType(field(name, database_type[:-2]).dataType, True), True)
    return T.StructField(name, DATABASE_TYPES.get(database_type, T.StringType()), True)


def portable(kind: T.DataType) -> T.DataType:
    """The portable type of a column that arrives as kind: narrow integers widen, decimals and the like become text."""
    if isinstance(kind, (T.ByteType, T.ShortType)):
        return T.IntegerType()
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(portable(kind.elementType), True)
    kept = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.BooleanType, T.DateType, T.TimestampNTZType, T.TimestampType, T.BinaryType, T.MapType)
    return kind if isinstance(kind, kept) else T.StringType()


def normalize(df: DataFrame) -> DataFrame:
    """df with every column cast to its portable type, in one projection."""

    def cast(f: T.StructField) -> Column:
        to = portable(f.dataType)
        return F.col(f"`{f.name}`") if to == f.dataType else F.col(f"`{f.name}`").cast(to).alias(f.name)

    return df.select(*map(cast, df.schema.fields))


def describe(df: DataFrame) -> DataFrame:
    """One row per field: position, name, type, nullable (always true on the read side). No data is read."""
    rows = [(i, f.name, f.dataType.simpleString(), True) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string, nullable boolean")
