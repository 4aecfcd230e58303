"""The incremental scan as a stream: a Python data source over a Parquet folder, whose offsets are watermarks.

Each batch takes the rows past the last offset, up to the greatest cursor value there is when it is
planned. Offsets lie in the stream's checkpoint, so that a batch that is run again after a crash has
the bounds that it had, and gives the rows that it gave; rows at or below the last offset that come later are
skipped, as by any incremental scan. Rows without a cursor value are read where there is no bound.
The driver looks at the files' statistics; tasks read a file each, through pyarrow, and so only from stores that it knows.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType, TimestampType

from ..storage import Files, arrow_at

NAME = "tideway_incremental"


def as_offset(value) -> str | None:
    """A cursor value (a pyarrow scalar) as text that keeps it exactly: numbers for times (microseconds in UTC) and dates, text for the rest."""
    import pyarrow as pa

    if not value.is_valid:
        return None
    if pa.types.is_timestamp(value.type):
        return str(value.cast(pa.timestamp("us", value.type.tz)).value)
    if pa.types.is_date32(value.type):
        return str(value.value)
    return repr(value.as_py()) if pa.types.is_floating(value.type) else str(value.as_py())


def from_offset(text: str, kind):
    """The inverse of as_offset: a pyarrow scalar of type kind."""
    import pyarrow as pa

    if pa.types.is_timestamp(kind):
        return pa.scalar(int(text), pa.int64()).cast(pa.timestamp("us", kind.tz))
    if pa.types.is_date32(kind):
        return pa.scalar(int(text), pa.int32()).cast(kind)
    if pa.types.is_integer(kind):
        return pa.scalar(int(text), kind)
    return pa.scalar(text).cast(kind)


@dataclass
class Stretch(InputPartition):
    """The rows of one file past one bound and up to another."""

    path: str
    after: str | None
    upto: str


def _dataset(path: str, store):
    from pyarrow import dataset

    kind = dataset.ParquetFileFormat(read_options=dataset.ParquetReadOptions(coerce_int96_timestamp_unit="us"))
    return dataset.dataset(path, filesystem=store, format=kind, exclude_invalid_files=False)


class IncrementalStream(DataSourceStreamReader):
    def __init__(self, path: str, cursor: str, initial: str | None, schema: StructType):
        self.path, self.cursor, self.initial = path, cursor, initial
        self.instants = {f.name: isinstance(f.dataType, TimestampType) for f in schema}

    def _files(self):
        store, root = arrow_at(self.path)
        return list(_dataset(root, store).get_fragments())

    def initialOffset(self) -> dict:
        return {"after": self.initial, "type": None}

    def latestOffset(self) -> dict:
        """The greatest cursor value: from the statistics of the row groups, from the values of those without."""
        import pyarrow as pa
        import pyarrow.compute as pc

        found, kind = None, None
        for fragment in self._files():
            kind = fragment.physical_schema.field(self.cursor).type
            for group in fragment.split_by_row_group():
                stats = group.row_groups[0].statistics or {}
                if self.cursor in stats and not pa.types.is_string(kind):  # those of texts may be cut
                    value = pa.scalar(stats[self.cursor]["max"], kind)
                else:
                    value = pc.max(group.to_table(columns=[self.cursor])[self.cursor])
                if value.is_valid and (found is None or pc.greater(value, found).as_py()):
                    found = value
        return {"after": as_offset(found) if found is not None else self.initial, "type": str(kind) if found is not None else None}

    def partitions(self, start: dict, end: dict):
        if None not in (start["type"], end["type"]) and start["type"] != end["type"]:
            raise ValueError(f"the stored watermark is of type {start['type']}, the cursor of type {end['type']}")
        if end["after"] is None or start["after"] == end["after"]:
            return []
        return [Stretch(f.path, start["after"], end["after"]) for f in self._files()]

    def read(self, partition: Stretch):
        import pyarrow as pa
        import pyarrow.compute as pc

        store, _ = arrow_at(self.path)
        one = _dataset(partition.path, store)
        kind, field = one.schema.field(self.cursor).type, pc.field(self.cursor)
        new = field <= from_offset(partition.upto, kind)
        new = new | field.is_null() if partition.after is None else new & (field > from_offset(partition.after, kind))
        for batch in one.to_batches(columns=list(self.instants), filter=new, batch_size=10_000):
            # Spark's older form of an instant has no zone in the file
            columns = [c.cast(pa.timestamp("us", "UTC")) if self.instants[n] else c for n, c in zip(batch.schema.names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)


class IncrementalSource(DataSource):
    """Options: path, cursor, and initial (an offset's text), all by stream()."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        raise NotImplementedError("stream() gives the schema")

    def streamReader(self, schema: StructType) -> IncrementalStream:
        return IncrementalStream(self.options["path"], self.options["cursor"], self.options.get("initial"), schema)


def stream(spark: SparkSession, path: str, cursor: str, initial: str | None = None) -> DataFrame:
    """A stream of the rows of a Parquet folder past a watermark that its checkpoint keeps. initial: an offset's text, such as microseconds for a time."""
    spark.dataSource.register(IncrementalSource)
    reader = spark.readStream.format(NAME).schema(spark.read.parquet(path).schema).option("path", Files(spark).qualified(path)).option("cursor", cursor)
    return (reader if initial is None else reader.option("initial", initial)).load()
