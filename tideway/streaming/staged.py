"""Structured Streaming over a staging folder: finished files are merged or delivered while later ones are written."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.deliver import deliver, listed
from ..operators.load import FileTable
from ..sinks.files import CHUNK, lists_of
from ..storage import Files


def merge_stream(spark: SparkSession, staging: str, schema: T.StructType, table: FileTable, keys: list[str], checkpoint: str, **how) -> None:
    """Merge all staged files that are new since the last call; a batch that is repeated after a crash changes nothing."""

    def one(batch: DataFrame, _: int) -> None:
        table.merge(batch, keys, **how)

    stream = spark.readStream.schema(schema).parquet(staging)
    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def append_stream(spark: SparkSession, rows: DataFrame, table: FileTable, checkpoint: str) -> None:
    """Append what a stream has that is new since the last call, every row once.

    A commit names the stream (its checkpoint's id) and the batch, so that a batch that is run again after its commit adds nothing.
    """

    def one(batch: DataFrame, number: int) -> None:
        table.append(batch, batch=(stream_id(spark, checkpoint), number))

    rows.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark has given the stream of a checkpoint."""
    return json.loads(Files(spark).read_text(f"{checkpoint.rstrip('/')}/metadata"))["id"]


def deliver_stream(spark: SparkSession, staging: str, folder: str, ledger: str, checkpoint: str, early: bool = False) -> None:
    """Deliver all staged files that are new since the last call. early: of a folder of early chunks, those whose tasks have committed by now."""

    def one(batch: DataFrame, _: int) -> None:
        if early:
            at = [f"{staging.rstrip('/')}/{r['name']}" for r in batch.select("name").collect()]  # the names of one batch
            if not at:
                return
            batch = listed(spark.read.format("binaryFile").load(at))
        deliver(batch, folder, ledger)

    if early:
        Files(spark).mkdirs(lists_of(staging))
        stream = spark.readStream.schema(CHUNK).json(lists_of(staging))
    else:
        stream = listed(spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.parquet").load(staging))
    stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
