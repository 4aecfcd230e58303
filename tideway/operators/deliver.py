"""Delivery of finished files: manifest, ledger, and copies made by executors.

Files that the ledger does not list are copied under their own names; a copy replaces an
earlier one in one step, so that a repeat is harmless. A file is known by its path, length and
time, so that one that is written anew under its name goes again. Copies run in rounds of at
most ROUND files. A copy that fails does not stop its round: the ledger gets the files that were
copied, and the error is raised behind it, so that the next call goes on with what is left, and a
lost driver costs one round. Two files of one name would overwrite each other, in one manifest
or one delivered before from another path: that is an error.

Tasks copy through pyarrow where it knows both stores; into a file system with positioned writes, a
file of over PART_BYTES is copied by several tasks, each a stretch, and shows once all are there. Elsewhere Spark's own reader and writer
carry the bytes, so that any store of Hadoop's will do: a file is then one row, of 2 GB at most.
"""

import os
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..storage import Files, arrow_at, arrow_knows, scratch

MANIFEST = "path string, file_name string, length long, modified timestamp"
#: error is NULL where the file was delivered.
LEDGER = MANIFEST + ", error string"
COPY_BYTES = 8 << 20
ROUND = 10_000
PART_BYTES = 128 << 20


def manifest(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """path, file_name, length and time of the finished files of a folder, but for empty ones; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return listed(files)


def listed(files: DataFrame) -> DataFrame:
    """The manifest of rows of Spark's binaryFile source."""
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", F.col("modificationTime").alias("modified"))


def _delivered(spark: SparkSession, ledger: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(ledger).filter("error IS NULL")


def pending(listed: DataFrame, ledger: str) -> DataFrame:
    """The files of a manifest that the ledger does not have."""
    spark = listed.sparkSession
    if not Files(spark).exists(ledger):
        return listed
    return listed.join(_delivered(spark, ledger).select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")


def copy_file(source: str, folder: str, name: str) -> None:
    """Copy one file in parts, between any stores that pyarrow knows; it shows under its name only once it is whole. Paths are qualified."""
    (from_fs, from_path), (to_fs, to_path) = arrow_at(source), arrow_at(folder)
    beside = f"{to_path.rstrip('/')}/.{name}.{uuid.uuid4().hex}"
    with from_fs.open_input_stream(from_path) as a, to_fs.open_output_stream(beside) as b:
        while part := a.read(COPY_BYTES):
            b.write(part)
    to_fs.move(beside, f"{to_path.rstrip('/')}/{name}")


def copy_by_spark(spark: SparkSession, paths: list[str], folder: str) -> None:
    """Copy files by Spark's reader and writer, for stores that only Hadoop knows.

    The text writer ends a row with a separator of one's own choice: that is the file's own last byte, behind the others as its row.
    """
    files = Files(spark)
    staging = f"{folder.rstrip('/')}/.copies-{uuid.uuid4().hex}"
    number = {p: i for i, p in enumerate(paths)}  # one round's
    numbers = spark.createDataFrame(list(number.items()), "path string, i int")
    read = spark.read.format("binaryFile").load(paths).join(F.broadcast(numbers), "path")
    last: Column = F.conv(F.hex(F.expr("substring(content, -1, 1)")), 16, 10).cast("int")
    try:
        for byte in sorted(r[0] for r in read.select(last.alias("b")).distinct().collect()):
            rows = read.filter(last == byte).select("i", F.expr("CAST(substring(content, 1, length - 1) AS STRING)").alias("value"))
            rows.write.partitionBy("i").mode("append").option("encoding", "ISO-8859-1").option("lineSep", chr(byte)).text(staging)
        for path, i in number.items():
            (part,) = (p for p, _ in files.list(f"{staging}/i={i}"))
            to = f"{folder.rstrip('/')}/{path.rpartition('/')[2]}"
            files.delete(to)
            files.rename(part, to)
    finally:
        files.delete(staging)


def copy_stretch(source: str, target: str, start: int, length: int, to: int | None = None) -> None:
    """Copy a stretch of a file to its place (or to another) in another file, which may not be there yet, on a file system with positioned writes."""
    from_fs, from_path = arrow_at(source)
    _, path = arrow_at(target)
    out = os.open(path, os.O_CREAT | os.O_WRONLY)
    try:
        with from_fs.open_input_file(from_path) as a:
            a.seek(start)
            at, end, shift = start, start + length, 0 if to is None else to - start
            while at < end:
                part = a.read(min(COPY_BYTES, end - at))
                if not part:
                    raise OSError(f"{source} has become shorter")
                at += os.pwrite(out, part, at + shift)
                a.seek(at)
        os.fsync(out)
    finally:
        os.close(out)


def copy_in_parts(large: DataFrame, folder: str, ledger: str, part_bytes: int) -> list[str]:
    """Copy each file of a manifest by several tasks, list those that came through in the ledger, and return the errors of the others.

    A stretch that is copied twice writes the same bytes to the same place; a file gets its name when all its stretches are there.
    """
    spark, files = large.sparkSession, Files(large.sparkSession)
    turn = uuid.uuid4().hex
    beside = F.concat(F.lit(f"{folder.rstrip('/')}/."), "file_name", F.lit(f".{turn}"))
    stretch = F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(part_bytes).cast("long")))
    parts = large.select("path", "length", beside.alias("beside"), stretch.alias("start"))

    def run(batches):
        for rows in batches:
            errors = []
            for path, length, to, start in zip(rows["path"], rows["length"], rows["beside"], rows["start"], strict=True):
                try:
                    copy_stretch(path, to, start, min(part_bytes, length - start))
                    errors.append(None)
                except Exception as e:
                    errors.append(f"{path}: {type(e).__name__}: {e}")
            yield pd.DataFrame({"path": rows["path"], "error": pd.Series(errors, index=rows.index, dtype=object)})

    n = parts.count()
    dealt = parts.repartitionByRange(max(n, 1), "path", "start")  # a task a stretch
    failed = dict(dealt.mapInPandas(run, "path string, error string").groupBy("path").agg(F.min("error").alias("e")).filter("e IS NOT NULL").collect())
    done = []
    for path, name in large.select("path", "file_name").collect():  # one round's
        hidden = f"{folder.rstrip('/')}/.{name}.{turn}"
        if path in failed:
            files.delete(hidden)
            continue
        to = f"{folder.rstrip('/')}/{name}"
        files.delete(to)
        files.rename(hidden, to)
        done.append(path)
    if done:
        large.filter(F.col("path").isin(done)).withColumn("error", F.lit(None).cast("string")).write.mode("append").parquet(ledger)
    return list(failed.values())


class DeliveryError(RuntimeError):
    """Some copies of a round failed; the others are in the ledger."""


def _stores(listed: DataFrame) -> list[str]:
    """A path of each store that the manifest's files are in."""
    store = F.regexp_extract("path", r"^([A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?)?", 0)
    return [r["p"] for r in listed.groupBy(store.alias("s")).agg(F.min("path").alias("p")).collect()]


def deliver(listed: DataFrame, folder: str, ledger: str, copy=copy_file, round_files: int = ROUND, part_bytes: int = PART_BYTES) -> int:
    """Copy the pending files of a manifest; returns how many."""
    spark = listed.sparkSession
    files = Files(spark)
    twice = listed.groupBy("file_name").agg(F.countDistinct("path").alias("n")).filter("n > 1").first()
    if twice:
        raise ValueError(f"{twice['n']} files are named {twice['file_name']}")
    if files.exists(ledger):
        known = _delivered(spark, ledger).select("file_name", F.col("path").alias("before"))
        other = listed.join(known, "file_name").filter(F.col("path") != F.col("before")).first()
        if other:
            raise ValueError(f"{other['file_name']} was delivered from {other['before']} before")
    files.mkdirs(folder)
    folder = files.qualified(folder)  # executors must not take it for a path of their own

    def run(batches):
        for rows in batches:
            errors = []
            for path, name in zip(rows["path"], rows["file_name"], strict=True):
                try:
                    copy(path, folder, name)
                    errors.append(None)
                except Exception as e:
                    errors.append(f"{path}: {type(e).__name__}: {e}")
            yield pd.DataFrame(rows).assign(error=pd.Series(errors, index=rows.index, dtype=object))

    held, delivered = scratch(spark, "pending"), 0
    try:
        pending(listed, ledger).write.parquet(held)
        todo = spark.read.schema(MANIFEST).parquet(held)
        rounds = -(-todo.count() // round_files)
        for r in range(rounds):
            mine = todo.filter(F.pmod(F.xxhash64("path"), F.lit(rounds)) == r)
            if copy is copy_file and not (arrow_knows(folder) and all(arrow_knows(p) for p in _stores(mine))):
                paths = [p for (p,) in mine.select("path").collect()]
                copy_by_spark(spark, paths, folder)
                mine.withColumn("error", F.lit(None).cast("string")).write.mode("append").parquet(ledger)
                delivered += len(paths)
                continue
            errors = []
            if copy is copy_file and folder.startswith("file:"):
                large = mine.filter(F.col("length") > part_bytes)
                several = large.count()
                errors = copy_in_parts(large, folder, ledger, part_bytes) if several else []
                delivered += several - len(errors)
                mine = mine.filter(F.col("length") <= part_bytes)
            seen = Observation()
            done = mine.repartition("path").mapInPandas(run, LEDGER).observe(seen, F.count_if(F.col("error").isNull()).alias("fine"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.min("error").alias("error"))
            done.write.mode("append").parquet(ledger)
            delivered += seen.get["fine"]
            errors += [seen.get["error"]] * seen.get["failed"]
            if errors:
                raise DeliveryError(f"{len(errors)} copies failed, the first: {min(errors)}")
    finally:
        files.delete(held)
    return delivered
