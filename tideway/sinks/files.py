"""File sinks: JSON lines, Parquet in parts, in chunks of a capped size or in one file, and none at all (a count)."""

import contextlib
import os
import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.deliver import PART_BYTES, copy_stretch
from ..storage import Files, arrow_at, arrow_knows

#: The codec names of file names, and Spark's names for them.
CODECS = {"snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "lz4": "lz4_raw", "uncompressed": "uncompressed"}
#: The names of these codecs in Arrow.
ARROW_CODECS = {"snappy": "snappy", "gzip": "gzip", "zstd": "zstd", "lz4": "lz4", "uncompressed": "none"}
#: What a Parquet file begins and ends with.
MAGIC = b"PAR1"
LEAST_CHUNK = 64 * 1024
#: A row group is at most this part of the cap, and at most GROUP_BYTES, as it lies in memory.
GROUP_PART, GROUP_BYTES = 8, 64 << 20
#: Room for the footer, and for each column's entry of each row group in it, without its least and greatest value.
FOOTER, ENTRY = 2048, 160
#: Text columns with longer values get no least and greatest values.
LONG_VALUE = 256
#: What a chunk's writer says of it.
CHUNK = "name string, rows long, bytes long"
#: The file in a write's gate that says that its tasks may still publish.
OPEN = "open"
#: Renames at one time.
PUBLISHERS = 32
_UNITS = {"": 1024, "b": 1, "kb": 1000, "mb": 1000**2, "gb": 1000**3, "kib": 1024, "mib": 1024**2, "gib": 1024**3}


def parse_size(text: str) -> int:
    """Bytes of a size; a bare number counts KiB."""
    m = re.fullmatch(r"([0-9]+)\s*([A-Za-z]*)", text.strip())
    if not m or m[2].lower() not in _UNITS:
        raise ValueError(f"not a size: {text!r}")
    return int(m[1]) * _UNITS[m[2].lower()]


def chunk_size(text: str) -> int:
    size = parse_size(text)
    if size < LEAST_CHUNK:
        raise ValueError(f"a chunk has {LEAST_CHUNK} bytes at least, not {size}")
    return size


def file_name(prefix: str, codec: str, sequence: int | None = None) -> str:
    return f"{prefix}.{codec}.parquet" if sequence is None else f"{prefix}.{sequence:08d}.{codec}.parquet"


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_none(df: DataFrame) -> int:
    """Run df and drop its rows; returns how many there were."""
    df, seen = counted(df)
    df.write.format("noop").mode("overwrite").save()
    return seen.get["rows"]


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """One JSON object per row, null fields kept; a folder of parts that shows only once it is whole."""
    df, seen = counted(df)
    df.write.mode(mode).option("ignoreNullFields", "false").json(path)
    return seen.get["rows"]


def _rolling(folder: str, prefix: str, compression: str, cap: int, gate: str | None = None):
    """A function for mapInArrow that writes Parquet chunks near cap into folder and yields (name, rows, bytes) of each.

    The size is that of the bytes written: a chunk is closed before a row group that might take it over
    the cap, counted as it lies in memory. Names hold the attempt, so that no two attempts of a task write one file,
    and an attempt that fails or is ended takes its chunks back. What counts is what Spark keeps of the rows that are yielded.
    gate: a folder on the same store in which chunks lie until they are whole. An attempt that outlives the write, as one whose worker
    has not heard of the end yet, finds the gate gone and publishes nothing more.
    """
    most = max(1, min(cap // GROUP_PART, GROUP_BYTES))

    def cut(b):
        if b.num_rows > 1 and b.nbytes > most:
            yield from cut(b.slice(0, b.num_rows // 2))
            yield from cut(b.slice(b.num_rows // 2))
        elif b.num_rows:
            yield b

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        def lengths(table):
            """The longest value of each column of text or bytes."""
            kinds = (pa.types.is_string, pa.types.is_binary, pa.types.is_large_string, pa.types.is_large_binary)
            return {f.name: pc.max(pc.binary_length(table[f.name])).as_py() or 0 for f in table.schema if any(k(f.type) for k in kinds)}

        store, root = arrow_at(folder)
        inside = arrow_at(gate)[1] if gate else root
        own, made = f"{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}", []
        sink = writer = hidden = None
        rows = footer = 0
        measured: set[str] = set()
        held, size = [], 0

        def close():
            nonlocal sink, writer, rows, footer
            writer.close()
            length = sink.tell()
            sink.close()
            name = f"{prefix}.{own}-{len(made):06d}.{compression}.parquet"
            store.move(hidden, f"{root}/{name}")
            if gate and not store.get_file_info(f"{inside}/{OPEN}").is_file:  # on some stores a file makes its folder anew
                store.delete_file(f"{root}/{name}")
                raise RuntimeError("the write has ended")
            made.append(name)
            out = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([rows]), pa.array([length])], names=["name", "rows", "bytes"])
            sink, writer, rows, footer = None, None, 0, 0
            return out

        def flush():
            """Write what is held as a row group, behind a new chunk where it might be too much for this one."""
            nonlocal sink, writer, hidden, rows, footer, measured, held, size
            table = pa.Table.from_batches(held)
            long = lengths(table)
            entry = lambda: ENTRY * len(table.schema) + 4 * sum(n for c, n in long.items() if c in measured)
            if writer and sink.tell() + size + FOOTER + footer + 2 * entry() > cap:
                yield close()
            if not writer:
                hidden = f"{inside}/.{prefix}.{uuid.uuid4().hex}"
                sink = store.open_output_stream(hidden)
                measured = {c for c in table.column_names if long.get(c, 0) <= LONG_VALUE}
                writer = pq.ParquetWriter(sink, table.schema, compression=ARROW_CODECS[compression], write_statistics=sorted(measured))
            writer.write_table(table, row_group_size=table.num_rows)
            rows, footer, held, size = rows + table.num_rows, footer + entry(), [], 0

        try:
            for batch in batches:
                for part in cut(batch):
                    if held and size + part.nbytes > most:
                        yield from flush()
                    held.append(part)
                    size += part.nbytes
            if held:
                yield from flush()
            if writer:
                yield close()
        except BaseException:
            gone = [f"{root}/{name}" for name in made]
            if sink is not None:
                sink.close()
                gone.append(hidden)
            for path in gone:
                with contextlib.suppress(OSError):  # the driver may take them back, too
                    store.delete_file(path)
            raise

    return run


def write_parquet(df: DataFrame, folder: str, prefix: str, compression: str = "snappy", max_file_size: str | None = None, early: bool = False, single: bool = False) -> tuple[int, list[str]]:
    """Write df under its own names into an existing folder; returns the rows and the files. No rows: no file.

    Every partition makes a part, numbered from 1; with a size, tasks roll over to a new chunk by the bytes that they have
    written, so that none is over the cap but one of a single row; single: one file without a number, into which tasks copy the row groups of all parts; on stores without positioned writes one task writes it.
    Files show once the whole write has succeeded; a failed write leaves nothing behind, and files of an earlier write of this prefix are replaced by number only.
    early (with a size): a chunk counts from its task's commit on, while other tasks run, for a reader that follows handed_over(). Names
    then hold task and attempt. A task that is tried again, or run twice, counts once, as its commit is Spark's; chunks that don't count are
    deleted at the end, and a failed write takes back all, also of tasks that still run when it fails. On a store that Arrow does not know, Spark writes the chunks, and early ones count at the end.
    """
    files = Files(df.sparkSession)
    if not prefix:
        raise ValueError("the prefix is empty")
    if compression not in CODECS:
        raise ValueError(f"unknown codec {compression!r}; one of {', '.join(CODECS)}")
    if not files.is_dir(folder):
        raise FileNotFoundError(folder)
    folder = files.qualified(folder).rstrip("/")
    if max_file_size is not None:
        if single:
            raise ValueError("one file, or chunks of a size")
        return _write_chunks(df, files, folder, prefix, compression, chunk_size(max_file_size), early)
    if early:
        raise ValueError("early chunks need a size")
    staging = f"{folder}/_staging-{uuid.uuid4().hex}"
    out, seen = counted(df)
    try:
        joins = single and folder.startswith("file:")
        (out.coalesce(1) if single and not joins else out).write.option("compression", CODECS[compression]).parquet(staging)
        rows = seen.get["rows"]
        parts = [p for p, _ in files.list(staging)] if rows else []  # tasks without rows make no part, but the first
        if joins and len(parts) > 1:
            parts = [_joined(df.sparkSession, files, parts, f"{staging}/.joined")]
        return rows, _publish(files, parts, folder, lambda i: file_name(prefix, compression, None if single else i + 1))
    finally:
        files.delete(staging)


def _footer(spark: SparkSession, path: str):
    """The footer of a Parquet file, as Parquet's own library has it."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = at.getFileSystem(spark._jsc.hadoopConfiguration())
    end = store.getFileStatus(at).getLen() - 8
    stream = store.open(at)
    try:
        stream.seek(end)
        stream.seek(end - spark._jvm.java.lang.Integer.reverseBytes(stream.readInt()))
        return spark._jvm.org.apache.parquet.format.Util.readFileMetaData(stream)
    finally:
        stream.close()


def _joined(spark: SparkSession, files: Files, parts: list[str], target: str) -> str:
    """One Parquet file of the row groups of all parts, in their order, on a file system with positioned writes.

    The driver reads and writes footers alone, whose places are moved on; the pages are copied as they are by tasks, a stretch each.
    Page indexes and Bloom filters, which lie behind the row groups, are left out.
    """
    whole, at, stretches = None, len(MAGIC), []
    for part in parts:
        footer, end, shift = _footer(spark, part), len(MAGIC), at - len(MAGIC)
        for group in footer.getRow_groups():
            for column in group.getColumns():
                m = column.getMeta_data()
                first = m.getData_page_offset()
                m.setData_page_offset(first + shift)
                if m.isSetDictionary_page_offset() and m.getDictionary_page_offset():
                    first = min(first, m.getDictionary_page_offset())
                    m.setDictionary_page_offset(m.getDictionary_page_offset() + shift)
                end = max(end, first + m.getTotal_compressed_size())
                if column.getFile_offset():
                    column.setFile_offset(column.getFile_offset() + shift)
                for unset in (m.unsetIndex_page_offset, m.unsetBloom_filter_offset, m.unsetBloom_filter_length, column.unsetColumn_index_offset, column.unsetColumn_index_length, column.unsetOffset_index_offset, column.unsetOffset_index_length):
                    unset()
            if group.isSetFile_offset():
                group.setFile_offset(group.getFile_offset() + shift)
            group.unsetOrdinal()
        if whole is None:
            whole = footer
        else:
            whole.getRow_groups().addAll(footer.getRow_groups())
            whole.setNum_rows(whole.getNum_rows() + footer.getNum_rows())
        stretches += [(part, start, min(PART_BYTES, end - start), start + shift) for start in range(len(MAGIC), end, PART_BYTES)]
        at = end + shift
    out = spark._jvm.java.io.ByteArrayOutputStream()
    spark._jvm.org.apache.parquet.format.Util.writeFileMetaData(whole, out)
    tail = bytes(out.toByteArray())

    def run(batches):
        for rows in batches:
            for part, start, length, to in zip(rows["part"], rows["start"], rows["length"], rows["to"], strict=True):
                copy_stretch(part, target, start, length, to)
            yield rows[["to"]]

    given = spark.createDataFrame(stretches, "part string, start long, length long, to long")
    copied = given.repartitionByRange(len(stretches), "to").mapInPandas(run, "to long").count()
    if copied != len(stretches):
        raise RuntimeError(f"{copied} of {len(stretches)} stretches were copied")
    file = os.open(arrow_at(target)[1], os.O_CREAT | os.O_WRONLY)
    try:
        for data, to in ((MAGIC, 0), (tail + len(tail).to_bytes(4, "little") + MAGIC, at)):
            while data:
                done = os.pwrite(file, data, to)
                data, to = data[done:], to + done
        os.fsync(file)
    finally:
        os.close(file)
    return target


def _publish(files: Files, paths: list[str], folder: str, name) -> list[str]:
    """Rename paths into folder, PUBLISHERS at a time; on a failure those that have arrived are taken back."""
    made: list[str] = []

    def move(i: int) -> str:
        to = f"{folder}/{name(i)}"
        files.delete(to)
        files.rename(paths[i], to)
        made.append(to)
        return to

    with ThreadPoolExecutor(PUBLISHERS) as pool:
        moves = [pool.submit(move, i) for i in range(len(paths))]
    failed = next((e for m in moves if (e := m.exception())), None)
    if failed:
        for to in made:
            files.delete(to)
        raise failed
    return [m.result() for m in moves]


def lists_of(folder: str) -> str:
    """The folder with the lists of a folder's early chunks: a sub-folder for each write, into which every finished task commits its own."""
    return f"{folder.rstrip('/')}/_handover"


def handed_over(spark: SparkSession, folder: str) -> DataFrame:
    """name, rows, bytes of the early chunks in folder that count so far."""
    at = lists_of(folder)
    return spark.read.schema(CHUNK).json(at) if Files(spark).exists(at) else spark.createDataFrame([], CHUNK)


def _write_chunks(df: DataFrame, files: Files, folder: str, prefix: str, compression: str, cap: int, early: bool) -> tuple[int, list[str]]:
    target = folder if early else f"{folder}/_staging-{uuid.uuid4().hex}"
    files.mkdirs(target)
    if not arrow_knows(target):
        try:
            rows, paths = _spark_chunks(df, files, f"{folder}/_staging-{uuid.uuid4().hex}", compression, cap)
            made = _publish(files, paths, folder, lambda i: file_name(prefix, compression, i + 1))
            if early:
                _hand_over(df.sparkSession, made, f"{lists_of(folder)}/run={uuid.uuid4().hex}")
            return rows, made
        finally:
            if not early:
                files.delete(target)
    run = uuid.uuid4().hex[:12]
    gate = f"{folder}/_early-{run}" if early else None
    chunks = df.mapInArrow(_rolling(target, f"{prefix}.{run}" if early else prefix, compression, cap, gate), CHUNK)
    if not early:
        try:
            found = chunks.collect()  # of each task the attempt that Spark counts; a row per chunk
            paths = sorted(f"{target}/{r['name']}" for r in found)
            return sum(r["rows"] for r in found), _publish(files, paths, folder, lambda i: file_name(prefix, compression, i + 1))
        finally:
            files.delete(target)
    lists = f"{lists_of(folder)}/run={run}"
    counts: set[str] = set()
    files.mkdirs(gate)
    files.write_text(f"{gate}/{OPEN}", "")
    try:
        # version 2: a task's list shows when the driver has let that attempt commit, not when all tasks are done
        chunks.write.option("mapreduce.fileoutputcommitter.algorithm.version", "2").json(lists)
        found = df.sparkSession.read.schema(CHUNK).json(lists).collect()
        counts = {r["name"] for r in found}
        return sum(r["rows"] for r in found), [f"{folder}/{name}" for name in sorted(counts)]
    except Exception:
        files.delete(lists)
        raise
    finally:
        # other tasks, and attempts that Spark has given up, may still run: what they publish from here on fails, what they have published is listed
        files.delete(f"{gate}/{OPEN}")
        for _ in range(10):  # a file may come while the folder goes
            if not files.exists(gate):
                break
            files.delete(gate)
        for path, _ in files.list(folder):
            name = path.rpartition("/")[2]
            if name.startswith(f"{prefix}.{run}.") and name not in counts:
                files.delete(path)


def _hand_over(spark: SparkSession, paths: list[str], lists: str) -> None:
    """List finished chunks, for a store on which they all count at once."""
    listed = spark.read.format("binaryFile").load(paths).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.lit(None).cast("long").alias("rows"), F.col("length").alias("bytes")) if paths else spark.createDataFrame([], CHUNK)
    listed.coalesce(1).write.json(lists)


def _spark_chunks(df: DataFrame, files: Files, staging: str, compression: str, cap: int) -> tuple[int, list[str]]:
    """Parquet files within cap, by Spark's writer: those over it are read and cut again, until all fit or hold one row."""
    out, seen = counted(df)
    spark, schema, done, turn = df.sparkSession, df.schema, [], 0
    write = lambda rows, most: rows.write.option("compression", CODECS[compression]).option("maxRecordsPerFile", most).parquet(f"{staging}/{turn}")
    write(out, 0)
    total = seen.get["rows"]
    while True:
        listed = files.list(f"{staging}/{turn}")
        over = {p: n for p, n in listed if n > cap}
        rows_of = {}
        if over:
            read = spark.read.schema(schema).parquet(*over)
            rows_of = dict(read.groupBy(F.col("_metadata.file_name")).count().collect())  # a row per file over the cap
        again = {p: n for p, n in over.items() if rows_of.get(p.rpartition("/")[2], 0) > 1}
        done += [p for p, _ in listed if p not in again]
        if not again:
            return total, done if total else []
        most = min(max(1, int(rows_of[p.rpartition("/")[2]] * cap / n * 0.8)) for p, n in again.items())
        turn += 1
        write(spark.read.schema(schema).parquet(*again), most)
