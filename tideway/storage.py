"""Scratch folders and small file-system steps, through Hadoop's file systems so that any store works."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_mode(spark: SparkSession) -> bool:
    """Whether driver and tasks are one process; local-cluster masters have executors of their own."""
    return bool(re.match(r"local(\[|$)", spark.sparkContext.master))


def shared_dir(spark: SparkSession) -> str:
    """The folder for intermediate tables that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a temporary folder in local mode, and one in the warehouse on a cluster, which must not be a local folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not local_mode(spark):
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        if Files(spark).qualified(warehouse).startswith("file:"):
            raise ValueError(f"on a cluster set spark.checkpoint.dir to a folder that driver and executors share: the warehouse is the local {warehouse}")
        return warehouse + "/_scratch"
    if spark.sparkContext.applicationId not in _own:
        _own[spark.sparkContext.applicationId] = root = tempfile.mkdtemp(prefix="spark-scratch-", dir="/tmp")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return _own[spark.sparkContext.applicationId]


_own: dict[str, str] = {}


def scratch(spark: SparkSession, name: str = "scratch") -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


class Files:
    """The few file steps that commits need."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def is_dir(self, path: str) -> bool:
        return self.exists(path) and self._fs(path).getFileStatus(self._path(path)).isDirectory()

    def mkdirs(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def list(self, path: str) -> list[tuple[str, int]]:
        """(path, bytes) of the files right under path, hidden ones left out, by name."""
        found = [(s.getPath().toString(), s.getLen()) for s in self._fs(path).listStatus(self._path(path)) if s.isFile()]
        return sorted(f for f in found if not f[0].rpartition("/")[2].startswith(("_", ".")))

    def count(self, path: str) -> int:
        """How many entries are right under path, hidden ones too."""
        return len(self._fs(path).listStatus(self._path(path)))

    def total(self, path: str) -> int:
        """Bytes of all that is under path."""
        return self._fs(path).getContentSummary(self._path(path)).getLength()

    def size(self, path: str) -> int:
        return self._fs(path).getFileStatus(self._path(path)).getLen()

    def folders(self, path: str) -> list[str]:
        """Names of the folders right under path, hidden ones left out but for those of partitions."""
        found = [s.getPath().getName() for s in self._fs(path).listStatus(self._path(path)) if s.isDirectory()]
        return sorted(f for f in found if not f.startswith((".", "_")) or "=" in f)

    def rename(self, old: str, new: str) -> None:
        if not self._fs(old).rename(self._path(old), self._path(new)):
            raise OSError(f"cannot rename {old} to {new}")

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    def read_text(self, path: str) -> str:
        stream = self._fs(path).open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        stream = self._fs(path).create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> bool:
        """Make a file with text in one step, if there is none of that name: whether it was made.

        On a local store by a hard link; elsewhere by a rename that fails on an existing name, as on HDFS.
        On an object store this needs a connector with conditional renames.
        """
        beside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        self.write_text(beside, text)
        try:
            if self.qualified(path).startswith("file:"):
                local = lambda p: self._fs(p).makeQualified(self._path(p)).toUri().getPath()
                try:
                    os.link(local(beside), local(path))
                except FileExistsError:
                    return False
                return True
            return bool(self._fs(path).rename(self._path(beside), self._path(path)))
        finally:
            self.delete(beside)

    def qualified(self, path: str) -> str:
        """path with its scheme: one without belongs to the default file system, also for those that read it elsewhere."""
        return self._fs(path).makeQualified(self._path(path)).toString()


def arrow_at(path: str):
    """(pyarrow's file system, path in it) of a qualified path."""
    from pyarrow import fs

    scheme = re.match(r"([A-Za-z][A-Za-z0-9+.-]*):", path)
    if scheme and scheme[1] != "file":
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), re.sub(r"^file:(//)?", "", path)


def arrow_knows(path: str) -> bool:
    """Whether pyarrow can open the store of a qualified path here. Spark's own names, such as s3a or wasbs, are not among its schemes."""
    try:
        arrow_at(path)
        return True
    except (ValueError, OSError, ImportError):  # no such scheme, no native library of the store, or not built in
        return False


class Versions:
    """Numbered small files in a folder: a commit makes the next number, and fails where another writer has made it."""

    def __init__(self, spark: SparkSession, folder: str):
        self.folder, self.files = folder.rstrip("/"), Files(spark)

    def _names(self) -> list[str]:
        return [p for p, _ in self.files.list(self.folder)] if self.files.exists(self.folder) else []

    def last(self) -> tuple[int, str | None]:
        """Number and text of the last version; (0, None) where there is none."""
        names = self._names()
        return (int(names[-1].rpartition("/")[2].removesuffix(".json")), self.files.read_text(names[-1])) if names else (0, None)

    def commit(self, number: int, text: str) -> bool:
        self.files.mkdirs(self.folder)
        return self.files.create_text(f"{self.folder}/{number:012d}.json", text)

    def trim(self) -> None:
        for name in self._names()[:-1]:
            self.files.delete(name)
