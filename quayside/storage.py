"""Shared scratch space and the few Hadoop file-system calls the sinks need.

Everything staged between two jobs goes to the folder that the cluster names in
``spark.checkpoint.dir``, so every executor can read it and a lost executor
costs a retry, not the data.  A folder is made up only for a local session that
has none configured.
"""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession

_RENAME_THREADS = 16


def shared_root(spark: SparkSession) -> str:
    """The shared staging root of this session."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="quayside-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing directory name below the shared root."""
    return f"{shared_root(spark)}/quayside/{label}-{uuid.uuid4().hex}"


class HadoopFiles:
    """Metadata operations (exists, list, rename, delete) on one session's file systems."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsparkSession.sessionState().newHadoopConf()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def qualified(self, path: str) -> str:
        """The path with its scheme and store, as listings show it."""
        return self._fs(path).makeQualified(self._path(path)).toString()

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def is_dir(self, path: str) -> bool:
        return self.exists(path) and self._fs(path).getFileStatus(self._path(path)).isDirectory()

    def glob(self, pattern: str) -> list[tuple[str, int]]:
        """(path, length) of every match, sorted by path."""
        found = self._fs(pattern).globStatus(self._path(pattern)) or []
        return sorted((s.getPath().toString(), s.getLen()) for s in found)

    def walk(self, directory: str) -> Iterator[tuple[str, int]]:
        """(path, length) of every file below a directory, in one listing where stores allow."""
        status = self._fs(directory).listFiles(self._path(directory), True)
        while status.hasNext():
            file = status.next()
            yield file.getPath().toString(), file.getLen()

    def make_dirs(self, path: str) -> None:
        self._fs(path).mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)

    def of_uri(self, uri: str) -> str:
        """The path that an encoded address, as rows' metadata has it, stands for, with its scheme and store."""
        path = self._jvm.org.apache.hadoop.fs.Path(self._jvm.java.net.URI(uri))
        return path.getFileSystem(self._conf).makeQualified(path).toString()

    def to_uri(self, path: str) -> str:
        """The encoded address of a path, as scans' metadata has it."""
        uri = self._path(path).toUri().toString()
        return "file://" + uri.removeprefix("file:") if re.match("file:/[^/]", uri) else uri

    def move(self, source: str, target: str) -> bool:
        """Rename a file into a folder, which is made if need be; false if the file is not there any more."""
        fs = self._fs(source)
        self.make_dirs(parent_of(target))
        return fs.exists(self._path(source)) and fs.rename(self._path(source), self._path(target))

    def replace(self, source: str, target: str) -> None:
        """Rename a file, replacing a file (never a directory) at the target."""
        fs = self._fs(target)
        destination = self._path(target)
        if fs.exists(destination):
            if fs.getFileStatus(destination).isDirectory():
                raise IsADirectoryError(f"output path is a directory: {target}")
            fs.delete(destination, False)
        if not fs.rename(self._path(source), destination):
            raise OSError(f"could not write output file: {target}")

    def replace_all(self, moves: list[tuple[str, str]]) -> None:
        with ThreadPoolExecutor(_RENAME_THREADS) as pool:
            list(pool.map(lambda move: self.replace(*move), moves))


def parent_of(path: str) -> str:
    head, _, _ = path.rstrip("/").rpartition("/")
    return head or ("/" if path.startswith("/") else ".")


def require_parent(files: HadoopFiles, output: str) -> None:
    """An export into a folder that does not exist is an error naming the output."""
    if not files.is_dir(parent_of(output)):
        raise FileNotFoundError(f"cannot write {output}: its directory does not exist")
