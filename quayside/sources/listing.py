"""File-tree listings, and many files to and from a table of contents."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quayside.sources.scan import naming_missing_path, as_paths, scan_bytes
from quayside.storage import HadoopFiles, parent_of, scratch_dir, shared_root

#: Of Spark's own parts, each some 30 small files, this many are read by a task.
_PARTS_A_TASK = 8
#: Of files that tasks have listed, this many are read by a task where there are very many.
_FILES_A_TASK = 1000
#: On average a task is given no more than this.
_TASK_BYTES = 128 << 20
#: A task that has listed so many names leaves the folders it has not come to yet to others.
_NAMES_A_TASK = 10_000
#: Content, of one file at least, that is handed over at a time.
_BATCH_BYTES = 16 << 20
_LISTED = "path string, kind string, modified long, length long"


def list_recursive(paths: DataFrame, prefix: str = "", column: str = "path") -> DataFrame:
    """Every path under ``prefix``, relative to it.

    The prefix is plain leading text: ``data`` also covers ``database/x``.  A
    non-empty prefix that covers nothing is an error.
    """
    lead = prefix.rstrip("/")
    path = F.col(column)
    if not lead:
        return paths.select(path.alias("name"))
    under = path.startswith(lead) & (F.length(path) > len(lead))
    rest = F.substring(path, len(lead) + 1, 2**31 - 1 - len(lead))
    listed = paths.where(under).select(F.regexp_replace(rest, "^/", "").alias("name"))
    if listed.isEmpty():
        raise FileNotFoundError(f"path not found: {prefix}")
    return listed


def list_children(paths: DataFrame, prefix: str = "", column: str = "path") -> DataFrame:
    """The distinct first path segments under ``prefix``."""
    listed = list_recursive(paths, prefix, column)
    return listed.select(F.substring_index("name", "/", 1).alias("name")).distinct()


def scan_blobs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Whole files as rows: path, modificationTime, length, content.

    The content is only read when it is selected.  Tasks list the folders, into a table, and open the files, so
    the driver holds none of them.  Globs, stores that tasks cannot open, and sessions that skip files with errors
    are left to Spark's reader, whose driver has all files.  Empty and hidden files are left out, as Spark does.
    """
    paths = as_paths(paths)
    skips = any(spark.conf.get(f"spark.sql.files.ignore{kind}Files") == "true" for kind in ("Missing", "Corrupt"))
    if skips or any(letter in path for path in paths for letter in "{}[]*?\\"):
        return _read_by_spark(spark, paths)
    files = HadoopFiles(spark)
    roots = list(dict.fromkeys(files.qualified(path) for path in paths))
    if not _open_to_tasks(spark, roots):
        return _read_by_spark(spark, paths)
    listed, count, size = _listed_by_tasks(spark, roots)
    fewest = max(count // _FILES_A_TASK, size // _TASK_BYTES, 4 * spark.sparkContext.defaultParallelism)
    return listed.repartition(max(1, min(count, fewest))).select(
        "path", F.timestamp_millis("modified").alias("modificationTime"), "length", _content(spark)("path").alias("content")
    )


def _read_by_spark(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Where there are very many small files, a task reads several of the scan's parts one after another; the
    start of a task takes longer than its files otherwise."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    blobs = naming_missing_path(paths, lambda: reader.load(paths))
    parts = blobs.select("path").rdd.getNumPartitions()
    fewest = max(-(-parts // _PARTS_A_TASK), scan_bytes(blobs) // _TASK_BYTES, 4 * spark.sparkContext.defaultParallelism)
    return blobs.coalesce(fewest) if fewest < parts else blobs


def _open_to_tasks(spark: SparkSession, roots: list[str]) -> bool:
    """Whether tasks can list and open what is below the roots by themselves, and share a table of it."""
    try:
        shared = HadoopFiles(spark).qualified(shared_root(spark))
    except RuntimeError:
        return False
    local = spark.sparkContext.master.startswith("local")
    for root in roots:
        if root.startswith("file:") and not local and not f"{root}/".startswith(f"{shared}/"):
            return False
    store_of = _store_of()
    try:
        for root in roots:
            store_of(root)
    except (ValueError, OSError, pa.ArrowException):
        return False
    return True


def _store_of() -> Callable[[str], tuple[fs.FileSystem, str]]:
    """A function for tasks: the store of a path, as listings show it, and the path in that store."""
    opened = {}

    def store_of(path: str) -> tuple[fs.FileSystem, str]:
        from pyarrow import fs

        scheme, _, rest = path.partition(":")
        authority, _, below = rest[2:].partition("/") if rest.startswith("//") else ("", "", rest.lstrip("/"))
        root = f"{scheme}://{authority}/"
        if root not in opened:
            opened[root] = fs.FileSystem.from_uri(root)
        store, top = opened[root]
        return store, f"{top.rstrip('/')}/{below}"

    return store_of


def _listed_by_tasks(spark: SparkSession, roots: list[str]) -> tuple[DataFrame, int, int]:
    """The files below the roots as a table (path, modified, length), how many they are, and their bytes.

    Tasks go down from the folders that they are given; the folders that they leave are the next level's.
    """
    stage, levels, files, size = scratch_dir(spark, "_listing"), [], 0, 0
    folders, wide = spark.createDataFrame([(root,) for root in roots], "path string"), len(roots)
    while wide:
        counts, kind = Observation(), F.col("kind")
        rows = folders.repartition(min(wide, 1024)).mapInArrow(_walk(), _LISTED)
        rows = rows.observe(
            counts,
            F.count_if(kind == "folder").alias("folders"),
            F.count_if(kind == "file").alias("files"),
            F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"),
            F.max(F.when(kind == "gone", F.col("path"))).alias("gone"),
        )
        levels.append(f"{stage}/{len(levels)}")
        rows.write.parquet(levels[-1])
        if counts.get["gone"] is not None:
            HadoopFiles(spark).delete(stage)
            raise FileNotFoundError(f"file not found: {counts.get['gone']}")
        wide, files, size = counts.get["folders"], files + counts.get["files"], size + counts.get["bytes"]
        folders = spark.read.schema(_LISTED).parquet(levels[-1]).where("kind = 'folder'").select("path")
    listed = spark.read.schema(_LISTED).parquet(*levels).where("kind = 'file'").select("path", "modified", "length")
    # Of several roots one may lie below another.
    return (listed.dropDuplicates(["path"]) if len(roots) > 1 else listed), files, size


def _walk() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Lists what is below paths: files, folders left to be listed, and paths that are not there."""
    store_of, most = _store_of(), _NAMES_A_TASK

    def left_out(name: str, folder: bool) -> bool:
        # Spark's rule, by which files (and only they) of Parquet's metadata are left out as well.
        odd = name.startswith(".") or name.startswith("_") and "=" not in name
        kept = name.startswith(("_metadata", "_common_metadata"))
        return (odd or name.endswith("._COPYING_")) and not kept or odd and not folder

    def entries(folder: str) -> Iterator[tuple[str, int | None, int | None]]:
        """Name, milliseconds, and length, which is None for folders."""
        import os

        from pyarrow import fs

        store, place = store_of(folder)
        if not isinstance(store, fs.LocalFileSystem):
            for info in store.get_file_info(fs.FileSelector(place)):
                below = info.type == fs.FileType.Directory
                yield info.base_name, (info.mtime_ns or 0) // 10**6, None if below else info.size or 0
            return
        # One by one: a folder may hold more names than there is memory for.
        with os.scandir(place) as found:
            for entry in found:
                try:
                    entry.name.encode()
                    if entry.is_dir():
                        yield entry.name, None, None
                    else:
                        status = entry.stat()
                        yield entry.name, status.st_mtime_ns // 10**6, status.st_size
                except (FileNotFoundError, UnicodeEncodeError):
                    continue  # gone meanwhile, a link to nothing, or a name that is no text

    def found(paths: Iterator[str]) -> Iterator[tuple[str, str, int | None, int | None]]:
        from pyarrow import fs

        seen = 0
        for path in paths:
            store, place = store_of(path)
            info = store.get_file_info(place)
            if info.type == fs.FileType.NotFound:
                yield path, "gone", None, None
                continue
            if info.type != fs.FileType.Directory:
                if info.size and not left_out(info.base_name, False):
                    yield path, "file", (info.mtime_ns or 0) // 10**6, info.size
                continue
            folders = [path]
            while folders:
                folder = folders.pop()
                for name, modified, length in entries(folder):
                    seen += 1
                    if left_out(name, length is None):
                        continue
                    at = f"{folder.rstrip('/')}/{name}"
                    if length:
                        yield at, "file", modified, length
                    elif length is None and seen < most:
                        folders.append(at)
                    elif length is None:
                        yield at, "folder", None, None
                if seen >= most:
                    yield from ((at, "folder", None, None) for at in folders)
                    folders = []

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from itertools import islice

        kinds = [("path", pa.string()), ("kind", pa.string()), ("modified", pa.int64()), ("length", pa.int64())]
        rows = found(path for batch in batches for path in batch.column(0).to_pylist())
        while some := list(islice(rows, 10_000)):
            columns = zip(zip(*some), kinds)
            yield pa.RecordBatch.from_pydict({name: pa.array(values, kind) for values, (name, kind) in columns})

    return walk


def _content(spark: SparkSession) -> Callable[[str], Column]:
    """A function of a column of paths: the files' content."""
    store_of, most = _store_of(), _BATCH_BYTES
    limit = int(spark.conf.get("spark.sql.sources.binaryFile.maxLength"))

    def content(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for paths in batches:
            held, size = [], 0
            for path in paths.to_pylist():
                store, place = store_of(path)
                with store.open_input_file(place) as file:
                    if file.size() > limit:
                        raise ValueError(f"{path}: {file.size()} bytes, of at most {limit}")
                    read = file.read()
                if held and size + len(read) > most:
                    yield pa.array(held, pa.binary())
                    held, size = [], 0
                held.append(read)
                size += len(read)
            yield pa.array(held, pa.binary())

    return F.arrow_udf(content, "binary")


def list_files(
    spark: SparkSession, root: str, prefix: str = "", recursive: bool = False
) -> DataFrame:
    """Listing of the files below a root directory."""
    files = scan_blobs(spark, root).select(F.col("path").alias("full"))
    base = HadoopFiles(spark).qualified(root).rstrip("/")
    relative = files.select(F.substring("full", len(base) + 2, 2**31 - 1).alias("path"))
    return list_recursive(relative, prefix) if recursive else list_children(relative, prefix)


def target_path(source: Column, destination: str) -> Column:
    """Copy target: a destination ending in ``/`` keeps the file's own name."""
    if destination.endswith("/"):
        return F.concat(F.lit(destination), F.substring_index(source, "/", -1))
    return F.lit(destination)


def ingest_blobs(
    spark: SparkSession, paths: str | Sequence[str], destination: str, output: str
) -> DataFrame:
    """Store many files as a Parquet table: target, length, modificationTime, content."""
    if not destination.endswith("/"):
        raise ValueError("destination of many files must end with '/'")
    blobs = scan_blobs(spark, paths).select(
        target_path(F.col("path"), destination).alias("target"),
        "length",
        "modificationTime",
        "content",
    )
    blobs.write.mode("append").parquet(output)
    return spark.read.parquet(output)


def extract_blobs(blobs: DataFrame, directory: str, prefix: str = "") -> tuple[int, int]:
    """Write a table of contents back to files below ``directory``.

    Only targets under ``prefix`` are written, named from there on.  Tasks write
    their own rows, each to a name of its own first, so a retried task only
    repeats its work.  Returns (files, bytes).
    """
    lead = prefix.rstrip("/")
    under = blobs.where(F.col("target").startswith(lead) & (F.length("target") > len(lead)))
    rest = F.substring("target", len(lead) + 1, 2**31 - 1 - len(lead))
    return _write_below(under.select(F.regexp_replace(rest, "^/+", "").alias("name"), "content"), directory)


def extract_blob(blobs: DataFrame, target: str, destination: str) -> str:
    """Write one stored file: into ``destination`` under its own name if that is a directory, else to that path.

    Returns the path written.  A target that is not stored is an error.
    """
    files = HadoopFiles(blobs.sparkSession)
    if destination.endswith("/") or files.is_dir(destination):
        directory, name = destination.rstrip("/") or "/", target.rstrip("/").rpartition("/")[2]
    else:
        directory, name = parent_of(destination), destination.rpartition("/")[2]
    if not name:
        raise ValueError(f"no file name in {target!r}")
    rows = blobs.where(F.col("target") == target).select(F.lit(name).alias("name"), "content")
    if _write_below(rows, directory)[0] == 0:
        raise FileNotFoundError(f"file not found: {target}")
    return f"{directory.rstrip('/')}/{name}"


def address_for_tasks(spark: SparkSession, path: str) -> str:
    """The path as the file systems that tasks open by themselves take it."""
    base = HadoopFiles(spark).qualified(path).rstrip("/")
    if base.startswith("file:"):
        if not spark.sparkContext.master.startswith("local") and not path.startswith(shared_root(spark)):
            raise ValueError(f"{path} is on each executor's own disk; name a shared folder")
        base = "file://" + base.removeprefix("file:").removeprefix("//")
    return base


def _write_below(rows: DataFrame, directory: str) -> tuple[int, int]:
    """Write (name, content) rows to files; returns how many, and their bytes."""
    base = address_for_tasks(rows.sparkSession, directory)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from uuid import uuid4

        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(base)
        # Some file systems do not rename onto a file.
        replaces = isinstance(files, fs.LocalFileSystem)
        made = set()
        for batch in batches:
            lengths = []
            for name, content in zip(batch["name"], batch["content"]):
                if ".." in name.as_py().split("/"):
                    raise ValueError(f"target outside the directory: {name}")
                place = f"{root}/{name.as_py()}"
                folder = place.rpartition("/")[0]
                if folder not in made:
                    files.create_dir(folder, recursive=True)
                    made.add(folder)
                part = f"{place}.{uuid4().hex}"
                with files.open_output_stream(part) as sink:
                    sink.write(content.as_buffer())
                if not replaces and files.get_file_info(place).type == fs.FileType.File:
                    files.delete_file(place)
                files.move(part, place)
                lengths.append(len(content.as_buffer()))
            yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["bytes"])

    done = rows.mapInArrow(write, "bytes long")
    files, size = done.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    return files, size
