"""Export sinks: a table or query result to CSV, Parquet or JSON, whole or split."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.naming import helper_name, parse_size, quote_identifier, split_base, split_file_path
from quayside.operators import numbering
from quayside.operators.numbering import broadcast_if_small, discard, number_rows, position_rows, write_and_read
from quayside.operators.split import (
    FILE_ID,
    SplitLimits,
    assign_files,
    csv_header_bytes,
    csv_line_bytes,
    place_files,
    place_runs,
    plain_row_bytes,
)
from quayside.sources.dialect import TIME_TEXT, CsvDialect
from quayside.sources.listing import address_for_tasks
from quayside.sources.scan import has_file_positions, scan_source, with_typed_nulls
from quayside.storage import HadoopFiles, parent_of, require_parent, scratch_dir

# The codecs a Parquet export accepts, with Spark's name for each.
PARQUET_CODECS = {
    "snappy": "snappy",
    "gzip": "gzip",
    "lz4": "lz4_raw",
    "zstd": "zstd",
    "none": "uncompressed",
}
DEFAULT_CODEC = "snappy"
#: Share of a Parquet size limit that is planned for; the rest absorbs the dictionary pages and footers
#: that smaller files repeat.  Files that are over the limit all the same are cut again.
PARQUET_FILL = 0.85


#: Output files that a task names at about.
_FILES_A_TASK = 500
#: Bytes copied at a time where parts of a file are put together.
_COPIED_BYTES = 4 << 20

_NAME, _INDEX, _OLD, _ROWS, _PIECES, _PIECE = (
    helper_name(n) for n in ("name", "index", "old", "rows", "pieces", "piece")
)


class OutputFile(NamedTuple):
    """A written file; ``rows`` is known for exact splits."""

    path: str
    bytes: int
    rows: int | None = None


class ExportResult:
    """What an export wrote: the number of data rows, and the files in row order.

    The files of a split lie in a manifest table below ``spark.checkpoint.dir``, which stays until
    ``drop_manifest``; ``files`` and ``paths`` fetch them.
    """

    def __init__(self, rows: int, files: Sequence[OutputFile] | DataFrame, num_files: int | None = None):
        self.rows, self._files = rows, files
        self.num_files = len(files) if num_files is None else num_files

    @property
    def files(self) -> tuple[OutputFile, ...]:
        if isinstance(self._files, DataFrame):
            found = self._files.orderBy("file_id").toLocalIterator()
            return tuple(OutputFile(row.path, row.bytes, row.rows) for row in found)
        return tuple(self._files)

    @property
    def paths(self) -> list[str]:
        return [file.path for file in self.files]

    def manifest(self, spark: SparkSession) -> DataFrame:
        """One row per file: file_id, file_name, path, bytes, rows (where counted)."""
        if isinstance(self._files, DataFrame):
            return self._files.select("file_id", F.substring_index("path", "/", -1).alias("file_name"), "path", "bytes", "rows")
        rows = [
            (index, file.path.rpartition("/")[2], file.path, file.bytes, file.rows)
            for index, file in enumerate(self._files)
        ]
        return spark.createDataFrame(
            rows, "file_id long, file_name string, path string, bytes long, rows long"
        )

    def drop_manifest(self, spark: SparkSession) -> None:
        if isinstance(self._files, DataFrame):
            discard(spark, [parent_of(self._files.inputFiles()[0])])


def parquet_codec(name: str | None) -> str:
    codec = (name or DEFAULT_CODEC).lower()
    if codec not in PARQUET_CODECS:
        raise ValueError(
            f"unknown compression '{name}'; supported: {', '.join(PARQUET_CODECS)}"
        )
    return PARQUET_CODECS[codec]


def export(
    spark: SparkSession,
    output: str,
    format: str,
    *,
    table: str | None = None,
    query: str | None = None,
    dialect: CsvDialect | None = None,
    compression: str | None = None,
    max_rows_per_file: int | None = None,
    max_file_size: str | int | None = None,
    order_by: Sequence[str | Column] = (),
    exact: bool = True,
    as_directory: bool = False,
) -> ExportResult:
    """Export a table or a query result.

    Without a split limit the rows are written in parallel to a directory at
    ``output``.  With one, they are written to ``<stem>_000<ext>``,
    ``<stem>_001<ext>``, ... or, if a single file is enough, to ``output``
    itself.  Rows are cut in the order of ``order_by``, by default in the order
    they are stored.  ``exact=False`` takes ``max_rows_per_file`` as an upper
    bound only and writes in one pass.  ``as_directory=True`` keeps split files
    below ``output`` instead of renaming them, for stores where renaming copies.
    """
    format = format.lower()
    if format not in ("csv", "parquet"):
        raise ValueError(f"unsupported export format: '{format}'; supported: csv, parquet")
    if format == "csv" and compression is not None:
        raise ValueError("compression is only supported for Parquet format")
    dialect = dialect or CsvDialect()
    codec = parquet_codec(compression)
    size = parse_size(max_file_size) if isinstance(max_file_size, str) else max_file_size
    limits = SplitLimits(max_rows_per_file, size)
    source = with_typed_nulls(scan_source(spark, table, query))
    if format == "csv":
        _reject_nested(source)
    require_parent(HadoopFiles(spark), output)
    sink = _Sink(output, format, dialect, codec)
    if not limits.active:
        return _export_whole(source, sink)
    if not exact:
        return _export_bounded(source, sink, limits, as_directory)
    in_files = table is not None and has_file_positions(spark, table)
    return _export_split(source, in_files, sink, limits, order_by, as_directory)


def _reject_nested(source: DataFrame) -> None:
    nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)
    names = [f.name for f in source.schema.fields if isinstance(f.dataType, nested)]
    if names:
        raise ValueError(f"columns cannot be written as CSV: {', '.join(names)}")


def export_json(frame: DataFrame, output: str) -> ExportResult:
    """Write one JSON object per row, keyed by column name; NULL keys are left out."""
    counted, count = _counted(frame)
    counted.write.options(**TIME_TEXT).mode("overwrite").json(output)
    return ExportResult(count(), tuple(_part_files(frame.sparkSession, output)))


@dataclass(frozen=True)
class _Sink:
    output: str
    format: str
    dialect: CsvDialect
    codec: str

    def writer(self, frame: DataFrame):
        if self.format == "csv":
            names = [name for name in frame.columns if name != FILE_ID]
            lines = self.dialect.line_columns(frame.select(*map(quote_identifier, names)).schema)
            frame = frame.select(*lines, *[c for c in frame.columns if c == FILE_ID])
            return frame.write.format("csv").options(**self.dialect.write_options())
        return frame.write.format("parquet").option("compression", self.codec)


def _counted(frame: DataFrame):
    """Count rows while they are written, in the same job."""
    observation = Observation()
    counted = frame.observe(observation, F.count(F.lit(1)).alias("rows"))
    return counted, lambda: observation.get["rows"]


def _part_files(spark: SparkSession, directory: str) -> list[OutputFile]:
    return [OutputFile(*found) for found in HadoopFiles(spark).glob(f"{directory}/part-*")]


def _export_whole(source: DataFrame, sink: _Sink) -> ExportResult:
    counted, count = _counted(source)
    sink.writer(counted).mode("overwrite").save(sink.output)
    return ExportResult(count(), tuple(_part_files(source.sparkSession, sink.output)))


def _export_bounded(
    source: DataFrame, sink: _Sink, limits: SplitLimits, as_directory: bool
) -> ExportResult:
    if limits.max_rows is None or limits.max_bytes is not None:
        raise ValueError("exact=False supports max_rows_per_file only")
    spark = source.sparkSession
    with _delivery(spark, sink.output, as_directory) as delivery:
        counted, count = _counted(source)
        writer = sink.writer(counted).option("maxRecordsPerFile", limits.max_rows)
        writer.mode("overwrite").save(delivery.folder)
        return ExportResult(count(), delivery.publish(_part_files(spark, delivery.folder)))


def _export_split(
    source: DataFrame,
    in_files: bool,
    sink: _Sink,
    limits: SplitLimits,
    order_by: Sequence[str | Column],
    as_directory: bool,
) -> ExportResult:
    spark = source.sparkSession
    weight, header = None, 0
    if limits.max_bytes is not None:
        if sink.format == "csv":
            header = csv_header_bytes(spark, source.schema, sink.dialect)
            if limits.max_bytes <= header:
                raise ValueError(f"max_file_size must exceed the header line ({header} bytes)")
            weight = csv_line_bytes(source.schema, sink.dialect)
        else:
            weight = plain_row_bytes(source.schema)
    manifest = scratch_dir(spark, "manifest")
    with _delivery(spark, sink.output, as_directory) as delivery:
        scratch = delivery.scratch
        positioned = position_rows(source, in_files, scratch, order_by, weight, sink.codec)
        numbered = number_rows(positioned, f"{scratch}/offsets")
        if numbered.rows == 0:
            # Not partitioned by file: an empty write still leaves one file with the schema.
            empty = sink.writer(source.limit(0).coalesce(1))
            empty.mode("overwrite").save(delivery.folder)
            files = [file._replace(rows=0) for file in _part_files(spark, delivery.folder)]
            return ExportResult(0, delivery.publish(files))
        room = None
        if limits.max_bytes is not None:
            room = limits.max_bytes - header
            if sink.format == "parquet":
                # The staged rows tell how far encoding shrinks this data.
                scale = numbered.weight / max(numbered.file_bytes, 1)
                room = max(1, int(limits.max_bytes * PARQUET_FILL * scale))
        assigned = assign_files(numbered, limits, room, f"{scratch}/chain")
        # Files much larger than a task's share are written in parts, where those can be put together in place.
        runs = math.ceil(numbered.file_bytes / numbering.TASK_BYTES)
        in_parts = sink.format == "csv" and runs >= 2 * assigned.files and _writes_in_place(spark, delivery.folder)
        placed = place_runs(assigned, numbered.rows, runs) if in_parts else place_files(assigned, numbered.file_bytes)
        counted, count = _counted(placed)
        writer = sink.writer(counted).option("maxRecordsPerFile", 0)
        writer.partitionBy(FILE_ID).mode("overwrite").save(delivery.folder)
        changed = RuntimeError(f"incomplete export to {sink.output}; the source has changed")
        if count() != numbered.rows:
            raise changed
        if sink.format == "parquet" and limits.max_bytes is not None:
            files = _numbered_files(spark, delivery.folder, assigned.counts)
            if len(files) != assigned.files:
                raise changed
            files = _cut_until_small(spark, files, source.schema, limits.max_bytes, sink, delivery)
            return ExportResult(numbered.rows, delivery.publish(files))
        if in_parts:
            _join_parts(spark, delivery.folder, csv_header_bytes(spark, source.schema, sink.dialect))
        placed = _published(delivery, assigned.files)
        # As long as a file is missing, its task fails.
        named = placed.join(assigned.counts, "file_id").select("file_id", "path", "bytes", "rows")
        return ExportResult(numbered.rows, write_and_read(named, manifest), assigned.files)


def _numbered_files(spark: SparkSession, directory: str, counts: DataFrame) -> list[OutputFile]:
    """The one file of each FILE_ID, in order."""
    numbered, rows_of = {}, {row.file_id: row.rows for row in counts.collect()}
    for path, size in HadoopFiles(spark).walk(directory):
        part = re.search(rf"/{FILE_ID}=(\d+)/part-[^/]+$", path)
        if part:
            number = int(part[1])
            numbered[number] = OutputFile(path, size, rows_of[number])
    return [numbered[number] for number in sorted(numbered)]


def _writes_in_place(spark: SparkSession, folder: str) -> bool:
    """Whether tasks can write a file of a folder at any place."""
    try:
        return isinstance(fs.FileSystem.from_uri(address_for_tasks(spark, folder))[0], fs.LocalFileSystem)
    except (ValueError, OSError, pa.ArrowException):
        return False


def _join_parts(spark: SparkSession, directory: str, header: int) -> None:
    """Make one file of the parts in each FILE_ID's folder; every part is copied to its place by a task.

    All parts begin with the header line of so many bytes, of which the first one's stays.  A task that is
    run again writes the same bytes to the same place.
    """
    store, found = HadoopFiles(spark), {}
    for path, size in store.walk(directory):
        part = re.search(rf"/{FILE_ID}=(\d+)/part-(\d+)-[^/]+$", path)
        if part:
            found.setdefault(int(part[1]), []).append((int(part[2]), path, size))
    moves, sizes = [], {}
    root = fs.FileSystem.from_uri(address_for_tasks(spark, directory))[1]
    for number, parts in found.items():
        if len(parts) == 1:
            continue
        parts.sort()
        at, place = 0, f"{FILE_ID}={number}/part-joined-{uuid.uuid4().hex}"
        for order, (_, path, size) in enumerate(parts):
            skipped = header if order else 0
            moves.append((f"{root}/{FILE_ID}={number}/{path.rpartition('/')[2]}", skipped, f"{root}/{place}", at))
            at += size - skipped
        sizes[f"{directory}/{place}"] = at
    if not moves:
        return

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        for batch in batches:
            for row in batch.to_pylist():
                with open(row["part"], "rb") as source:
                    source.seek(row["skipped"])
                    sink = os.open(row["place"], os.O_WRONLY | os.O_CREAT, 0o644)
                    with os.fdopen(sink, "wb", buffering=0) as target:
                        target.seek(row["at"])
                        while block := source.read(_COPIED_BYTES):
                            left = memoryview(block)
                            while left:
                                left = left[target.write(left) :]
            yield pa.RecordBatch.from_pydict({"done": pa.array([batch.num_rows], pa.int64())})

    table = spark.createDataFrame(spark.sparkContext.parallelize(moves, len(moves)), "part string, skipped long, place string, at long")
    done = table.mapInArrow(copy, "done long").agg(F.sum("done")).first()[0]
    made = {path.rpartition("/")[2]: size for path, size in store.walk(directory) if "/part-joined-" in path}
    if done != len(moves) or any(made.get(path.rpartition("/")[2]) != size for path, size in sizes.items()):
        raise RuntimeError(f"incomplete parts in {directory}")
    # With their checksums, which some local file systems keep beside a file.
    for parts in found.values():
        for _, path, _ in parts if len(parts) > 1 else []:
            store.delete(path)


def _published(delivery: _Delivery, count: int) -> DataFrame:
    """``file_id, path, bytes``, to be written once: each file is found in its own folder and named by a task.

    A task lists and renames the files of its numbers, so neither listings nor names pass through the
    driver.  It may be run again: what has its name already is left alone.
    """
    spark, keep = delivery.spark, delivery.folder == delivery.output
    store = HadoopFiles(spark)
    tasks = max(1, min(count // _FILES_A_TASK + 1, 4096))
    numbers = spark.range(0, count, 1, tasks).select(F.col("id").alias("file_id"))
    try:
        folder, target = (address_for_tasks(spark, path) for path in (delivery.folder, parent_of(delivery.output)))
        fs.FileSystem.from_uri(folder)
    except (ValueError, OSError, pa.ArrowException):
        # A store that only the JVM can open.
        files = _numbered_files(spark, delivery.folder, numbers.withColumn("rows", F.lit(0)))
        rows = [(n, file.path, file.bytes) for n, file in enumerate(delivery.publish(files))]
        return spark.createDataFrame(rows, "file_id long, path string, bytes long")
    directory, stem, extension = split_base(delivery.output)
    place, shown = f"{FILE_ID}=", store.qualified(delivery.folder) if keep else directory
    plain = delivery.output.rpartition("/")[2] if count == 1 else None

    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        _, above = files.from_uri(target)
        for batch in batches:
            paths, sizes = [], []
            for number in batch.column(0).to_pylist():
                own = fs.FileSelector(f"{root}/{place}{number}", allow_not_found=True)
                parts = [f for f in files.get_file_info(own) if f.base_name.startswith("part-")]
                name = plain or f"{stem}_{number:03d}{extension}"
                if keep:
                    (part,) = parts
                    paths.append(f"{shown}/{place}{number}/{part.base_name}")
                    sizes.append(part.size)
                    continue
                there = files.get_file_info(f"{above}/{name}")
                if parts:
                    if there.type == fs.FileType.Directory:
                        raise IsADirectoryError(f"output path is a directory: {shown}{name}")
                    # With its checksum, which some local file systems keep beside a file.
                    for old in (there, files.get_file_info(f"{above}/.{name}.crc")):
                        if old.type == fs.FileType.File:
                            files.delete_file(old.path)
                    (part,) = parts
                    files.move(part.path, there.path)
                    sizes.append(part.size)
                elif there.type == fs.FileType.File:
                    sizes.append(there.size)
                else:
                    raise FileNotFoundError(f"no output file with number {number}; the source has changed")
                paths.append(f"{shown}{name}")
            yield pa.RecordBatch.from_pydict(
                {"file_id": batch.column(0), "path": pa.array(paths, pa.string()), "bytes": pa.array(sizes, pa.int64())}
            )

    return numbers.mapInArrow(publish, "file_id long, path string, bytes long")


def _folder_and_name(path: Column) -> Column:
    return F.substring_index(path, "/", -2).alias(_NAME)


def _cut_until_small(
    spark: SparkSession, files: list[OutputFile], schema: T.StructType, limit: int, sink: _Sink, delivery: _Delivery
) -> list[OutputFile]:
    """The files in order, those over the limit written again in pieces until none is over it.

    Sizes are known only once they are written.  Only the files over the limit are read again, all in one
    job, and each is cut into equal runs of rows, at least two; a single row cannot be cut.
    """
    store, turn = HadoopFiles(spark), 0
    while over := [n for n, file in enumerate(files) if file.bytes > limit and file.rows > 1]:
        pieces = [(n, files[n].path, files[n].rows, min(files[n].rows, max(2, math.ceil(1.1 * files[n].bytes / limit)))) for n in over]
        table = spark.createDataFrame(pieces, "n long, path string, rows long, pieces long")
        read = spark.read.schema(schema).parquet(*(path for _, path, _, _ in pieces))
        named = read.select("*", _folder_and_name(F.col("_metadata.file_path")), F.col("_metadata.row_index").alias(_INDEX))
        table = table.select("n", _folder_and_name(F.col("path")), "rows", "pieces")
        table = table.toDF(_OLD, _NAME, _ROWS, _PIECES)
        piece = F.expr(f"`{_INDEX}` * `{_PIECES}` div `{_ROWS}`")
        # No two pieces of a file have one number, and a file has at most as many as rows.
        cut = named.join(broadcast_if_small(table, len(pieces), 200), _NAME).withColumn(_PIECE, piece)
        placed = cut.repartition(max(1, min(len(pieces) * 2, 4096)), _OLD, _PIECE).sortWithinPartitions(_OLD, _PIECE, _INDEX)
        folder = f"{delivery.scratch}/pieces_{turn}"
        rows = placed.select(*map(quote_identifier, schema.names), _OLD, _PIECE)
        writer = rows.write.format("parquet").option("compression", sink.codec).option("maxRecordsPerFile", 0)
        writer.partitionBy(_OLD, _PIECE).save(folder)
        made: dict[int, list[tuple[int, str, int]]] = {}
        for path, size in store.walk(folder):
            part = re.search(rf"/{_OLD}=(\d+)/{_PIECE}=(\d+)/part-[^/]+$", path)
            if part:
                made.setdefault(int(part[1]), []).append((int(part[2]), path, size))
        result: list[OutputFile] = []
        for n, file in enumerate(files):
            if n not in made:
                result.append(file)
                continue
            count = min(file.rows, max(2, math.ceil(1.1 * file.bytes / limit)))
            for number, path, size in sorted(made[n]):
                # Rows whose index times the count, divided by the rows, is this number.
                first, last = -(-number * file.rows // count), -(-(number + 1) * file.rows // count)
                # A task gives its files of all pieces one name.
                name = path.rpartition("/")[2].replace("part-", f"part-{turn}-{n}-{number}-", 1)
                place = f"{file.path.rpartition('/')[0]}/{name}"
                store.replace(path, place)
                result.append(OutputFile(place, size, last - first))
            store.delete(file.path)
        files, turn = result, turn + 1
    return files


@dataclass(frozen=True)
class _Delivery:
    """Where an export is written before its files get their names."""

    spark: SparkSession
    output: str
    scratch: str
    folder: str

    def publish(self, files: list[OutputFile]) -> tuple[OutputFile, ...]:
        """Give written files their numbered names, or the plain name to a single one."""
        if self.folder == self.output:
            return tuple(files)
        if len(files) == 1:
            names = [self.output]
        else:
            names = [split_file_path(self.output, index) for index in range(len(files))]
        HadoopFiles(self.spark).replace_all(
            [(file.path, name) for file, name in zip(files, names)]
        )
        return tuple(file._replace(path=name) for file, name in zip(files, names))


@contextmanager
def _delivery(spark: SparkSession, output: str, as_directory: bool) -> Iterator[_Delivery]:
    """Folders for one export; what is left in them goes away, also after a failure."""
    scratch = scratch_dir(spark, "export")
    folder = output if as_directory else _staging_beside(output)
    try:
        yield _Delivery(spark, output, scratch, folder)
    finally:
        discard(spark, [scratch] if as_directory else [scratch, folder])


def _staging_beside(output: str) -> str:
    """A hidden folder next to the output, so that renaming stays in one file system."""
    directory, _, name = output.rpartition("/")
    return f"{directory or '.'}/.{name}.{uuid.uuid4().hex}"
