"""File and table scans: Parquet, CSV in any dialect, many paths, tables, queries."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import replace
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.naming import detect_format, quote_identifier, table_identifier
from quayside.sources import records
from quayside.sources.dialect import CsvDialect
from quayside.storage import HadoopFiles

_RECORD = "__record"
_FILE = "__file"
#: Bytes of a file that are read for its first line at a time.
_FIRST_BYTES = 1 << 16


def as_paths(paths: str | Sequence[str]) -> list[str]:
    found = [paths] if isinstance(paths, str) else list(paths)
    if not found:
        raise ValueError("at least one input path is required")
    return found


def common_format(paths: list[str]) -> str:
    """The format of all the input files, by extension."""
    formats = {detect_format(path) for path in paths}
    if len(formats) > 1:
        raise ValueError("all input files must have the same format")
    return formats.pop()


def naming_missing_path(paths: list[str], load):
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"file not found: {error.getMessage()}") from error
        raise


def scan_parquet(
    spark: SparkSession, paths: str | Sequence[str], lineage: str | None = None
) -> DataFrame:
    """Parquet files, directories or globs as one DataFrame.

    ``lineage`` adds a column of that name with each row's source file name.
    """
    paths = as_paths(paths)
    frame = naming_missing_path(paths, lambda: spark.read.parquet(*paths))
    return _with_lineage(frame, lineage)


def scan_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    dialect: CsvDialect | None = None,
    schema: T.StructType | None = None,
    lineage: str | None = None,
    align_headers: bool = False,
) -> DataFrame:
    """CSV files in one dialect; without ``schema`` the column types are inferred.

    Headers are checked against the schema by position.  Files that carry the
    same columns in different orders need ``align_headers=True``: files are read
    per distinct header and joined by column name.
    """
    from quayside.sources.infer import infer_csv_schema

    paths, dialect = as_paths(paths), dialect or CsvDialect()
    if align_headers and dialect.header:
        dialect = settle_line_breaks(spark, paths, dialect)
        groups = _files_by_header(spark, paths)
        if len(groups) > 1:
            return _scan_groups(spark, groups, dialect, schema, lineage)
    parts = by_line_breaks(spark, paths, dialect)
    if schema is None:
        schema = infer_csv_schema(spark, parts)
    frames = []
    for files, own, cut in parts:
        reader = spark.read.options(**own.read_options()).schema(schema)
        if cut is None:
            frames.append(_with_lineage(naming_missing_path(files, lambda: reader.csv(files)), lineage))
            continue
        for sample in cut.samples:
            # Holds the header against the schema.
            reader.csv(sample).first()
        frames.append(records.parsed(records.records(spark, cut.ranges, own), own, schema, lineage))
    return reduce(DataFrame.union, frames)


def _scan_groups(
    spark: SparkSession,
    groups: list[list[str]],
    dialect: CsvDialect,
    schema: T.StructType | None,
    lineage: str | None,
) -> DataFrame:
    """Files with several headers, each read in its own column order under the same types."""
    from quayside.sources.infer import NoDataRowsError, csv_columns, infer_csv_schema

    found: list[tuple[list[str], T.StructType]] = []
    for files in groups:
        try:
            look = csv_columns if schema is not None else infer_csv_schema
            found.append((files, look(spark, files, dialect)))
        except NoDataRowsError:
            continue
    if not found:
        raise NoDataRowsError("no data rows in any file")
    kinds: dict[str, T.DataType] = {}
    for field in [f for _, s in found for f in s.fields] if schema is None else schema.fields:
        name = field.name.lower()
        kinds[name] = common_type(kinds.get(name, field.dataType), field.dataType)
    parts = []
    for files, columns in found:
        unknown = [name for name in columns.names if name.lower() not in kinds]
        if unknown:
            raise ValueError(f"columns not in the schema: {', '.join(unknown)}")
        typed = T.StructType([T.StructField(n, kinds[n.lower()]) for n in columns.names])
        parts.append(scan_csv(spark, files, dialect, typed, lineage))
    frame = parts[0]
    for part in parts[1:]:
        frame = frame.unionByName(part)
    names = list(found[0][1].names if schema is None else schema.names)
    return frame.select(*map(quote_identifier, names + [lineage] * (lineage is not None)))


def common_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """A type that holds the text of both: theirs if equal, double for numbers, else text."""
    if one == other:
        return one
    numbers = isinstance(one, T.NumericType) and isinstance(other, T.NumericType)
    return T.DoubleType() if numbers else T.StringType()


class Part(NamedTuple):
    """Files that are read alike; large ones whose records end within ranges that are known are cut."""

    files: list[str]
    dialect: CsvDialect
    cut: records.Cut | None = None


Parts = list[Part]


def by_line_breaks(spark: SparkSession, paths: list[str], dialect: CsvDialect) -> Parts:
    """The files that can be split among tasks at every line, those that can at some, and the others,
    each with a settled dialect.

    The content of each file decides, whatever its size: a file of which every line is a whole record can
    be split.  A carriage return that ends no line belongs to a value, so such a file is not split at lines.
    """
    split, whole = _with_broken_lines(spark, paths, dialect)
    parts = [Part(split, replace(dialect, multi_line=False))] if split else []
    if not whole:
        return parts
    own = replace(dialect, multi_line=True)
    sizes = _large_files(spark, whole)
    cut = records.cut_by_records(spark, sizes, own)
    if not cut.ranges:
        return [*parts, Part(whole, own)]
    files = HadoopFiles(spark)
    cut = cut._replace(samples=[files.of_uri(uri) for uri in cut.samples])
    covered = {files.of_uri(uri) for uri in {part.address for part in cut.ranges}}
    listed = naming_missing_path(whole, lambda: spark.read.text(whole)).inputFiles()
    rest = sorted({files.of_uri(uri) for uri in listed} - covered)
    return [*parts, Part(sorted(covered), own, cut), *([Part(rest, own)] if rest else [])]


def _large_files(spark: SparkSession, paths: list[str]) -> dict[str, int]:
    """The sizes of the files that are too large for one task, by address."""
    listed = naming_missing_path(paths, lambda: spark.read.format("binaryFile").load(paths))
    large = listed.where(F.col("length") > records.WHOLE_BYTES).select("path", "length").collect()
    files = HadoopFiles(spark)
    return {files.to_uri(row.path): row.length for row in large}


def _with_broken_lines(
    spark: SparkSession, paths: list[str], dialect: CsvDialect
) -> tuple[list[str], list[str]]:
    """The files of which every line is a whole record, and those with other lines."""
    if dialect.multi_line is not None:
        return ([], paths) if dialect.multi_line else (paths, [])
    lines = naming_missing_path(paths, lambda: spark.read.option("lineSep", "\n").text(paths))
    line = F.regexp_replace("value", "\r$", "")
    broken = line.contains("\r")
    broken |= line.contains(dialect.quote) & ~line.rlike(dialect.whole_line_pattern())
    files = HadoopFiles(spark)
    odd = lines.where(broken).select(F.col("_metadata.file_path").alias(_FILE)).distinct()
    # Of the files that the scan lists anyway.
    whole = {files.of_uri(row[0]) for row in odd.collect()}
    if not whole:
        return paths, []
    split = sorted({files.of_uri(uri) for uri in lines.inputFiles()} - whole)
    return (split, sorted(whole)) if split else ([], paths)


def settle_line_breaks(
    spark: SparkSession, paths: list[str], dialect: CsvDialect
) -> CsvDialect:
    """The dialect with ``multi_line`` decided for all files together, if it was left open."""
    _, whole = _with_broken_lines(spark, paths, dialect)
    return replace(dialect, multi_line=bool(whole))


def scan_files(
    spark: SparkSession,
    paths: str | Sequence[str],
    dialect: CsvDialect | None = None,
    schema: T.StructType | None = None,
    lineage: str | None = None,
) -> DataFrame:
    """Scan by file extension.  CSV settings have no effect on Parquet."""
    paths = as_paths(paths)
    if common_format(paths) == "parquet":
        return scan_parquet(spark, paths, lineage)
    return scan_csv(spark, paths, dialect, schema, lineage)


def scan_source(
    spark: SparkSession, table: str | None = None, query: str | None = None
) -> DataFrame:
    """A table by name or the result of a query: exactly one of the two."""
    if table is not None and query is not None:
        raise ValueError("table and query cannot be used together")
    if table is not None:
        return spark.table(table_identifier(table))
    if query is not None:
        return spark.sql(query)
    raise ValueError("either table or query must be provided")


def with_typed_nulls(frame: DataFrame) -> DataFrame:
    """Columns that are only ever NULL have no type and no file format; make them text."""
    if not any(isinstance(field.dataType, T.NullType) for field in frame.schema.fields):
        return frame
    return frame.select(
        *[
            F.col(quote_identifier(field.name)).cast(
                "string" if isinstance(field.dataType, T.NullType) else field.dataType
            )
            for field in frame.schema.fields
        ]
    )


def zero_rows(frame: DataFrame) -> DataFrame:
    """The same columns with no rows; the optimizer drops the whole source."""
    return frame.where(F.lit(False))


def has_file_positions(spark: SparkSession, table: str) -> bool:
    """Whether ``table`` is stored Parquet, so that each row has a fixed file and index."""
    name = table_identifier(table)
    if name.lower().startswith("parquet.`"):
        return True
    entry = spark.catalog.getTable(name)
    if entry.isTemporary or entry.tableType not in ("MANAGED", "EXTERNAL"):
        return False
    try:
        spark.table(name).select("_metadata.row_index")
    except AnalysisException:
        return False
    return True


def scan_bytes(frame: DataFrame) -> int:
    """Size of the files behind a scan, from the planner's file listing."""
    return int(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def _with_lineage(frame: DataFrame, lineage: str | None) -> DataFrame:
    if lineage is None:
        return frame
    return frame.select("*", F.col("_metadata.file_name").alias(lineage))


def first_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The first line of each file, and the file's address; tasks open the files and read their first blocks.

    Where only the JVM can open the store, or files are on one machine's disk, the files are scanned.
    """
    lines = spark.read.text(paths)
    found = lines.inputFiles()
    if not _open_to_tasks(spark, found):
        numbered = lines.select("value", F.col("_metadata.file_path").alias(_FILE), F.monotonically_increasing_id().alias("n"))
        return numbered.groupBy(_FILE).agg(F.min_by("value", "n").alias(_RECORD)).select(_RECORD, _FILE)
    block = _FIRST_BYTES

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        for batch in batches:
            records, addresses = [], []
            for address in batch.column(0).to_pylist():
                store, path = fs.FileSystem.from_uri(address)
                held = b""
                # Compressed files are told by their names, as in a scan.
                with store.open_input_stream(path) as stream:
                    while not (b"\n" in held or b"\r" in held) and (more := stream.read(block)):
                        held += more
                if held:
                    records.append(held.splitlines()[0].decode("utf-8", "replace"))
                    addresses.append(address)
            yield pa.RecordBatch.from_pydict({_RECORD: pa.array(records, pa.string()), _FILE: pa.array(addresses, pa.string())})

    named = spark.createDataFrame([(address,) for address in found], "address string")
    return named.repartition(max(1, min(len(found), 1024))).mapInArrow(first, f"{_RECORD} string, {_FILE} string")


def _open_to_tasks(spark: SparkSession, addresses: list[str]) -> bool:
    """Whether tasks can open files by themselves."""
    local = spark.sparkContext.master.startswith("local")
    for scheme in {address.split(":", 1)[0]: address for address in addresses}.values():
        try:
            fs.FileSystem.from_uri(scheme)
        except (ValueError, OSError, pa.ArrowException):
            return False
        if scheme.startswith("file:") and not local:
            return False
    return True


def _files_by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """Input files grouped by their first line."""
    headers = naming_missing_path(paths, lambda: first_lines(spark, paths))
    # One row per distinct header; the paths were named by the caller.
    groups = headers.groupBy(_RECORD).agg(F.sort_array(F.collect_list(_FILE)).alias("files"))
    files = HadoopFiles(spark)
    return [[files.of_uri(uri) for uri in row.files] for row in groups.orderBy(F.get("files", F.lit(0))).collect()]
