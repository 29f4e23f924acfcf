"""Schema inference, planned DDL and dry runs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from quayside.functions.naming import quote_identifier, table_identifier
from quayside.sources import records
from quayside.sources.dialect import CsvDialect
from quayside.sources.scan import (
    naming_missing_path,
    as_paths,
    Parts,
    by_line_breaks,
    common_format,
    common_type,
    scan_parquet,
)


class NoDataRowsError(ValueError):
    """A CSV input holds a header but no rows, so it has no types to infer."""


@contextmanager
def _session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def infer_parquet_schema(spark: SparkSession, paths: str | Sequence[str]) -> T.StructType:
    """Column names and types from the file footers; no rows are read."""
    return scan_parquet(spark, paths).schema


def infer_csv_schema(
    spark: SparkSession,
    paths: str | Sequence[str] | Parts,
    dialect: CsvDialect | None = None,
    sampling_ratio: float | None = None,
) -> T.StructType:
    """Column names and types found by parsing values under ``dialect``.

    Whole numbers become 64-bit, date-times carry no zone, and headerless
    columns are named ``col_1 .. col_N``.  Input with no data rows is an error.
    All rows are looked at, in parallel, however large the input.  Only a caller
    who asks for it gets types from a share of the rows (``sampling_ratio``); a
    value elsewhere that does not fit then fails the scan, it is never dropped.
    """
    parts = paths if isinstance(paths, list) and not isinstance(paths[0], str) else None
    if parts is None:
        paths = as_paths(paths)
        parts = by_line_breaks(spark, paths, dialect or CsvDialect())
    found = []
    for files, own, cut in parts:
        read = naming_missing_path(files, lambda: _parsed_schema(spark, files, own, sampling_ratio, cut))
        found += [_named_columns(read, own, _widen)] if read.fields else []
    if not found:
        raise NoDataRowsError(f"no data rows in {', '.join(f for part in parts for f in part.files[:10])}")
    if len(found) == 1:
        return found[0]
    one, *others = found
    for other in others:
        if [n.lower() for n in one.names] != [n.lower() for n in other.names]:
            raise ValueError(f"files have different columns: {', '.join(one.names)} and {', '.join(other.names)}")
        kinds = (common_type(a.dataType, b.dataType) for a, b in zip(one.fields, other.fields, strict=True))
        one = T.StructType([T.StructField(n, kind, True) for n, kind in zip(one.names, kinds, strict=True)])
    return one


def csv_columns(
    spark: SparkSession, paths: str | Sequence[str], dialect: CsvDialect | None = None
) -> T.StructType:
    """The columns of a CSV input as text, from its first record; types are not looked for."""
    paths, dialect = as_paths(paths), dialect or CsvDialect()
    reader = spark.read.options(**dialect.read_options())
    frame = naming_missing_path(paths, lambda: reader.csv(paths))
    if frame.isEmpty():
        raise NoDataRowsError(f"no data rows in {', '.join(paths)}")
    return _named_columns(frame.schema, dialect, lambda found: found)


def _named_columns(schema: T.StructType, dialect: CsvDialect, kind: Callable) -> T.StructType:
    return T.StructType(
        [
            T.StructField(
                field.name if dialect.header else f"col_{ordinal}", kind(field.dataType), True
            )
            for ordinal, field in enumerate(schema.fields, start=1)
        ]
    )


def _parsed_schema(
    spark: SparkSession,
    paths: list[str],
    dialect: CsvDialect,
    sampling_ratio: float | None,
    cut: records.Cut | None = None,
) -> T.StructType:
    """Schema of the rows in some files, empty if they have none."""
    if cut is not None:
        named = spark.read.options(**dialect.read_options()).csv(cut.samples[0])
        with _session_setting(spark, "spark.sql.timestampType", "TIMESTAMP_NTZ"):
            found = records.inferred(records.records(spark, cut.ranges, dialect), dialect, sampling_ratio)
        if len(found.names) == len(named.columns):
            return T.StructType([T.StructField(n, f.dataType) for n, f in zip(named.columns, found.fields, strict=True)])
    reader = spark.read.options(**dialect.read_options()).option("inferSchema", "true")
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    with _session_setting(spark, "spark.sql.timestampType", "TIMESTAMP_NTZ"):
        frame = reader.csv(paths)
    return T.StructType() if frame.isEmpty() else frame.schema


def _widen(found: T.DataType) -> T.DataType:
    return T.LongType() if isinstance(found, T.IntegerType) else found


def infer_schema(
    spark: SparkSession, paths: str | Sequence[str], dialect: CsvDialect | None = None
) -> T.StructType:
    """Schema of files of one format, chosen by extension."""
    paths = as_paths(paths)
    if common_format(paths) == "parquet":
        return infer_parquet_schema(spark, paths)
    return infer_csv_schema(spark, paths, dialect)


def type_name(data_type: T.DataType) -> str:
    if isinstance(data_type, (T.StructType, T.ArrayType, T.MapType)):
        return data_type.simpleString()
    return data_type.simpleString().upper()


def create_table_ddl(
    schema: T.StructType, table: str, location: str | None = None, if_not_exists: bool = False
) -> str:
    """``CREATE TABLE`` text with quoted names, so reserved words and case survive."""
    columns = ", ".join(
        f"{quote_identifier(field.name)} {type_name(field.dataType)}" for field in schema.fields
    )
    guard = "IF NOT EXISTS " if if_not_exists else ""
    place = " LOCATION '" + location.replace("'", "\\'") + "'" if location else ""
    return f"CREATE TABLE {guard}{table_identifier(table)} ({columns}) USING parquet{place}"


def schema_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """One row per column: ordinal, name, type, nullable."""
    rows = [
        (ordinal, field.name, type_name(field.dataType), field.nullable)
        for ordinal, field in enumerate(schema.fields, start=1)
    ]
    return spark.createDataFrame(rows, "ordinal int, name string, type string, nullable boolean")


def dry_run(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: str,
    dialect: CsvDialect | None = None,
) -> tuple[DataFrame, str]:
    """Inferred columns and the DDL a load would run.  Creates and writes nothing."""
    schema = infer_schema(spark, paths, dialect)
    return schema_frame(spark, schema), create_table_ddl(schema, table)
