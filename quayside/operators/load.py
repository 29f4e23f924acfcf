"""Loading files into tables: create if absent, append, and count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.naming import quote_identifier, table_identifier
from quayside.sources.dialect import CsvDialect
from quayside.sources.infer import create_table_ddl, csv_columns
from quayside.sources.scan import (
    as_paths,
    common_format,
    scan_csv,
    scan_parquet,
)


def load(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: str,
    dialect: CsvDialect | None = None,
    location: str | None = None,
    align_headers: bool = False,
) -> int:
    """Append the rows of files to ``table`` and return how many there were.

    The table is created from the inferred schema if it does not exist; an
    existing table keeps its own schema.  Columns are matched by name in any
    case, or by position when a CSV input has no header.
    """
    paths = as_paths(paths)
    dialect = dialect or CsvDialect()
    if common_format(paths) == "parquet":
        source = scan_parquet(spark, paths)
        by_name = True
    else:
        target = _existing_schema(spark, table)
        schema = None
        if target is not None and align_headers and dialect.header:
            schema = target
        elif target is not None:
            # The table fixes the types, so only the column names are looked at.
            schema = _typed_like(csv_columns(spark, paths, dialect), target, dialect.header)
        source = scan_csv(spark, paths, dialect, schema, align_headers=align_headers)
        by_name = dialect.header
    spark.sql(create_table_ddl(source.schema, table, location, if_not_exists=True))
    return append(source, table, by_name)


def stored(column: Column, own: T.DataType, wanted: T.DataType) -> Column:
    """A value of type ``own`` as the target's type; one that would lose something on the way is an error.

    Numbers must be the same when read back, and text must be a number, date or truth value if that is
    what the column holds, whether or not the session runs in ANSI mode.
    """
    if own == wanted or isinstance(own, (T.StructType, T.ArrayType, T.MapType, T.NullType)):
        return column.cast(wanted)
    value = column.try_cast(wanted)
    kept = value.isNotNull()
    if isinstance(own, T.NumericType) and isinstance(wanted, T.NumericType):
        kept = F.coalesce(value.try_cast(own) == column, F.lit(False))
        if isinstance(wanted, (T.FloatType, T.DoubleType)):
            kept |= F.isnan(column.cast("double"))
    text = F.concat(F.lit(f"value does not fit column type {wanted.simpleString()}: "), column.cast("string"))
    return F.when(column.isNotNull() & ~kept, F.raise_error(text).cast(wanted)).otherwise(value)


def append(source: DataFrame, table: str, by_name: bool = True) -> int:
    """Append rows to an existing table, counting them in the same job."""
    name = table_identifier(table)
    target = source.sparkSession.table(name).schema
    columns = _match_by_name(source, target) if by_name else _match_by_position(source, target)
    counted = Observation()
    rows = source.select(
        *[
            stored(column, kind.dataType, field.dataType).alias(field.name)
            for column, kind, field in zip(columns, source.select(*columns).schema, target.fields)
        ]
    ).observe(counted, F.count(F.lit(1)).alias("rows"))
    rows.write.insertInto(name)
    return counted.get["rows"]


def _existing_schema(spark: SparkSession, table: str) -> T.StructType | None:
    name = table_identifier(table)
    return spark.table(name).schema if spark.catalog.tableExists(name) else None


def _typed_like(found: T.StructType, target: T.StructType, by_name: bool) -> T.StructType:
    """The file's columns in file order, with the target's types."""
    if by_name:
        types = {field.name.lower(): field.dataType for field in target.fields}
        kinds = [types.get(field.name.lower(), field.dataType) for field in found.fields]
    else:
        _check_width(len(found), len(target))
        kinds = [field.dataType for field in target.fields]
    return T.StructType(
        [T.StructField(field.name, kind, True) for field, kind in zip(found.fields, kinds)]
    )


def _match_by_name(source: DataFrame, target: T.StructType) -> list[Column]:
    available = {name.lower(): name for name in source.columns}
    wanted = [field.name.lower() for field in target.fields]
    missing = [name for name in wanted if name not in available]
    extra = sorted(set(available) - set(wanted))
    if missing or extra:
        raise ValueError(f"columns do not match the table: missing {missing}, unknown {extra}")
    return [F.col(quote_identifier(available[name])) for name in wanted]


def _match_by_position(source: DataFrame, target: T.StructType) -> list[Column]:
    _check_width(len(source.columns), len(target))
    return [F.col(quote_identifier(name)) for name in source.columns]


def _check_width(found: int, wanted: int) -> None:
    if found != wanted:
        raise ValueError(f"columns do not match the table: {found} found, {wanted} expected")
