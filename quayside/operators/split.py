"""Cutting rows into numbered files under exact row limits and byte limits."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.naming import helper_name, quote_identifier
from quayside.operators.chain import CELL, FILE_BEFORE, STARTS_AT, FileLimit, file_starts
from quayside.operators.numbering import (
    BEFORE,
    NUMBER,
    PART,
    WEIGHT,
    Numbered,
    broadcast_if_small,
    data_columns,
    task_count,
)
from quayside.sources.dialect import CsvDialect

FILE_ID = helper_name("file_id")


@dataclass(frozen=True)
class SplitLimits:
    """At most ``max_rows`` rows per file; a file is full once it holds ``max_bytes``."""

    max_rows: int | None = None
    max_bytes: int | None = None

    def __post_init__(self) -> None:
        for limit in (self.max_rows, self.max_bytes):
            if limit is not None and limit < 1:
                raise ValueError("split limits must be at least 1")

    @property
    def active(self) -> bool:
        return self.max_rows is not None or self.max_bytes is not None


@dataclass(frozen=True)
class Assigned:
    """Rows with the file each belongs to; file ids are dense from 0 in row order."""

    frame: DataFrame
    files: int
    counts: DataFrame
    """file_id, rows: the number of rows of each file."""


def csv_line_bytes(schema: T.StructType, dialect: CsvDialect) -> Column:
    """Bytes of the CSV line of a row, with its line end."""
    record = F.struct(*dialect.line_columns(schema))
    return F.octet_length(F.to_csv(record, dialect.text_options())) + 1


def csv_header_bytes(spark: SparkSession, schema: T.StructType, dialect: CsvDialect) -> int:
    """Bytes of the header line of every file."""
    if not dialect.header:
        return 0
    names = F.struct(*[F.lit(name).alias(f"c{i}") for i, name in enumerate(schema.names)])
    line = F.to_csv(names, dialect.text_options())
    return spark.sql("SELECT 1").select(F.octet_length(line) + 1).first()[0]


def plain_row_bytes(schema: T.StructType) -> Column:
    """Unencoded width of a row, used to weigh rows for a columnar format."""
    fixed = 0
    total = F.lit(0)
    for field in schema.fields:
        column = F.col(quote_identifier(field.name))
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(column), F.lit(0))
            fixed += 4
        elif isinstance(field.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            text = F.to_json(F.struct(column.alias("v")))
            total = total + F.coalesce(F.octet_length(text), F.lit(0))
        else:
            fixed += 8
    return total + F.lit(fixed)


def assign_files(numbered: Numbered, limits: SplitLimits, room: int | None, scratch: str) -> Assigned:
    """Assign each row to a file.

    The row limit alone is arithmetic on the row number.  With a byte limit a file is full once its
    rows weigh ``room`` or more, or at the row limit; the next row begins the next file, which starts
    counting from nothing.  A cell of ``room`` weight then holds at most one start, but for those that
    the row limit makes, which lie evenly behind the first; so a small row per cell tells every row's file.
    """
    frame, helpers = numbered.frame, (PART, BEFORE, WEIGHT)
    if room is None:
        file_id = F.expr(f"`{NUMBER}` div {limits.max_rows}")
        assigned = frame.withColumn(FILE_ID, file_id).drop(*helpers)
        files = math.ceil(numbered.rows / limits.max_rows)
        left = F.lit(numbered.rows) - F.col("file_id") * limits.max_rows
        counts = frame.sparkSession.range(files).toDF("file_id")
        return Assigned(assigned, files, counts.withColumn("rows", F.least(F.lit(limits.max_rows), left).cast("long")))

    cells = file_starts(frame, FileLimit(room, limits.max_rows), scratch)
    files = cells.starts.agg(F.max("file_id")).first()[0] + 1
    lookup = broadcast_if_small(cells.lookup, cells.lookup.count(), 32)
    behind = f"(`{NUMBER}` - `{STARTS_AT}`) div {limits.max_rows}" if limits.max_rows else "0"
    file_id = F.expr(
        f"CASE WHEN `{NUMBER}` >= `{STARTS_AT}` THEN `{FILE_BEFORE}` + 1 + {behind} ELSE `{FILE_BEFORE}` END"
    )
    assigned = (
        frame.withColumn(CELL, F.expr(f"`{BEFORE}` div {room}"))
        .join(lookup, [PART, CELL])
        .withColumn(FILE_ID, file_id)
        .drop(CELL, STARTS_AT, FILE_BEFORE, *helpers)
    )
    ends = cells.starts.select((F.col("file_id") - 1).alias("file_id"), F.col("first").alias("end"))
    counts = cells.starts.join(ends, "file_id", "left")
    rows = F.coalesce("end", F.lit(numbered.rows)) - F.col("first")
    return Assigned(assigned, files, counts.select("file_id", rows.alias("rows")))


def place_runs(assigned: Assigned, rows: int, runs: int) -> DataFrame:
    """Bring as many runs of neighbouring rows into one task each, in row order; a file's parts lie in order of the tasks."""
    task = F.expr(f"cast(`{NUMBER}` div {math.ceil(rows / runs)} as int)")
    return (
        assigned.frame.repartitionById(runs, task)
        .sortWithinPartitions(FILE_ID, NUMBER)
        .select(*data_columns(assigned.frame.drop(FILE_ID)), FILE_ID)
    )


def place_files(assigned: Assigned, file_bytes: int) -> DataFrame:
    """Bring every file's rows into one task, in row order.

    A task takes a run of neighbouring files, as many as make up a fair share of
    the data, so neither very many small files nor a few large ones distort the
    number of tasks.  The write then starts a new file at each FILE_ID.
    """
    spark = assigned.frame.sparkSession
    wanted = task_count(spark, file_bytes)
    per_task = math.ceil(assigned.files / min(wanted, assigned.files))
    tasks = math.ceil(assigned.files / per_task)
    task = F.expr(f"cast(`{FILE_ID}` div {per_task} as int)")
    return (
        assigned.frame.repartitionById(tasks, task)
        .sortWithinPartitions(FILE_ID, NUMBER)
        .select(*data_columns(assigned.frame.drop(FILE_ID)), FILE_ID)
    )
