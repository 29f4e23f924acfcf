"""Exact global row numbers without a single-partition window.

Rows get their number from where they lie in Parquet files: ``_metadata`` gives
the file and the row index in it, a small per-file table gives how many rows
(and how much weight) come before the file, and the number is the sum.  A file
position never changes, so a retried task or a lost executor cannot renumber
rows, and no sort or shuffle of the data is needed to count them.

Rows that do not yet lie in files (a query result), or that must follow a sort
order, are first written to the shared staging folder.  Sorting ranges over the
order columns *and* the file position, which is unique: rows with equal order
keys spread over many tasks however many there are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.naming import helper_name, quote_identifier
from quayside.sources.scan import scan_bytes
from quayside.storage import HadoopFiles

#: Names of the helper columns.
PART, ROW, WEIGHT, BEFORE, NUMBER = map(helper_name, ("part", "row", "weight", "before", "number"))
_OFFSET_ROWS, _OFFSET_WEIGHT = helper_name("offset_rows"), helper_name("offset_weight")

_GROUP = helper_name("group")

#: Files whose offsets are summed in one group.
GROUP_FILES = 4096
#: Target size of one task's share of staged Parquet.
TASK_BYTES = 128 * 1024 * 1024
#: Lookup tables are broadcast up to this size; beyond it the join shuffles.
BROADCAST_BYTES = 128 * 1024 * 1024


def weight_before(weight: str) -> Column:
    """Running total of the rows above, over one task's rows in their order.

    Only this one column passes through Arrow; a window function would shuffle
    and sort the whole rows again to give the same number.
    """

    # A local function travels with the job, so executors need not have this package.
    def above(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        carried = 0
        for weights in batches:
            totals = weights.cumsum() + carried
            yield totals - weights
            if len(totals):
                carried = int(totals.iloc[-1])

    # Evaluated once, on the rows in the order they are written.
    return F.pandas_udf(above, T.LongType()).asNondeterministic()(weight)


@dataclass(frozen=True)
class Positioned:
    """Rows lying in Parquet files, with their position, and what is known of them."""

    frame: DataFrame
    """The user's columns plus PART and ROW, and WEIGHT and BEFORE when weighted."""
    weighted: bool


@dataclass(frozen=True)
class Numbered:
    """Rows with a dense global number, and their totals."""

    frame: DataFrame
    """The user's columns plus PART and NUMBER, and WEIGHT and BEFORE (global) when weighted."""
    rows: int
    weight: int
    file_bytes: int


def data_columns(frame: DataFrame) -> list[Column]:
    reserved = {PART, ROW, WEIGHT, BEFORE, NUMBER}
    return [F.col(quote_identifier(c)) for c in frame.columns if c not in reserved]


def broadcast_if_small(frame: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Broadcast a lookup table of a known size if it is within the bound."""
    return F.broadcast(frame) if rows * row_bytes <= BROADCAST_BYTES else frame


def _by_file(frame: DataFrame) -> DataFrame:
    return frame.select(
        "*",
        F.col("_metadata.file_path").alias(PART),
        F.col("_metadata.row_index").alias(ROW),
    )


def write_and_read(frame: DataFrame, path: str, codec: str = "snappy") -> DataFrame:
    """Cut the lineage with a written table; its schema is known, so no footer is read."""
    frame.write.option("compression", codec).option("maxRecordsPerFile", 0).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def position_rows(
    frame: DataFrame,
    in_files: bool,
    scratch: str,
    order_by: Sequence[str | Column] = (),
    weight: Column | None = None,
    codec: str = "snappy",
) -> Positioned:
    """Give every row a fixed file position, staging the rows where they have none.

    ``in_files`` says that ``frame`` is an unfiltered scan of Parquet files.
    Folders below ``scratch`` take what is staged; they must outlive the result.
    """
    spark = frame.sparkSession
    clash = {PART, ROW, WEIGHT, BEFORE, NUMBER} & set(frame.columns)
    if clash:
        raise ValueError(f"reserved column names: {', '.join(sorted(clash))}")
    if order_by:
        if not in_files:
            frame = write_and_read(frame, f"{scratch}/rows", codec)
        keys = [F.col(k) if isinstance(k, str) else k for k in order_by]
        # Shuffled with every row, so the file goes in as eight bytes and not as its path.
        keys += [F.col(PART), F.col(ROW)]
        tasks = task_count(spark, scan_bytes(frame))
        frame = (
            _by_file(frame)
            .withColumn(PART, F.xxhash64(PART))
            .repartitionByRange(tasks, *keys)
            .sortWithinPartitions(*keys)
            .drop(PART, ROW)
        )
        in_files = False
    if in_files and weight is None:
        return Positioned(_by_file(frame), False)
    # The partition number keeps range order and, unlike a path, is short to join on.
    columns = [*data_columns(frame), F.spark_partition_id().alias(PART)]
    if weight is not None:
        frame = frame.withColumn(WEIGHT, weight.cast("long"))
        columns += [F.col(WEIGHT), weight_before(WEIGHT).alias(BEFORE)]
    frame = write_and_read(frame.select(*columns), f"{scratch}/positions", codec)
    frame = frame.select("*", F.col("_metadata.row_index").alias(ROW))
    return Positioned(frame, weight is not None)


def task_count(spark: SparkSession, size: int) -> int:
    """Tasks for a shuffle of ``size`` bytes of Parquet."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(size / TASK_BYTES))


def number_rows(positioned: Positioned, lookup_path: str) -> Numbered:
    """Add the global row number, and the global weight before each row."""
    frame = positioned.frame
    zero = F.lit(0).cast("long")
    weight = F.sum(WEIGHT) if positioned.weighted else zero
    per_file = frame.groupBy(PART).agg(
        F.count(F.lit(1)).alias("rows"),
        weight.alias("weight"),
        F.max("_metadata.file_size").alias("bytes"),
    )
    totals = Observation()
    observed = per_file.observe(
        totals,
        F.count(F.lit(1)).alias("files"),
        F.coalesce(F.max(F.length(F.col(PART).cast("string"))), F.lit(0)).alias("key_length"),
        *[F.coalesce(F.sum(name), zero).alias(name) for name in ("rows", "weight", "bytes")],
    )
    counts = write_and_read(observed.drop("bytes"), f"{lookup_path}/counts")
    found = totals.get
    lookup = _offsets(counts, found["files"], lookup_path)
    lookup = broadcast_if_small(lookup, found["files"], 16 + found["key_length"])
    columns = [*data_columns(frame), F.col(PART)]
    columns.append((F.col(_OFFSET_ROWS) + F.col(ROW)).alias(NUMBER))
    if positioned.weighted:
        columns.append((F.col(_OFFSET_WEIGHT) + F.col(BEFORE)).alias(BEFORE))
        columns.append(F.col(WEIGHT))
    return Numbered(
        frame.join(lookup, PART).select(*columns),
        found["rows"],
        found["weight"],
        found["bytes"],
    )


def _offsets(counts: DataFrame, files: int, lookup_path: str) -> DataFrame:
    """What lies before each file: a running total within groups of neighbouring files, and over the groups."""
    groups = math.ceil(files / GROUP_FILES)
    if isinstance(counts.schema[PART].dataType, T.IntegerType):
        counts = counts.withColumn(_GROUP, F.expr(f"`{PART}` div {GROUP_FILES}"))
    elif groups > 1:
        ranged = counts.repartitionByRange(groups, PART).withColumn(_GROUP, F.spark_partition_id())
        counts = write_and_read(ranged, f"{lookup_path}/groups")
    else:
        counts = counts.withColumn(_GROUP, F.lit(0))
    zero = F.lit(0).cast("long")
    # One row per group of files, so a running total over these fits one task.
    above_groups = Window.orderBy(_GROUP).rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.groupBy(_GROUP).agg(F.sum("rows").alias("r"), F.sum("weight").alias("w"))
    sums = sums.select(
        _GROUP,
        F.coalesce(F.sum("r").over(above_groups), zero).alias("r"),
        F.coalesce(F.sum("w").over(above_groups), zero).alias("w"),
    )
    above = Window.partitionBy(_GROUP).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return counts.join(broadcast_if_small(sums, groups, 24), _GROUP).select(
        PART,
        (F.col("r") + F.coalesce(F.sum("rows").over(above), zero)).alias(_OFFSET_ROWS),
        (F.col("w") + F.coalesce(F.sum("weight").over(above), zero)).alias(_OFFSET_WEIGHT),
    )


def discard(spark: SparkSession, paths: Sequence[str]) -> None:
    files = HadoopFiles(spark)
    for path in paths:
        files.delete(path)
