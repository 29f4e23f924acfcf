"""What is wrong with inputs, as rows: many files probed in parallel, and requests that name their source.

A scan or a load stops at the first input that it cannot take.  The audit looks at all of them and gives each
the error it would stop with, or ``ok``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.naming import format_of
from quayside.sources.dialect import CsvDialect
from quayside.sources.listing import address_for_tasks

# The verdicts.
OK, MISSING, UNSUPPORTED, EMPTY, UNREADABLE = (
    "ok", "file not found", "unsupported file format", "no data rows", "not readable",
)
BOTH_SOURCES, NO_SOURCE = "table and query cannot be used together", "either table or query must be provided"

#: Bytes that are read of a CSV file at a time, until it is known whether it has a data row.
_BLOCK = 1 << 16


def source_verdict(table: Column, query: Column) -> Column:
    """``ok`` if exactly one of the two is given, else the error."""
    return (
        F.when(table.isNotNull() & query.isNotNull(), BOTH_SOURCES)
        .when(table.isNull() & query.isNull(), NO_SOURCE)
        .otherwise(OK)
    )


def audit_files(paths: DataFrame, directory: str, dialect: CsvDialect | None = None, column: str = "path") -> DataFrame:
    """``path, verdict`` for each file of a table of paths below ``directory``.

    Tasks open the files themselves: of a Parquet file the footer, of a CSV file its first blocks, until a
    data row is found.  Nothing about single files passes through the driver.
    """
    base, header = address_for_tasks(paths.sparkSession, directory), (dialect or CsvDialect()).header
    verdicts = (OK, MISSING, EMPTY, UNREADABLE)
    block = _BLOCK

    def has_row(stream, skip: int) -> bool:
        """Whether there is a line with something in it after so many such lines; quotes do not matter for that."""
        held = False
        while chunk := stream.read(block):
            for byte in chunk:
                if byte in (10, 13):
                    skip -= held
                    held = False
                else:
                    held = True
                    if skip == 0:
                        return True
        return False

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs
        from pyarrow import parquet as pq

        ok, missing, empty, unreadable = verdicts
        files, root = fs.FileSystem.from_uri(base)
        for batch in batches:
            found = []
            for path, kind in zip(batch["path"].to_pylist(), batch["format"].to_pylist(), strict=True):
                place = f"{root}/{path}"
                try:
                    if files.get_file_info(place).type != fs.FileType.File:
                        found.append(missing)
                        continue
                    with files.open_input_file(place) as stream:
                        if kind == "parquet":
                            there = pq.ParquetFile(stream).metadata.num_rows > 0
                        else:
                            there = has_row(stream, int(header))
                    found.append(ok if there else empty)
                except (OSError, ValueError):
                    found.append(unreadable)
            yield pa.RecordBatch.from_pydict({"path": batch["path"], "verdict": pa.array(found, pa.string())})

    named = paths.select(F.col(column).alias("path")).select("path", format_of(F.col("path")).alias("format"))
    unsupported = named.where("format IS NULL").select("path", F.lit(UNSUPPORTED).alias("verdict"))
    return unsupported.union(named.where("format IS NOT NULL").mapInArrow(probe, "path string, verdict string"))
