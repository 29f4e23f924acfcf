"""Large CSV files with line breaks inside fields, read by many tasks.

A file is looked at in ranges of bytes.  The number of quotes before a range tells whether it begins inside a
field, so its line breaks between records are known; a record belongs to the range that holds the break before
it.  Only files where no quote and no line break is in doubt are read so: fields are quoted as a whole, quotes
inside them doubled, and all records end alike.  The others are left to one task each.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.sources.dialect import CsvDialect

# Tasks get this module's functions with their code, as those of other modules.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Files up to this size are read by one task.
WHOLE_BYTES = 128 << 20
#: Bytes of a file that are looked at together, and ranges that a task reads.
RANGE_BYTES = 8 << 20
_RANGES_A_TASK = 8
_TAIL_BYTES = 1 << 20
_COMPRESSED = (".gz", ".bz2", ".deflate", ".lz4", ".snappy", ".zst", ".zstd", ".xz")
_CR, _LF = 13, 10
_NAME, _RECORD = "__name", "__record"
_LOOKED = "file int, start long, quotes long, doubt array<boolean>, crlf array<long>, lf array<long>, first string, header string"


class Cut(NamedTuple):
    """Files by ranges, and one file for each first record that they have."""

    ranges: list[Range]
    samples: list[str]


class Range(NamedTuple):
    """A stretch of a file, whether it begins inside a field, and whether records end in CR LF."""

    address: str
    start: int
    end: int
    inside: bool
    crlf: bool


def cut_by_records(spark: SparkSession, sizes: dict[str, int], dialect: CsvDialect) -> Cut:
    """The large files, by address, whose records many tasks can read; other files are left out."""
    large = [a for a, size in sizes.items() if size > WHOLE_BYTES and _open_to_tasks(a)]
    simple = dialect.escape in (None, dialect.quote) and max(ord(dialect.quote), ord(dialect.delimiter)) < 128
    if not large or not simple or {dialect.quote, dialect.delimiter} & {"\r", "\n"}:
        return Cut([], [])
    mark, delimiter, step = ord(dialect.quote), ord(dialect.delimiter), RANGE_BYTES

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                store, path = _store_and_path(row["address"])
                with store.open_input_file(path) as file:
                    found = _looked_at(file, row["start"], row["end"], row["size"], mark, delimiter)
                    if row["start"] == 0:
                        first = Range(row["address"], 0, row["end"], False, True)
                        record = next(_records_of(file, first, row["size"], mark, False), b"")
                        found["header"] = record.decode("utf-8", "replace")
                rows.append({"file": row["file"], "start": row["start"], "header": None} | found)
            yield pa.RecordBatch.from_pylist(rows, schema=_LOOKED_ARROW)

    stretches = [
        (n, address, start, min(start + step, sizes[address]), sizes[address])
        for n, address in enumerate(large)
        for start in range(0, sizes[address], step)
    ]
    table = _in_tasks(spark, stretches, "file int, address string, start long, end long, size long")
    looked: dict[int, list] = {}
    # One short row for each range.
    for row in table.mapInArrow(look, _LOOKED).collect():
        looked.setdefault(row.file, []).append(row)
    cut, samples = [], {}
    for n, rows in looked.items():
        inside, doubt, crlf, lf, ranges = 0, False, 0, 0, []
        rows.sort(key=lambda row: row.start)
        for row in rows:
            doubt |= row.doubt[inside]
            crlf, lf = crlf + row.crlf[inside], lf + row.lf[inside]
            ranges.append((row.start, min(row.start + step, sizes[large[n]]), bool(inside)))
            inside = (inside + row.quotes) % 2
        # A reader takes the first line break for the end of all records.
        ends = "\r\n" if crlf else "\n"
        if not (doubt or inside or (crlf and lf) or rows[0].first != ends):
            cut += [Range(large[n], *found, crlf > 0) for found in ranges]
            samples.setdefault(rows[0].header, large[n])
    return Cut(cut, list(samples.values()))


_LOOKED_ARROW = pa.schema(
    [
        ("file", pa.int32()), ("start", pa.int64()), ("quotes", pa.int64()), ("doubt", pa.list_(pa.bool_())),
        ("crlf", pa.list_(pa.int64())), ("lf", pa.list_(pa.int64())), ("first", pa.string()),
        ("header", pa.string()),
    ]
)


def _looked_at(file, start: int, end: int, size: int, quote: int, delimiter: int) -> dict:
    """What a range holds if it begins outside of a field, and if it begins inside of one."""
    before = max(start - 1, 0)
    held = file.read_at(min(end + 1, size) - before, before)
    # The ends of the file are as good as line breaks.
    held = (b"\n" if start == 0 else b"") + held + (b"\n" if end >= size else b"")
    padded = np.frombuffer(held, np.uint8)
    here, last, following = padded[1:-1], padded[:-2], padded[2:]
    quotes, breaks, returns = (np.flatnonzero(here == code) for code in (quote, _LF, _CR))
    opens_well = np.isin(last[quotes], (delimiter, _LF, quote))
    closes_well = np.isin(following[quotes], (delimiter, _LF, _CR, quote))
    order = np.arange(len(quotes))
    ends_line, after_return = following[returns] == _LF, last[breaks] == _CR
    found = {"quotes": len(quotes), "doubt": [], "crlf": [], "lf": []}
    for inside in (0, 1):
        opening = (order + inside) % 2 == 0
        outside, lone = (
            (np.searchsorted(quotes, places) + inside) % 2 == 0 for places in (breaks, returns)
        )
        doubt = (opening & ~opens_well).any() or (~opening & ~closes_well).any() or (lone & ~ends_line).any()
        found["doubt"].append(bool(doubt))
        found["crlf"].append(int((outside & after_return).sum()))
        found["lf"].append(int((outside & ~after_return).sum()))
    first = min([*breaks[:1], *returns[:1]], default=None)
    if first is None:
        return found | {"first": ""}
    pair = here[first] == _CR and following[first] == _LF
    return found | {"first": "\r\n" if pair else chr(here[first])}


def _records_of(file, part: Range, size: int, quote: int, header: bool) -> Iterator[bytes]:
    """The records that begin in a range; the last one may end behind it."""
    held = file.read_at(part.end - part.start, part.start)
    ends, quotes = _record_ends(held, part.inside, quote)
    if part.start == 0:
        begin = 3 if held.startswith(b"\xef\xbb\xbf") else 0
    elif len(ends):
        begin, ends = int(ends[0]) + 1, ends[1:]
    else:
        return
    skip = header and part.start == 0

    def whole(record: bytes) -> bytes:
        # Where records end so, Spark's reader makes one character of the pair inside fields, too.
        return record.removesuffix(b"\r").replace(b"\r\n", b"\n") if part.crlf else record

    for end in ends.tolist():
        record, begin = whole(held[begin:end]), end + 1
        if record and not skip:
            yield record
        skip = skip and not record
    pieces, at, inside = [held[begin:]], part.end, (part.inside + quotes) % 2 == 1
    while at < size:
        more = file.read_at(min(_TAIL_BYTES, size - at), at)
        ends, quotes = _record_ends(more, inside, quote)
        if len(ends):
            pieces.append(more[: int(ends[0])])
            break
        pieces.append(more)
        at, inside = at + len(more), (inside + quotes) % 2 == 1
    record = whole(b"".join(pieces))
    if record and not skip:
        yield record


def _record_ends(held: bytes, inside: bool, quote: int) -> tuple[np.ndarray, int]:
    """The line breaks outside of fields, and the number of quotes."""
    codes = np.frombuffer(held, np.uint8)
    quotes, breaks = np.flatnonzero(codes == quote), np.flatnonzero(codes == _LF)
    return breaks[(np.searchsorted(quotes, breaks) + inside) % 2 == 0], len(quotes)


def records(spark: SparkSession, ranges: list[Range], dialect: CsvDialect) -> DataFrame:
    """One row for each record but headers: the name of its file, and its text."""
    mark, delimiter, header = dialect.quote.encode(), dialect.delimiter.encode(), dialect.header

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = Range(**{name: row[name] for name in Range._fields})
                store, path = _store_and_path(part.address)
                name = part.address.rpartition("/")[2]
                with store.open_input_file(path) as file:
                    found, held = [], 0
                    for record in _records_of(file, part, file.size(), mark[0], header):
                        if not record.strip() and delimiter not in record:
                            # Blanks are a value; readers of lines take them for an empty line.
                            record = mark + record + mark
                        found.append(record)
                        held += len(record)
                        if held > _TAIL_BYTES:
                            yield _named(name, found)
                            found, held = [], 0
                    if found:
                        yield _named(name, found)

    table = _in_tasks(spark, [tuple(part) for part in ranges], "address string, start long, end long, inside boolean, crlf boolean")
    found = table.mapInArrow(read, f"{_NAME} string, {_RECORD} binary")
    return found.select(_NAME, F.col(_RECORD).cast("string").alias(_RECORD))


def _named(name: str, found: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {_NAME: pa.array([name] * len(found), pa.string()), _RECORD: pa.array(found, pa.binary())}
    )


def _in_tasks(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Neighbouring rows in one task, so many to each."""
    tasks = max(1, -(-len(rows) // _RANGES_A_TASK))
    return spark.createDataFrame(spark.sparkContext.parallelize(rows, tasks), schema)


def _store_and_path(address: str) -> tuple[fs.FileSystem, str]:
    # Addresses in scans' metadata keep letters that are not ASCII.
    return fs.FileSystem.from_uri(quote(address, safe="%/:?#[]@!$&'()*+,;=~"))


def _open_to_tasks(address: str) -> bool:
    """Whether tasks can open a file at any place; what Spark scans on a disk, all its tasks see."""
    if address.lower().endswith(_COMPRESSED):
        return False
    try:
        _store_and_path(address)
    except (ValueError, OSError, pa.ArrowException):
        return False
    return True


def parsed(found: DataFrame, dialect: CsvDialect, schema: T.StructType, lineage: str | None) -> DataFrame:
    """The records' fields under a schema."""
    fields = F.from_csv(F.col(_RECORD), schema_text(schema), _record_options(dialect)).alias(_RECORD)
    name: list[Column] = [] if lineage is None else [F.coalesce(_NAME, F.lit("")).alias(lineage)]
    return found.select(fields, _NAME).select(f"{_RECORD}.*", *name)


def inferred(found: DataFrame, dialect: CsvDialect, sampling_ratio: float | None) -> T.StructType:
    """The types of the records' fields, named by Spark."""
    reader = found.sparkSession.read.options(**_record_options(dialect)).option("inferSchema", "true")
    if sampling_ratio is not None:
        reader = reader.option("samplingRatio", sampling_ratio)
    return reader.csv(found.select(_RECORD).rdd.map(lambda row: row[0])).schema


def schema_text(schema: T.StructType) -> str:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields]).toDDL()


def _record_options(dialect: CsvDialect) -> dict[str, str]:
    return dialect.read_options() | {"header": "false", "multiLine": "true"}
