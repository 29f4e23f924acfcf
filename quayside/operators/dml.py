"""UPDATE, DELETE and MERGE on plain Parquet tables, partitioned or not.

A change is copy-on-write by file.  One pass finds the files that hold changed rows; only these are
read again and written anew, into a hidden folder of the table.  Then the old files move to another
hidden folder and the new ones move in.  All other files, and all other partitions, are neither read
twice nor touched, so a change of one row writes one file's worth of data.

A file can be moved away once, so of two changes to the same file one fails, puts its moves back and
leaves the table as it was.  There is no transaction log: a reader that listed the table before the
moves may fail with a missing file, and one that lists it between them sees the change without its last
files.  Changed rows are counted in the job that writes them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.naming import helper_name, quote_identifier, table_identifier
from quayside.operators.load import stored
from quayside.sources.scan import with_typed_nulls
from quayside.storage import HadoopFiles, scratch_dir

_HIT, _FILE, _ROW, _SOURCE = (helper_name(n) for n in ("hit", "file", "row", "source"))
_OF_FILE, _OF_ROW, _OF_SOURCE = (helper_name(n) for n in ("of_file", "of_row", "of_source"))
_MOVE_THREADS = 16


class ConcurrentWriteError(RuntimeError):
    """The table was changed by others while a change to it ran; the change was not applied."""


class AmbiguousMergeError(ValueError):
    """A row of the target matches more than one row of the source."""


@dataclass(frozen=True)
class DmlResult:
    """Rows affected, the hidden folder that keeps the files replaced, their number, and the bytes written."""

    rows: int
    previous_location: str | None
    files: int = 0
    bytes_written: int = 0

    def drop_previous(self, spark: SparkSession) -> None:
        if self.previous_location:
            HadoopFiles(spark).delete(self.previous_location)


@dataclass(frozen=True)
class MergeClause:
    """What a MERGE does with rows for which ``when`` holds: ``update``, ``delete`` or ``insert``, with values by column."""

    action: str
    when: str | Column | None = None
    values: Mapping[str, str | Column] | None = None


def _column(value: str | Column) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _holds(condition: str | Column | None) -> Column:
    """A condition that is NULL does not hold; no condition always does."""
    if condition is None:
        return F.lit(True)
    return F.coalesce(_column(condition), F.lit(False))


def _by_target_name(names: Iterable[str], values: Mapping[str, str | Column]) -> dict[str, Column]:
    own = {name.lower(): name for name in names}
    unknown = [name for name in values if name.lower() not in own]
    if unknown:
        raise ValueError(f"unknown columns: {', '.join(unknown)}")
    return {own[name.lower()]: _column(value) for name, value in values.items()}


def _fitting(frame: DataFrame, value: Column, wanted: T.DataType) -> Column:
    """The value as the column's type; a value that would lose something is an error."""
    return stored(value, frame.select(value).schema[0].dataType, wanted)


def update(
    spark: SparkSession,
    table: str,
    assignments: Mapping[str, str | Column],
    condition: str | Column | None = None,
    alias: str | None = None,
) -> DmlResult:
    """``UPDATE table SET ... WHERE condition``; all values see the old row."""
    place = _place(spark, table)
    assigned = _by_target_name(place.names, assignments)
    current = _current(spark, table, alias)
    hit = _hit_files(current, condition)
    changed = Observation()
    rows = current.where(F.col(_FILE).isin(hit)).withColumn(_HIT, _holds(condition))
    columns = [
        F.when(F.col(_HIT), _fitting(current, assigned[field.name], field.dataType))
        .otherwise(F.col(quote_identifier(field.name)))
        .alias(field.name)
        if field.name in assigned
        else F.col(quote_identifier(field.name))
        for field in place.schema.fields
    ]
    rows = rows.select(*columns, _HIT).observe(changed, F.count_if(_HIT).alias("rows")).drop(_HIT)
    return _replace(spark, table, place, hit, rows, lambda: changed.get["rows"])


def delete(
    spark: SparkSession,
    table: str,
    condition: str | Column | None = None,
    alias: str | None = None,
) -> DmlResult:
    """``DELETE FROM table WHERE condition``."""
    place = _place(spark, table)
    current = _current(spark, table, alias)
    hit = _hit_files(current, condition)
    counted = Observation()
    rows = current.where(F.col(_FILE).isin(hit)).withColumn(_HIT, _holds(condition))
    rows = rows.observe(counted, F.count_if(_HIT).alias("rows")).where(~F.col(_HIT))
    rows = rows.select(*map(quote_identifier, place.names))
    return _replace(spark, table, place, hit, rows, lambda: counted.get["rows"])


def merge(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    on: Mapping[str, str] | list[str] | Column | str,
    update: Mapping[str, str | Column] | None = None,
    update_when: str | Column | None = None,
    delete_matched: bool = False,
    delete_when: str | Column | None = None,
    insert: Mapping[str, str | Column] | None = None,
    insert_when: str | Column | None = None,
    target_alias: str = "t",
    source_alias: str = "s",
    matched: Sequence[MergeClause] = (),
    not_matched: Sequence[MergeClause] = (),
    not_matched_by_source: Sequence[MergeClause] = (),
) -> DmlResult:
    """``MERGE INTO table t USING source s ON ... WHEN ...``.

    ``on`` names the key columns, maps target to source columns, or is a condition over both
    aliases that holds an equality between them.  Of the clauses for matched rows, for source
    rows without a match and for target rows without one, the first whose condition holds is
    applied to a row.  ``update``, ``delete_matched`` and ``insert`` are short for one DELETE and then
    one UPDATE clause, and one INSERT clause.  The source is evaluated once.
    """
    if delete_matched:
        matched = [*matched, MergeClause("delete", delete_when)]
    if update is not None:
        matched = [*matched, MergeClause("update", update_when, update)]
    if insert is not None:
        not_matched = [*not_matched, MergeClause("insert", insert_when, insert)]
    place = _place(spark, table)
    listed = _listing(spark, place) if not_matched else None
    scratch = scratch_dir(spark, "merge")
    try:
        once = _staged_source(source, f"{scratch}/source").alias(source_alias)
        target = _current(spark, table, target_alias)
        condition = _match(on, target_alias, source_alias)
        # The codes of clauses count from 1, over the matched ones and then those by the target alone.
        changes = [*matched, *not_matched_by_source]
        pairs = target.join(once, condition, "left" if not_matched_by_source else "inner")
        found = F.col(_SOURCE).isNotNull()
        code = F.when(found, _first_clause(matched, 1)).otherwise(_first_clause(not_matched_by_source, 1 + len(matched)))
        pairs = pairs.select(_FILE, _ROW, _SOURCE, code.alias(_HIT)).where(found | (F.col(_HIT) > 0))
        pairs.write.parquet(f"{scratch}/matches")
        matches = spark.read.schema(pairs.schema).parquet(f"{scratch}/matches")
        if matched:
            _reject_ambiguous(matches)

        hit, rows, result = [], 0, None
        if changes:
            per_file = matches.where(F.col(_HIT) > 0).groupBy(_FILE).agg(F.count(F.lit(1)).alias("n")).collect()
            hit, rows = [row[_FILE] for row in per_file], sum(row.n for row in per_file)
        if hit:
            result = _rewritten(target.where(F.col(_FILE).isin(hit)), target_alias, once, matches, changes, place)
        inserted = Observation()
        if not_matched:
            present = matches.select(F.col(_SOURCE).alias(_OF_SOURCE)).where(F.col(_OF_SOURCE).isNotNull()).distinct()
            missing = once.join(present, F.col(_SOURCE) == F.col(_OF_SOURCE), "left_anti")
            added = _added(missing, not_matched, place).observe(inserted, F.count(F.lit(1)).alias("rows"))
            result = added if result is None else result.unionAll(added)
        if result is None:
            return DmlResult(0, None)

        def changed() -> int:
            return rows + (inserted.get["rows"] if not_matched else 0)

        return _replace(spark, table, place, hit, result, changed, listed)
    finally:
        HadoopFiles(spark).delete(scratch)


def _match(on: Mapping[str, str] | list[str] | Column | str, target: str, source: str) -> Column:
    if isinstance(on, (str, Column)):
        return _column(on)
    keys = on if isinstance(on, Mapping) else {key: key for key in on}
    match = F.lit(True)
    for target_key, source_key in keys.items():
        own, other = (f"{quote_identifier(a)}.{quote_identifier(k)}" for a, k in ((target, target_key), (source, source_key)))
        match = match & (F.col(own) == F.col(other))
    return match


def _staged_source(source: DataFrame, path: str) -> DataFrame:
    """The source's rows with a number each, written once, under whatever names they have."""
    names = source.columns
    plain = with_typed_nulls(source).toDF(*(f"c{i}" for i in range(len(names))))
    numbered = plain.withColumn(_SOURCE, F.monotonically_increasing_id())
    numbered.write.parquet(path)
    return source.sparkSession.read.schema(numbered.schema).parquet(path).toDF(*names, _SOURCE)


def _first_clause(clauses: Sequence[MergeClause], first: int) -> Column:
    """The code of the first clause whose condition holds, else 0."""
    code = F.lit(0)
    for n, clause in reversed(list(enumerate(clauses, first))):
        code = F.when(_holds(clause.when), n).otherwise(code)
    return code


def _reject_ambiguous(matches: DataFrame) -> None:
    pairs = matches.where(F.col(_SOURCE).isNotNull()).groupBy(_FILE, _ROW).agg(F.count(F.lit(1)).alias("n"))
    if not pairs.where("n > 1").isEmpty():
        raise AmbiguousMergeError("several source rows match the same target row")


def _rewritten(
    target: DataFrame,
    alias: str,
    source: DataFrame,
    matches: DataFrame,
    clauses: Sequence[MergeClause],
    place: _Place,
) -> DataFrame:
    """The rows of the files that are hit, after the clauses.

    A target row is found by its position, of which there is one each, and takes the source row by its
    number; the target is the streamed side of both joins, so a hot source row is split over tasks.
    """
    codes = matches.where(F.col(_HIT) > 0).select(
        F.col(_FILE).alias(_OF_FILE), F.col(_ROW).alias(_OF_ROW), F.col(_SOURCE).alias(_OF_SOURCE), _HIT
    )
    # A target row that the source does not match is there once; one that it matches has been checked.
    joined = target.join(codes, (F.col(_FILE) == F.col(_OF_FILE)) & (F.col(_ROW) == F.col(_OF_ROW)), "left")
    joined = joined.join(source, F.col(_OF_SOURCE) == F.col(_SOURCE), "left")
    code = F.coalesce(F.col(_HIT), F.lit(0))
    columns = []
    for field in place.schema.fields:
        value = F.col(f"{quote_identifier(alias)}.{quote_identifier(field.name)}")
        for n, clause in enumerate(clauses, 1):
            assigned = _by_target_name(place.names, clause.values or {})
            if field.name in assigned:
                value = F.when(code == n, _fitting(joined, assigned[field.name], field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    deleted = [n for n, clause in enumerate(clauses, 1) if clause.action == "delete"]
    return joined.where(~code.isin(deleted)).select(*columns) if deleted else joined.select(*columns)


def _added(missing: DataFrame, clauses: Sequence[MergeClause], place: _Place) -> DataFrame:
    coded = missing.withColumn(_HIT, _first_clause(clauses, 1)).where(F.col(_HIT) > 0)
    columns = []
    for field in place.schema.fields:
        value = F.lit(None).cast(field.dataType)
        for n, clause in enumerate(clauses, 1):
            given = _by_target_name(place.names, clause.values or {})
            if field.name in given:
                value = F.when(F.col(_HIT) == n, _fitting(coded, given[field.name], field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return coded.select(*columns)


# --- files --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class _Place:
    """Where a table lies, its columns, and which of them it is partitioned by."""

    location: str
    schema: T.StructType
    partitions: tuple[str, ...]

    @property
    def names(self) -> list[str]:
        return self.schema.names


def _place(spark: SparkSession, table: str) -> _Place:
    name = table_identifier(table)
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
    found = {row.col_name: row.data_type for row in details.collect()}
    if found.get("Provider", "").lower() != "parquet" or "Location" not in found:
        raise ValueError(f"{table} is not a Parquet table")
    partitions = tuple(c.name for c in spark.catalog.listColumns(name) if c.isPartition)
    spark.catalog.refreshTable(name)
    return _Place(found["Location"].rstrip("/"), spark.table(name).schema, partitions)


def _current(spark: SparkSession, table: str, alias: str | None) -> DataFrame:
    """The table's rows with their positions."""
    position = [F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.row_index").alias(_ROW)]
    current = spark.table(table_identifier(table)).select("*", *position)
    return current.alias(alias) if alias else current


def _hit_files(current: DataFrame, condition: str | Column | None) -> list[str]:
    """The files with rows for which the condition holds; at most those that Spark's own listing of the table holds."""
    return [row[0] for row in current.where(_holds(condition)).select(_FILE).distinct().collect()]


def _listing(spark: SparkSession, place: _Place) -> int:
    """A sum over the files that readers of the table see, which changes with any of them; it holds no list."""
    files, total = HadoopFiles(spark), 0
    root = files.qualified(place.location)
    for path, size in files.walk(root):
        if not path.startswith((f"{root}/_", f"{root}/.")):
            total += int.from_bytes(hashlib.sha256(f"{path} {size}".encode()).digest()[:16], "big")
    return total


def _replace(
    spark: SparkSession, table: str, place: _Place, hit: list[str], rows: DataFrame, changed, listed: int | None = None
) -> DmlResult:
    """Write the rows and put their files in place of the files hit."""
    if not hit and listed is None:
        return DmlResult(0, None)
    files, token = HadoopFiles(spark), uuid.uuid4().hex
    old = [files.of_uri(uri) for uri in hit]
    root = files.qualified(place.location)
    outside = [path for path in old if not path.startswith(root + "/")]
    if outside:
        raise ValueError(f"{table} has files outside its folder: {outside[0]}")
    staging, kept = f"{root}/_change-{token}", f"{root}/_replaced-{token}"
    try:
        wrote = Observation()
        counted = rows.observe(wrote, F.count(F.lit(1)).alias("rows"))
        counted.write.partitionBy(*place.partitions).parquet(staging)
        if listed is not None and _listing(spark, place) != listed:
            raise ConcurrentWriteError(f"{table} was written while it was being changed")
        made = [f for f in files.walk(staging) if f[0].rpartition("/")[2].startswith("part-")] if wrote.get["rows"] else []
        moves = [(path, kept + path[len(root) :]) for path in old]
        moves += [(path, root + path[len(staging) :]) for path, _ in made]
        _move_all(files, table, moves)
    finally:
        files.delete(staging)
    _add_partitions(spark, table, place, {path[len(staging) + 1 :].rpartition("/")[0] for path, _ in made})
    spark.catalog.refreshTable(table_identifier(table))
    return DmlResult(changed(), kept if old else None, len(old), sum(size for _, size in made))


def _move_all(files: HadoopFiles, table: str, moves: list[tuple[str, str]]) -> None:
    """All moves, or none: a file that is gone was changed by others."""
    with ThreadPoolExecutor(_MOVE_THREADS) as pool:
        done = list(pool.map(lambda move: files.move(*move), moves))
        if not all(done):
            back = [(target, source) for (source, target), moved in zip(moves, done, strict=True) if moved]
            list(pool.map(lambda move: files.move(*move), back))
            raise ConcurrentWriteError(f"{table} was changed by others while it was being changed")


def _add_partitions(spark: SparkSession, table: str, place: _Place, folders: set[str]) -> None:
    """Make the partitions that were written known to the catalog."""
    if not place.partitions:
        return
    specs = []
    for folder in sorted(folders):
        values = []
        for part in folder.split("/"):
            name, _, value = part.partition("=")
            text = "NULL" if value == "__HIVE_DEFAULT_PARTITION__" else "'" + _escaped(unquote(value)) + "'"
            values.append(f"{quote_identifier(unquote(name))} = {text}")
        specs.append(f"PARTITION ({', '.join(values)})")
    for at in range(0, len(specs), 100):
        spark.sql(f"ALTER TABLE {table_identifier(table)} ADD IF NOT EXISTS {' '.join(specs[at : at + 100])}")


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
