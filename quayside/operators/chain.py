"""Where files begin when each starts counting from nothing and is full at a byte or row limit.

A file that begins with row ``i`` ends before the first later row ``j`` whose weight before it is at
least ``room`` above that of ``i``, or that lies ``per_file`` rows behind ``i``.  So every row has a
successor, found by a search in the running totals, and the files begin at the rows on the way from
row 0 from successor to successor.  That way is sequential, but which rows of a stretch it can enter by
is known beforehand: those up to the successor of the stretch's first row.

Up: for every staged part, each entry's last file start in the part and the number of starts up to there
are found by pointer doubling.  Neighbouring stretches are then put together, a few at a time, into
longer ones, until one is left.  Down: the way through the whole says by which start each stretch is
reached, and at the parts it is walked.  Every step is a grouped job over bounded groups; a part's
running totals are eight bytes a row, and no list of files or parts passes through the driver.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.functions.naming import helper_name
from quayside.operators.numbering import BEFORE, NUMBER, PART, write_and_read

# The functions below travel with the job, so executors need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Neighbouring stretches that are put together at a time.
STRETCHES = 8

CELL = helper_name("cell")
#: In a cell of a part: the first row that begins a file, if any, and the file of the rows before it.
STARTS_AT, FILE_BEFORE = helper_name("starts_at"), helper_name("file_before")

_STRETCH = "unit bigint, rows array<bigint>, before array<bigint>, last array<bigint>, last_before array<bigint>, files array<bigint>"
_ARRIVAL = "unit bigint, last bigint, last_before bigint, files bigint"


@dataclass(frozen=True)
class FileLimit:
    """Weight after which a file is full, and its rows at most, if limited."""

    room: int
    per_file: int | None

    def first_reached(self, rows: np.ndarray, before: np.ndarray, last, last_before) -> np.ndarray:
        """Which of the entries is the first that a file that begins at ``last`` does not take; their number, if it takes all."""
        at = np.searchsorted(before, last_before + self.room, "left")
        if self.per_file is not None:
            at = np.minimum(at, np.searchsorted(rows, last + self.per_file, "left"))
        return at

    def successors(self, before: np.ndarray) -> np.ndarray:
        """For each row of a part the place of its successor; the number of rows, if that lies behind the part."""
        here = np.arange(len(before))
        found = np.maximum(np.searchsorted(before, before + self.room, "left"), here + 1)
        if self.per_file is not None:
            found = np.minimum(found, here + self.per_file)
        return np.minimum(found, len(before))


@dataclass(frozen=True)
class _Stretch:
    """The rows by which a stretch can be entered, and where the way from each leaves it."""

    rows: np.ndarray
    before: np.ndarray
    last: np.ndarray
    last_before: np.ndarray
    files: np.ndarray

    @classmethod
    def of(cls, table: pa.Table, row: int) -> _Stretch:
        return cls(*(_array(table[name], row) for name in ("rows", "before", "last", "last_before", "files")))


def _array(column: pa.ChunkedArray, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False)


def _ordered(table: pa.Table) -> pa.Table:
    return table.sort_by("unit")


def _stretch_table(unit: int, parts: list[np.ndarray]) -> pa.Table:
    names = ("rows", "before", "last", "last_before", "files")
    columns = {n: pa.array([p], pa.list_(pa.int64())) for n, p in zip(names, parts, strict=True)}
    return pa.table({"unit": pa.array([unit], pa.int64()), **columns})


def _totals_of_part(table: pa.Table) -> pa.Table:
    """One row for a part: its first row's number, and the weight before each of its rows."""
    order = np.argsort(table["number"].to_numpy())
    number = int(table["number"][int(order[0])].as_py())
    before = table["before"].to_numpy()[order]
    return pa.table(
        {
            "unit": table["unit"].slice(0, 1),
            "first": pa.array([number], pa.int64()),
            "totals": pa.array([before], pa.list_(pa.int64())),
        }
    )


def _enter_part(limit: FileLimit) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        before, first = _array(table["totals"], 0), table["first"][0].as_py()
        successor, here = limit.successors(before), np.arange(len(before))
        inside = successor < len(before)
        jump, steps = np.where(inside, successor, here), inside.astype(np.int64)
        while True:
            further = jump[jump]
            if (further == jump).all():
                break
            steps, jump = steps + steps[jump], further
        entries = min(int(successor[0]), len(before) - 1) + 1
        jump = jump[:entries]
        parts = [first + here[:entries], before[:entries], first + jump, before[jump], steps[:entries] + 1]
        return _stretch_table(table["unit"][0].as_py(), parts)

    return run


def _join_stretches(limit: FileLimit) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        table = _ordered(table)
        stretches = [_Stretch.of(table, row) for row in range(len(table))]
        whole = [np.concatenate([getattr(s, n) for s in stretches]) for n in ("rows", "before", "last", "last_before", "files")]
        owner = np.repeat(np.arange(len(stretches)), [len(s.rows) for s in stretches])
        reached = int(limit.first_reached(whole[0], whole[1], whole[0][0], whole[1][0]))
        rows, before, last, last_before, files = (w[: reached + 1].copy() for w in whole)
        owner = owner[: reached + 1]
        for n, stretch in enumerate(stretches):
            ahead = np.flatnonzero(owner < n)
            at = limit.first_reached(stretch.rows, stretch.before, last[ahead], last_before[ahead])
            ahead, at = ahead[at < len(stretch.rows)], at[at < len(stretch.rows)]
            last[ahead], last_before[ahead] = stretch.last[at], stretch.last_before[at]
            files[ahead] += stretch.files[at]
        return _stretch_table(table["unit"][0].as_py() // STRETCHES, [rows, before, last, last_before, files])

    return run


def _arrive(limit: FileLimit) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """How each of some stretches is reached, if it is known for all of them together."""

    def run(stretches: pa.Table, arrival: pa.Table) -> pa.Table:
        stretches = _ordered(stretches)
        last, last_before, files = (arrival[n][0].as_py() for n in ("last", "last_before", "files"))
        out = []
        for row in range(len(stretches)):
            out.append((stretches["unit"][row].as_py(), last, last_before, files))
            stretch = _Stretch.of(stretches, row)
            at = int(limit.first_reached(stretch.rows, stretch.before, last, last_before))
            if at < len(stretch.rows):
                last, last_before = int(stretch.last[at]), int(stretch.last_before[at])
                files += int(stretch.files[at])
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("unit", "last", "last_before", "files"), zip(*out), strict=True)})

    return run


def _walk_part(limit: FileLimit) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """A row for each cell of a part, and the rows that begin files."""

    def run(part: pa.Table, arrival: pa.Table) -> pa.Table:
        before, first = _array(part["totals"], 0), part["first"][0].as_py()
        last, last_before, files = (arrival[n][0].as_py() for n in ("last", "last_before", "files"))
        successor = limit.successors(before)
        at = int(limit.first_reached(first + np.arange(len(before)), before, last, last_before))
        starts = []
        while at < len(before):
            starts.append(at)
            at = int(successor[at])
        starts = np.array(starts, dtype=np.int64)
        start_cells = before[starts] // limit.room
        cells = np.unique(before // limit.room)
        passed = np.searchsorted(start_cells, cells, "left")
        has = (passed < len(starts)) & (np.append(start_cells, -1)[passed] == cells)
        begins = np.append(starts, 0)[passed] + first
        n = len(cells)
        return pa.table(
            {
                "unit": pa.array(np.full(n, part["unit"][0].as_py()), pa.int64()),
                "cell": pa.array(cells, pa.int64()),
                "starts_at": pa.array(begins, pa.int64(), mask=~has),
                "file_before": pa.array(files + passed - 1, pa.int64()),
                # All starts of the cell, to number and size the files.
                "starts": pa.array(
                    np.split(starts + first, np.searchsorted(start_cells, cells[1:], "left")), pa.list_(pa.int64())
                ),
            }
        )

    return run


@dataclass(frozen=True)
class Cells:
    """Written tables of where files begin."""

    lookup: DataFrame
    """PART, CELL, STARTS_AT, FILE_BEFORE: one row for each cell of weight that a part has rows in."""
    starts: DataFrame
    """file_id, first: the number of each file's first row."""


def file_starts(numbered: DataFrame, limit: FileLimit, scratch: str) -> Cells:
    """Follow the files through numbered, weighted rows; ``scratch`` takes what is staged."""
    rows = numbered.select(
        F.col(PART).cast("bigint").alias("unit"), F.col(NUMBER).alias("number"), F.col(BEFORE).alias("before")
    )
    totals = write_and_read(
        rows.groupBy("unit").applyInArrow(_totals_of_part, "unit bigint, first bigint, totals array<bigint>"),
        f"{scratch}/totals",
    )
    levels = [write_and_read(totals.groupBy("unit").applyInArrow(_enter_part(limit), _STRETCH), f"{scratch}/level_0")]
    above = F.expr(f"unit div {STRETCHES}").alias("above")
    units = totals.agg(F.max("unit")).first()[0]
    while units >= STRETCHES:
        joined = levels[-1].groupBy(above).applyInArrow(_join_stretches(limit), _STRETCH)
        levels.append(write_and_read(joined, f"{scratch}/level_{len(levels)}"))
        units //= STRETCHES
    # Before the first row, as if a file had just been filled.
    start = (0, -(limit.per_file or 0), -limit.room, 0)
    arrivals = numbered.sparkSession.createDataFrame([start], _ARRIVAL)
    for level in reversed(levels):
        arrivals = level.groupBy(above).cogroup(arrivals.groupBy("unit")).applyInArrow(_arrive(limit), _ARRIVAL)
    walked = totals.groupBy("unit").cogroup(arrivals.groupBy("unit")).applyInArrow(
        _walk_part(limit), "unit bigint, cell bigint, starts_at bigint, file_before bigint, starts array<bigint>"
    )
    cells = write_and_read(walked, f"{scratch}/cells")
    lookup = cells.select(
        F.col("unit").alias(PART), F.col("cell").alias(CELL), F.col("starts_at").alias(STARTS_AT), F.col("file_before").alias(FILE_BEFORE)
    )
    starts = cells.select("file_before", F.posexplode("starts").alias("n", "first"))
    return Cells(lookup, starts.select((F.col("file_before") + F.col("n") + 1).alias("file_id"), "first"))
