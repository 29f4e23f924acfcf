"""Which of very many things occur at least so often: a table of counters of fixed size.

Things are hashed to counters.  Several may share one, so a seldom thing may pass for a frequent one, but
never the other way round.  A task's counters stop at the threshold, which takes nothing from the answer:
the sum reaches it if one of them has, and is exact otherwise.  They are sent as compressed blocks, which
are added up in groups of bounded size, in rounds; a bitmap of fixed size comes back.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import Staged

#: Counters (a power of two), counters of a block, and blocks that are added up in one group.
COUNTERS, BLOCK, _GROUP = 1 << 24, 1 << 16, 256

Tally = Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(29))


def counter_of(hashes: np.ndarray, counters: int = COUNTERS) -> np.ndarray:
    """The counter of a thing by its hash."""
    return (mixed(hashes) * np.uint64(0x94D049BB133111EB) >> np.uint64(65 - counters.bit_length())).astype(np.int64)


def held(bits: np.ndarray, counters: np.ndarray) -> np.ndarray:
    return (bits[counters >> 3] >> (counters & 7).astype(np.uint8) & 1).astype(bool)


def _packed(counters: np.ndarray) -> bytes:
    return pa.compress(counters.tobytes(), codec="zstd", asbytes=True)


def _unpacked(content: bytes, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(pa.decompress(content, BLOCK * kind.itemsize, codec="zstd", asbytes=True), dtype=kind)


def _count(tally: Tally, least: int, size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = np.zeros(size, dtype=np.min_scalar_type(least))
        for found in tally(batches):
            places, times = np.unique(found, return_counts=True)
            counters[places] = np.minimum(counters[places].astype(np.int64) + times, least)
        blocks = counters.reshape(-1, BLOCK)
        there = np.flatnonzero(blocks.any(axis=1))
        for at in range(0, len(there), 16):
            part = there[at : at + 16]
            packed = pa.array([_packed(blocks[b]) for b in part], pa.binary())
            yield pa.RecordBatch.from_pydict({"block": pa.array(part, pa.int64()), "counters": packed})

    return run


def _add(least: int) -> Callable[[pa.Table], pa.Table]:
    kind = np.min_scalar_type(least)

    def run(rows: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, dtype=np.int64)
        for content in rows["counters"]:
            total += _unpacked(content.as_py(), kind)
        total = np.minimum(total, least).astype(kind)
        part = pa.array([rows["part"][0].as_py() // _GROUP], pa.int64())
        return pa.table({"block": rows["block"].slice(0, 1), "part": part, "counters": pa.array([_packed(total)], pa.binary())})

    return run


def frequent(spark: SparkSession, frame: DataFrame, tally: Tally, least: int, counters: int = COUNTERS) -> np.ndarray:
    """A bitmap of the counters that reach the threshold: bit ``c % 8`` of byte ``c // 8`` for counter ``c``.

    ``tally`` gives the counters of the things in a task's rows, with repeats, some at a time.
    """
    staged = Staged(spark, "counters")
    counted = frame.mapInArrow(_count(tally, least, counters), "block bigint, counters binary")
    level = staged(counted.withColumn("part", F.spark_partition_id().cast("bigint")))
    parts = level.agg(F.max("part").alias("m")).first().m
    while parts:
        grouped = level.withColumn("group", F.expr(f"part div {_GROUP}")).groupBy("block", "group")
        added = staged(grouped.applyInArrow(_add(least), "block bigint, part bigint, counters binary"))
        staged.drop(level)
        level, parts = added, parts // _GROUP
    bits, kind = np.zeros(counters // 8, dtype=np.uint8), np.min_scalar_type(least)
    # One row for each of a fixed number of blocks.
    for row in level.toLocalIterator():
        reached = np.packbits(_unpacked(bytes(row.counters), kind) >= least, bitorder="little")
        bits[row.block * BLOCK // 8 : (row.block + 1) * BLOCK // 8] = reached
    staged.drop(level)
    return bits
