"""Exact top-k by inner product over a bit-sliced index.

Vectors of integers are dealt into blocks.  A block's index holds, for every component, the bits of
its values above the component's least one, one bitmap over the rows per bit; the lowest bits are
left out (quantised).  A query adds the slices of its components, times its own bits, by bitmap
arithmetic (carry-save adders), many queries at a time; a negative factor adds the complement.
From the sum's most significant slice downward the k best rows' bound is found; all rows that the
left-out bits could lift to it are boundary rows and are scored exactly.

Defined results: vectors that are null, or hold a null or non-finite component, and rows without an
id take no part.  Vectors of another length than the query's are no candidates; nor are rows with
the query's id.  A repeated query row is answered once.  Ties go to the smaller id.  Scores are
exact while they fit a long.  An empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a block, queries that meet a block in one task, and queries that are added at a time.
BLOCK_ROWS, CHUNK_QUERIES, _AT_ONCE = 8192, 2048, 32
#: Low bits that the index leaves out.
LEFT_OUT = 1


def _bitmaps(bits: np.ndarray) -> np.ndarray:
    """Rows' booleans (last axis) as words of 64."""
    short = -bits.shape[-1] % 64
    padded = np.concatenate([bits, np.zeros((*bits.shape[:-1], short), dtype=bool)], axis=-1)
    return np.ascontiguousarray(np.packbits(padded, axis=-1, bitorder="little")).view(np.uint64)


class Block:
    """The bit-sliced index of some rows."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, left_out: int = LEFT_OUT):
        self.ids, self.vectors, self.left_out = ids, vectors, left_out
        self.least = vectors.min(axis=0)
        above = (vectors - self.least) >> left_out
        self.depth = max(1, int(above.max(initial=0)).bit_length())
        self.slices = np.stack([_bitmaps((above >> bit & 1).astype(bool).T) for bit in range(self.depth)], axis=1)
        self.rows = _bitmaps(np.ones((1, len(ids)), dtype=bool))[0]

    def add(self, queries: np.ndarray) -> list[np.ndarray]:
        """The slices, lowest first, of every row's sum of |q| times its quantised component or the complement."""
        size, turn = np.abs(queries), queries < 0
        every, none = np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0)
        waiting: list[list[np.ndarray]] = []

        def push(bitmap: np.ndarray, weight: int) -> None:
            while True:
                while len(waiting) <= weight:
                    waiting.append([])
                waiting[weight].append(bitmap)
                if len(waiting[weight]) < 3:
                    return
                a, b, c = waiting[weight]
                either = a ^ b
                waiting[weight] = [either ^ c]
                bitmap, weight = (a & b) | (either & c), weight + 1

        for d in range(queries.shape[1]):
            turned = np.where(turn[:, d], every, none)[:, None]
            for bit in range(int(size[:, d].max(initial=0)).bit_length()):
                on = np.where(size[:, d] >> bit & 1, every, none)[:, None]
                for depth in range(self.depth):
                    push((self.slices[d, depth][None, :] ^ turned) & on, bit + depth)
        out, weight = [], 0
        while weight < len(waiting):
            if len(waiting[weight]) == 2:
                a, b = waiting[weight]
                waiting[weight] = [a ^ b]
                push(a & b, weight + 1)
            out.append(waiting[weight][0] if waiting[weight] else np.zeros((len(queries), len(self.rows)), dtype=np.uint64))
            weight += 1
        return out

    def best(self, query_ids: np.ndarray, queries: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(ids, scores) of each query's best rows, best first."""
        if not queries.shape[1]:
            sums = [np.zeros((len(queries), len(self.rows)), dtype=np.uint64)]
        else:
            sums = self.add(queries)
        there = np.stack([_bitmaps((self.ids != q)[None, :])[0] for q in query_ids]) & self.rows
        sure, open_ = np.zeros_like(there), there.copy()
        bound = [0] * len(queries)
        for weight in reversed(range(len(sums))):
            ones = open_ & sums[weight]
            enough = np.bitwise_count(sure | ones).sum(axis=1) >= k
            for row in np.flatnonzero(enough):
                bound[row] |= 1 << weight
            sure = np.where(enough[:, None], sure, sure | ones)
            open_ = np.where(enough[:, None], ones, open_ & ~sums[weight])
        # What the left-out bits may be worth, from the worst to the best case.
        slack = np.abs(queries).sum(axis=1) * ((1 << self.left_out) - 1)
        out = []
        for row, query in enumerate(queries):
            least = max(0, bound[row] - -(-int(slack[row]) >> self.left_out))
            above, level = np.zeros_like(self.rows), there[row]
            if least >> len(sums):
                level = above
            for weight in reversed(range(len(sums))):
                if least >> weight & 1:
                    level = level & sums[weight][row]
                else:
                    above, level = above | (level & sums[weight][row]), level & ~sums[weight][row]
            boundary = np.flatnonzero(np.unpackbits((above | level).view(np.uint8), bitorder="little")[: len(self.ids)])
            scores = self.vectors[boundary] @ query
            order = np.lexsort((self.ids[boundary], -scores))[:k]
            out.append((self.ids[boundary][order], scores[order]))
        return out


def _meet(k: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        def matrix(table: pa.Table) -> np.ndarray:
            column = table["vector"].combine_chunks()
            return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)

        columns: dict[str, list] = {"query_id": [], "tag": [], "vec_id": [], "score": []}
        if len(rows) and len(queries):
            block = Block(rows["id"].to_numpy(), matrix(rows))
            ids, tags, wanted = queries["id"].to_numpy(), queries["tag"].to_numpy(), matrix(queries)
            for at in range(0, len(ids), _AT_ONCE):
                part = slice(at, at + _AT_ONCE)
                for q, tag, (found, scores) in zip(ids[part], tags[part], block.best(ids[part], wanted[part], k), strict=True):
                    columns["query_id"] += [q] * len(found)
                    columns["tag"] += [tag] * len(found)
                    columns["vec_id"] += found.tolist()
                    columns["score"] += scores.tolist()
        return pa.table({name: pa.array(values, pa.int64()) for name, values in columns.items()})

    return run


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query row's best rows by inner product of ``floor(scale * x)``.

    ``is_query`` is a condition on the id, named ``id``.
    """
    x = F.col(vector)
    fit = F.col(key).isNotNull() & x.isNotNull()
    fit &= ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("bigint"))
    rows = vectors.where(fit).select(F.col(key).cast("bigint").alias("id"), whole.alias("vector"))
    counts = rows.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")).first()
    blocks, chunks = max(1, -(-counts.n // BLOCK_ROWS)), max(1, -(-counts.q // CHUNK_QUERIES))
    group = ["width", "block", "chunk"]
    index = rows.withColumns({"width": F.size("vector"), "block": F.pmod(F.monotonically_increasing_id(), F.lit(blocks)).cast("int")})
    index = index.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
    queries = rows.where(is_query).withColumn("tag", F.xxhash64("vector")).dropDuplicates(["id", "tag"])
    queries = queries.withColumns({"width": F.size("vector"), "chunk": F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")})
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    met = index.groupBy(group).cogroup(queries.groupBy(group)).applyInArrow(
        _meet(k), "query_id bigint, tag bigint, vec_id bigint, score bigint"
    )
    ranked = met.selectExpr("*", "row_number() OVER (PARTITION BY query_id, tag ORDER BY score DESC, vec_id) AS rank")
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
