"""Packing token sequences by best-two-fit.

Documents become token pieces of at most ``capacity`` tokens.  Packing looks only at how many pieces
there are of each length, a table of at most ``capacity`` numbers whatever the corpus: a bin is
filled greedily with the longest piece that fits; then its smallest piece is replaced by the two
unpacked pieces that fit the widened gap more tightly, as long as that helps; the finished bin is
repeated while its lengths last.  Each repetition uses up a length of the bin, so the plan has a few
thousand lines at most.  Pieces are then numbered within their length, in parallel, and look up
their place in the plan.

Defined results: a null text counts as empty; an empty text is the end token alone; repeated rows
are packed each for itself; an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right
from struct import pack as pack_ints

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import slices, worker_wide, Remembered, Staged

CAPACITY = 1024
#: Pieces that one task numbers within a length, and the most groups that a length is cut into.
_GROUP_ROWS, _MOST_GROUPS = 250_000, 4096
_SPECIAL = "<|endoftext|>"
_SIMPLE = re.compile("[!-~\n¡-¬®-ɏ]*")


def _byte_of_mark() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


def _packed(ids: list[int]) -> bytes:
    return pack_ints(f"<{len(ids)}I", *ids)


class ByteEncoder:
    """Ids of texts as little-endian bytes, by words that are encoded once and remembered.

    A blank between two characters that are no white space always begins a token, so what it begins
    can be encoded by itself.  A text where that doesn't hold everywhere is encoded whole.
    """

    def __init__(self, tokenizer_json: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_str(tokenizer_json)
        marks = _byte_of_mark()
        vocabulary = json.loads(tokenizer_json)["model"]["vocab"]
        ranks = {bytes(map(marks.__getitem__, piece)): n for piece, n in vocabulary.items() if piece != _SPECIAL}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self._fast = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._inner = Remembered(lambda word: self.word(" ", word))
        self._first = Remembered(lambda word: self.word("", word))

    def whole(self, text: str) -> bytes:
        return _packed(self._whole.encode(text, add_special_tokens=False).ids)

    def word(self, lead: str, word: str) -> bytes | None:
        """None: the word's edges may join its neighbours'."""
        if not word or _SPECIAL in word:
            return None
        if word.isascii() and word.isprintable() or _SIMPLE.fullmatch(word) and word[0] != "\n" != word[-1]:
            return _packed(self._fast.encode_ordinary(lead + word))
        if not all(c.isalnum() or "!" <= c <= "~" for c in (word[0], word[-1])):
            return None
        return self.whole(lead + word)

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        self._inner.settle()
        self._first.settle()
        first, *rest = text.split(" ")
        try:
            return self._first[first] + b"".join(map(self._inner.__getitem__, rest))
        except TypeError:
            return self.whole(text)


def cut(tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces; only the first may be shorter than the capacity."""
    first = tokens % capacity or min(tokens, capacity)
    return [(0, first)] + [(start, capacity) for start in range(first, tokens, capacity)]


_PIECES = "array<struct<piece: int, start: bigint, length: bigint, ids_crc32: bigint{ids}>>"


def pieces(text: Column, tokenizer_json: str, end: int = 2, capacity: int = CAPACITY, with_ids: bool = False) -> Column:
    """The token pieces of a text and its end token; with ``with_ids`` also their ids."""

    memory = worker_wide(lambda: ByteEncoder(tokenizer_json))

    def encode(texts: pa.Array) -> pa.Array:
        last = np.array([end], dtype="<u4").tobytes()
        counts, number, starts, lengths, sums, ids = [0], [], [], [], [], []
        for part in slices(texts):
            for text in part.to_pylist():
                data = memory()(text) + last
                found = cut(len(data) // 4, capacity)
                counts.append(len(found))
                for k, (start, length) in enumerate(found):
                    own = data[4 * start : 4 * (start + length)]
                    number.append(k)
                    starts.append(start)
                    lengths.append(length)
                    sums.append(zlib.crc32(own))
                    if with_ids:
                        ids.append(own)
        columns = {
            "piece": pa.array(number, pa.int32()), "start": pa.array(starts, pa.int64()),
            "length": pa.array(lengths, pa.int64()), "ids_crc32": pa.array(sums, pa.int64()),
        }
        if with_ids:
            flat = pa.array(np.frombuffer(b"".join(ids), dtype="<u4").astype(np.int32))
            columns["ids"] = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *lengths]), pa.int32()), flat)
        rows = pa.StructArray.from_arrays(list(columns.values()), list(columns))
        return pa.ListArray.from_arrays(pa.array(np.cumsum(counts), pa.int32()), rows)

    schema = _PIECES.format(ids=", ids: array<int>" if with_ids else "")
    return F.arrow_udf(encode, schema).asNondeterministic()(text)


def fill(there: dict[int, int], capacity: int) -> list[int]:
    """The lengths of one bin: greedily the longest that fit, then two for the smallest while that is tighter."""
    sizes = sorted(size for size, count in there.items() if count)
    left = dict(there)

    def longest(most: int) -> int | None:
        k = bisect_right(sizes, most)
        while k:
            k -= 1
            if left[sizes[k]]:
                return sizes[k]
        return None

    held, gap = [], capacity
    while (size := longest(gap)) is not None:
        held.append(size)
        left[size] -= 1
        gap -= size
    while gap and len(held) > 1:
        smallest = held[-1]
        room = gap + smallest
        best = (smallest, 0, 0)
        for larger in reversed(sizes[: bisect_right(sizes, room)]):
            if 2 * larger <= best[0] or best[0] == room:
                break
            if not left[larger]:
                continue
            left[larger] -= 1
            smaller = longest(min(larger, room - larger))
            left[larger] += 1
            if smaller is not None and larger + smaller > best[0]:
                best = (larger + smaller, larger, smaller)
        if best[0] == smallest:
            break
        held.pop()
        left[smallest] += 1
        for size in best[1:]:
            left[size] -= 1
            held.append(size)
        held.sort(reverse=True)
        gap = room - best[0]
    return held


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Lines (length, first rank, end rank, first sequence, offset), in order of length and rank."""
    there = {size: count for size, count in counts.items() if count}
    taken, lines, sequence = dict.fromkeys(there, 0), [], 0
    while there:
        held = fill(there, capacity)
        uses = {size: held.count(size) for size in held}
        times = min(there[size] // use for size, use in uses.items())
        offset = 0
        for size in held:
            lines.append((size, taken[size], taken[size] + times, sequence, offset))
            taken[size] += times
            there[size] -= times
            offset += size
        sequence += times
        there = {size: count for size, count in there.items() if count}
    return np.array(sorted(lines), dtype=np.int64).reshape(-1, 5)


def place(spark: SparkSession, rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``rows`` (with ``doc_id``, ``piece``, ``length``, ``ids_crc32`` and ``_row``) and their ``sequence_id`` and ``offset``.

    ``rows`` are read twice: give a written table, in which ``_row`` is each row's own number.
    """
    groups = int(min(_MOST_GROUPS, max(8, rows.count() // _GROUP_ROWS)))
    dealt = rows.withColumn("_group", F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("int"))
    found = dealt.groupBy("length", "_group").count().toArrow()
    counts = np.zeros((capacity + 1, groups), dtype=np.int64)
    counts[found["length"].to_numpy(), found["_group"].to_numpy()] = found["count"].to_numpy()
    before = np.cumsum(counts, axis=1) - counts
    lines = plan({n: int(c) for n, c in enumerate(counts.sum(axis=1)) if c}, capacity)
    keys = (lines[:, 0] << 44) + lines[:, 1]

    def look_up(length: pa.Array, group: pa.Array, number: pa.Array) -> pa.Array:
        size, own = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (length, group))
        rank = before[size, own] + number.to_numpy(zero_copy_only=False).astype(np.int64) - 1
        line = lines[np.searchsorted(keys, (size << 44) + rank, "right") - 1] if len(lines) else lines
        return pa.StructArray.from_arrays(
            [pa.array(line[:, 3] + rank - line[:, 1]), pa.array(line[:, 4])], ["sequence_id", "offset"]
        )

    numbered = dealt.withColumn(
        "_number", F.expr("row_number() OVER (PARTITION BY length, _group ORDER BY _row)")
    )
    look = F.arrow_udf(look_up, "struct<sequence_id: bigint, offset: bigint>")
    placed = numbered.withColumn("_place", look("length", "_group", "_number"))
    return placed.select(*(c for c in rows.columns if c != "_row"), "_place.sequence_id", "_place.offset")


def pack(
    spark: SparkSession,
    documents: DataFrame,
    tokenizer: str,
    key: str = "doc_id",
    text: str = "text",
    end: int = 2,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """All documents as packed pieces: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` (and ``ids``).

    ``tokenizer`` is the path of a byte-level tokenizer file on the driver.
    """
    with open(tokenizer, encoding="utf-8") as file:
        content = file.read()
    found = pieces(F.col("t"), content, end, capacity, with_ids)
    rows = documents.select(F.col(key).alias("doc_id"), F.col(text).alias("t")).select("doc_id", F.explode(found).alias("p"))
    numbered = rows.select("doc_id", "p.*", F.monotonically_increasing_id().alias("_row"))
    return place(spark, Staged(spark, "pieces")(numbered), capacity)
