"""What the operators of this package share: staged tables, samples, words and their n-grams."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.storage import HadoopFiles, scratch_dir

#: Text that a task takes into its arrays at once.
SLICE_BYTES = 1 << 20
#: Words that a worker remembers between batches.
REMEMBERED_WORDS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Have the executors' Python import this package, wherever the driver's came from."""
    context = spark.sparkContext
    if getattr(context, "_quayside_shipped", False):
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="quayside-")) / "quayside_code.zip"
    with zipfile.ZipFile(archive, "w") as file:
        for path in sorted(package.rglob("*.py")):
            file.write(path, path.relative_to(package.parent))
    context.addPyFile(str(archive))
    context._quayside_shipped = True


class Staged:
    """Tables written to the shared folder, which cut lineage; those not needed at the end are dropped."""

    def __init__(self, spark: SparkSession, label: str):
        self._spark, self._label, self._paths = spark, label, {}

    def __call__(self, frame: DataFrame, codec: str = "snappy") -> DataFrame:
        path = scratch_dir(self._spark, self._label)
        frame.write.option("compression", codec).parquet(path)
        read = self._spark.read.schema(frame.schema).parquet(path)
        self._paths[id(read)] = path
        return read

    def drop(self, *frames: DataFrame) -> None:
        files = HadoopFiles(self._spark)
        for frame in frames:
            files.delete(self._paths.pop(id(frame)))


def crc32_of(column: str) -> Column:
    """CRC-32 of the value as text; a null counts as an empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def bounded(frame: DataFrame, rows: int, seed: int) -> DataFrame:
    """``rows`` distinct rows, or somewhat fewer; all rows as they are, if there are not more.

    The pick goes by a hash of the whole row, so that rows that share a key, or have none, are drawn each by
    itself, and a lost executor changes nothing.  Rows that are equal in all columns are drawn once.
    """
    there = frame.count()
    if there <= rows:
        return frame
    pick = F.pmod(F.xxhash64(F.lit(seed), *frame.columns), F.lit(1 << 30))
    share = min(1 << 30, int((1.1 * rows + 16) / there * (1 << 30)))
    return frame.where(pick < share).distinct().orderBy(pick, *frame.columns).limit(rows)


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The array in runs of about ``limit`` bytes of text, at least one row each."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, "right")))
        yield texts.slice(start, stop - start)
        start = stop


def segment_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of runs of the first axis; ``counts`` are the runs' lengths, zero included."""
    out = np.zeros((len(counts), *values.shape[1:]), dtype=np.float64)
    full = counts > 0
    if full.any():
        starts = (np.cumsum(counts) - counts)[full]
        out[full] = np.add.reduceat(values, starts, axis=0)
    return out


_KEPT: dict[str, object] = {}


def worker_wide(make):
    """A function that makes an object once per worker process, where the next tasks of the job find it again.

    Workers outlive jobs, so a worker keeps the object of the latest job alone.
    """
    token = uuid.uuid4().hex

    def get():
        if token not in _KEPT:
            _KEPT.clear()
            _KEPT[token] = make()
        return _KEPT[token]

    return get


class Remembered(dict):
    """What was made of words, kept in two generations: used words outlive the bound, others go."""

    def __init__(self, make, bound: int = 2 * REMEMBERED_WORDS):
        super().__init__()
        self._make, self._bound, self._before = make, bound // 2, {}

    def __missing__(self, word: str):
        found = self._before.get(word)
        if found is None:
            found = self._make(word)
        self[word] = found
        return found

    def unknown(self, words: set) -> list:
        """Those never made or already forgotten; the others are at hand from now on."""
        rest = words - self.keys()
        if self._before:
            self.update((w, self._before[w]) for w in rest & self._before.keys())
            rest -= self._before.keys()
        return list(rest)

    def settle(self) -> None:
        """Forget what was not used since the last time that the memory was full."""
        if len(self) > self._bound:
            self._before = dict(self)
            self.clear()


class Words(dict):
    """Row number of each word; an unknown word gets the next number."""

    def __missing__(self, word: str) -> int:
        row = self[word] = len(self)
        return row


class WordTable:
    """Features of words, made once per distinct word and kept between batches up to a bound."""

    def __init__(self, features, width: int, bound: int = REMEMBERED_WORDS):
        self._features, self._bound = features, bound
        self._words, self._rows = Words(), np.zeros((0, width), dtype=np.float32)

    def __call__(self, documents: Iterable[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers of all words, words per document, and the table that the numbers point into."""
        if len(self._words) > self._bound:
            self._words, self._rows = Words(), self._rows[:0]
        known, get = len(self._words), self._words.__getitem__
        counts, parts = [], []
        for words in documents:
            counts.append(len(words))
            parts.append(np.fromiter(map(get, words), dtype=np.int32, count=len(words)))
        if len(self._words) > known:
            fresh = list(self._words)[known:]
            self._rows = np.concatenate([self._rows, self._features(fresh)])
        rows = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
        return rows, np.array(counts, dtype=np.int64), self._rows


def ngrams(words: list[str], sizes: Iterable[int], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every character n-gram of ``<word>``, and the number of the word it is from."""
    joined = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 2
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(joined))
    found, owners = [], []
    rolled = np.zeros(len(joined), dtype=np.uint64)
    for size in range(1, max(sizes, default=0) + 1):
        here = len(joined) - size + 1
        if here <= 0:
            break
        rolled = rolled[:here] * np.uint64(0x100000001B3) + joined[size - 1 :].astype(np.uint64) + np.uint64(1)
        if size in sizes:
            whole = left[:here] >= size
            mixed = (rolled[whole] + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            found.append(((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64))
            owners.append(owner[:here][whole])
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found), np.concatenate(owners)
