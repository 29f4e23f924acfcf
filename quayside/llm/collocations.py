"""Phrases whose words stand together more often than their parts would by chance.

Texts are cut into pieces at sentence marks and line ends, pieces into words.  Every word begins one
window of up to five words: the word and its leads, padded with nulls where the piece ends.  Only these
longest windows are counted; a ROLLUP over the window's columns then sums them over successively shorter
prefixes, which gives the number of every shorter phrase, of single words and of all words of a language
in one aggregation, without an explosion for each length.

A window is also padded behind neighbours and triples that occur too seldom: no phrase through such ones can be
frequent.  They are told apart by a counter table of fixed size, in two readings, the second of triples whose
pairs are left.  Things may share a counter, so a seldom one may stay, but a frequent one never goes: the counts of
frequent phrases are exact.  Most windows are one word then, and these roll up over one column.

Defined results: null texts count as empty and give nothing; a null language is ``und``; repeated rows
count again; an empty table gives no rows.  Ties end at the phrase, which is unique within a language.
Long texts, and long pieces in them, are read through in stretches that overlap by a window.  Only the
named columns are read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import Staged, Words, slices
from quayside.llm.counters import Tally, counter_of, frequent, held, mixed

#: Words of the longest phrase.
LONGEST = 5
#: Text whose words a task has at hand at once.
_STRETCH = 4 << 20
#: Windows that a task adds up before it hands them on.
_MOST_WINDOWS = 1 << 20
#: Groups that a language's phrases are first ranked in.
_SALTS = 64

_COLUMNS = [f"w{k}" for k in range(1, LONGEST + 1)]
_BREAK = b"."
#: Lower-case ASCII, one mark for all ends of pieces, and blanks for tabs.
_PLAIN = bytes.maketrans(
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + _BREAK * 10 + b" "
)


def _stretches(data: bytes) -> Iterator[tuple[list[bytes], int]]:
    """Words and breaks, some MB at a time, and how many of the first ones begin windows here."""
    carried: list[bytes] = []
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > _STRETCH:
            end = data.rfind(b" ", at, at + _STRETCH) + 1
            if not end:
                end = data.find(b" ", at + _STRETCH) + 1 or len(data)
        words = carried + data[at:end].replace(_BREAK, b" . ").split()
        at = end
        begins = max(0, len(words) - LONGEST + 1) if at < len(data) else len(words)
        yield words, begins
        carried = words[begins:]


def _of_slices(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], int]]:
    """The language, words and number of windows of every stretch of a task's rows."""
    for batch in batches:
        table = pa.table({"lang": batch.column(0), "text": batch.column(1)})
        done = 0
        for part in slices(table["text"].combine_chunks(), _STRETCH):
            rows = table.slice(done, len(part))
            done += len(part)
            langs = rows["lang"].combine_chunks()
            for lang in pc.unique(langs).to_pylist():
                own = rows["text"].combine_chunks().filter(pc.equal(langs, lang))
                data = _BREAK.join(t for t in own.cast(pa.binary()).to_pylist() if t)
                for words, begins in _stretches(data.translate(_PLAIN)):
                    yield lang, words, begins


def _coded(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words, the break first, and each word's number among them."""
    numbers = Words({_BREAK: 0})
    codes = np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))
    return list(numbers), codes


class _Stretch:
    """The words of a stretch of text by their numbers, with breaks, and what is known of them so far."""

    def __init__(self, lang: str, words: list[bytes], bits: np.ndarray | None = None):
        self.distinct, self.codes = _coded(words)
        sums = np.fromiter(map(zlib.crc32, self.distinct), dtype=np.uint64, count=len(self.distinct))
        self._sums = mixed(sums * np.uint64(0x9E3779B97F4A7C15) + np.uint64(zlib.crc32(lang.encode()) * 0x165667B19E3779F9 % (1 << 64)))
        inside = self.codes != 0
        #: Whether a word's next one stays in its window.
        self.linked = np.append(inside[:-1] & inside[1:], False) if len(inside) else inside
        if bits is not None:
            pairs = np.flatnonzero(self.linked)
            self.linked[pairs] = held(bits, self.counters(pairs, 2))

    def counters(self, places: np.ndarray, size: int) -> np.ndarray:
        """Numbers of the counters of the phrases of so many words that begin at these places."""
        hashes = np.full(len(places), size, dtype=np.uint64)
        for k in range(size):
            hashes = mixed(hashes * np.uint64(0xC2B2AE3D27D4EB4F) + self._sums[self.codes[places + k]])
        return counter_of(hashes)

    def triples(self) -> np.ndarray:
        """Places from which two neighbours on are linked."""
        return np.flatnonzero(self.linked & np.append(self.linked[1:], False)) if len(self.linked) else np.zeros(0, dtype=np.int64)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for lang, words, begins in _of_slices(batches):
        own = _Stretch(lang, words)
        yield own.counters(np.flatnonzero(own.linked[:begins]), 2)


def _triples(bits: np.ndarray) -> Tally:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for lang, words, begins in _of_slices(batches):
            own = _Stretch(lang, words, bits)
            places = own.triples()
            yield own.counters(places[places < begins], 3)

    return run


def _distinct_windows(windows: np.ndarray, times: np.ndarray, radix: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of word numbers below ``radix``, and the sums of their times."""
    first, number = np.unique(windows[:, 0], return_inverse=True)
    rows = [first[:, None]]
    for k in range(1, windows.shape[1]):
        keys, number = np.unique(number * radix + windows[:, k], return_inverse=True)
        rows = [r[keys // radix] for r in rows] + [(keys % radix)[:, None]]
    return np.concatenate(rows, axis=1), np.bincount(number, weights=times, minlength=len(rows[0])).astype(np.int64)


class _Tally:
    """A task's windows of one language, with words numbered as they come up."""

    def __init__(self):
        self.numbers = Words({_BREAK: 0})
        self.rows, self.times = np.zeros((0, LONGEST), dtype=np.int64), np.zeros(0, dtype=np.int64)
        self._fresh: list[tuple[np.ndarray, np.ndarray]] = []

    @property
    def size(self) -> int:
        return len(self.rows) + sum(len(rows) for rows, _ in self._fresh)

    def add(self, distinct: list[bytes], rows: np.ndarray, times: np.ndarray) -> None:
        used = np.unique(rows)
        numbers = np.zeros(len(distinct), dtype=np.int64)
        numbers[used] = [self.numbers[distinct[k]] for k in used.tolist()]
        self._fresh.append((numbers[rows], times))

    def merge(self) -> None:
        rows, times = zip((self.rows, self.times), *self._fresh, strict=True)
        self.rows, self.times = _distinct_windows(np.concatenate(rows), np.concatenate(times), len(self.numbers))
        self._fresh = []

    def batches(self, lang: str) -> Iterator[pa.RecordBatch]:
        self.merge()
        names = pa.array(list(self.numbers), pa.binary()).cast(pa.string())
        for at in range(0, len(self.rows), 50_000):
            # Number 0, the break, stands for padding.
            part = self.rows[at : at + 50_000]
            columns = {"lang": pa.array([lang] * len(part), pa.string())}
            columns |= {c: names.take(pa.array(part[:, k], mask=part[:, k] == 0)) for k, c in enumerate(_COLUMNS)}
            yield pa.RecordBatch.from_pydict(columns | {"times": pa.array(self.times[at : at + 50_000], pa.int64())})


def _windows(bits: np.ndarray, triple_bits: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def of_stretch(own: _Stretch, begins: int) -> tuple[np.ndarray, np.ndarray]:
        codes = own.codes
        triples = own.triples()
        tripled = np.zeros(len(codes) + LONGEST, dtype=bool)
        tripled[triples] = held(triple_bits, own.counters(triples, 3))
        linked = np.append(own.linked, np.zeros(LONGEST, dtype=bool))
        places = np.flatnonzero(codes[:begins])
        longer, alone = places[linked[places]], places[~linked[places]]
        once = np.bincount(codes[alone], minlength=len(own.distinct))
        single = np.flatnonzero(once)
        lead, alive = [codes[longer]], linked[longer]
        for k in range(1, LONGEST):
            if k > 1:
                alive = alive & tripled[longer + k - 2]
            lead.append(np.where(alive, codes[np.minimum(longer + k, len(codes) - 1)], 0))
        found, times = _distinct_windows(np.stack(lead, axis=1), np.ones(len(longer)), len(own.distinct))
        rows = np.zeros((len(single) + len(found), LONGEST), dtype=np.int64)
        rows[: len(single), 0], rows[len(single) :] = single, found
        return rows, np.concatenate([once[single], times])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies: dict[str, _Tally] = {}
        for lang, words, begins in _of_slices(batches):
            own = _Stretch(lang, words, bits)
            tallies.setdefault(lang, _Tally()).add(own.distinct, *of_stretch(own, begins))
            if sum(t.size for t in tallies.values()) > _MOST_WINDOWS:
                for tally in tallies.values():
                    tally.merge()
                if sum(t.size for t in tallies.values()) > _MOST_WINDOWS // 2:
                    for name in list(tallies):
                        yield from tallies.pop(name).batches(name)
        for name, tally in tallies.items():
            yield from tally.batches(name)

    return run


def _rolled_up(windows: DataFrame, columns: list[str]) -> DataFrame:
    """``lang, size, words, times``: the windows' prefixes of every length, down to none."""
    summed = windows.rollup("lang", *columns).agg(F.sum("times").alias("times"), F.grouping_id().cast("int").alias("left_out"))
    # The grouping id has a one for every column left out: none for the longest prefix, one for each word for the language alone.
    sizes = {(1 << len(columns) - k) - 1: k for k in range(len(columns) + 1)}
    size = F.create_map(*(F.lit(v) for pair in sizes.items() for v in pair))[F.col("left_out")]
    words = F.filter(F.array(*columns), lambda w: w.isNotNull())
    found = summed.select("lang", size.alias("size"), words.alias("words"), "times")
    return found.where(F.col("size").isNotNull() & (F.size("words") == F.col("size")))


def phrase_counts(spark: SparkSession, documents: DataFrame, least: int, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang, size, words, phrase, times``, staged: all phrases of at least so many occurrences.

    ``size`` 0 is the language itself, with all its words, however few.
    """
    texts = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    texts = texts.where(F.col("text").isNotNull() & (F.col("text") != ""))
    bits = frequent(spark, texts, _pairs, least)
    triple_bits = frequent(spark, texts, _triples(bits), least)
    kinds = ", ".join(f"{c} string" for c in _COLUMNS)
    staged = Staged(spark, "phrases")
    seen = texts.mapInArrow(_windows(bits, triple_bits), f"lang string, {kinds}, times bigint")
    windows = staged(seen.groupBy("lang", *_COLUMNS).agg(F.sum("times").alias("times")))
    counted = _rolled_up(windows.where("w2 IS NOT NULL"), _COLUMNS).unionByName(_rolled_up(windows.where("w2 IS NULL"), _COLUMNS[:1]))
    counted = counted.groupBy("lang", "size", "words").agg(F.sum("times").alias("times"))
    counted = counted.where((F.col("size") == 0) | (F.col("times") >= least))
    counts = staged(counted.withColumn("phrase", F.concat_ws(" ", "words")))
    staged.drop(windows)
    return counts


def _score() -> Column:
    """``1000 * a * n / (l * r)``, rounded down; the products may have 38 digits."""
    wide = "CAST({} AS DECIMAL(19, 0)) * CAST({} AS DECIMAL(19, 0))"
    return F.expr(f"({wide.format('1000 * a', 'n')}) div ({wide.format('l', 'r')})")


def mine(
    spark: SparkSession, documents: DataFrame, least: int = 100, most: int = 2000, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's phrases of 2 to 5 words by their weakest cut.

    ``a`` is the phrase's number, ``l`` and ``r`` those of its parts at the cut, ``n`` that of all words; the score is
    ``1000 * a * n / (l * r)``, rounded down.  Phrases inside a longer frequent one that is as frequent are left out.
    """
    staged = Staged(spark, "collocations")
    counts = phrase_counts(spark, documents, least, text, lang)
    totals = staged(counts.where("size = 0").select("lang", F.col("times").alias("n")))
    phrases = counts.where("size >= 2")
    parts = counts.where("size >= 1 AND size < 5").select("lang", "phrase", "times")

    longer = phrases.where("size >= 3").select(
        "lang", "size", "words", "times", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("start")
    )
    longest_here = F.least(F.col("size") - 1, F.col("size") - F.col("start") + 1)
    longer = longer.select("*", F.explode(F.sequence(F.lit(2), longest_here)).alias("length"))
    inside = longer.groupBy("lang", F.concat_ws(" ", F.slice("words", F.col("start"), F.col("length"))).alias("phrase")).agg(
        F.max("times").alias("around")
    )
    kept = phrases.join(inside, ["lang", "phrase"], "left").where("around IS NULL OR around < times")

    cuts = kept.select("lang", "phrase", "words", F.col("times").alias("a"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.select(
        "lang", "phrase", "a", "cut", F.concat_ws(" ", F.slice("words", 1, F.col("cut"))).alias("first"),
        F.concat_ws(" ", F.slice("words", F.col("cut") + 1, F.lit(LONGEST))).alias("rest"),
    )
    left = parts.select("lang", F.col("phrase").alias("first"), F.col("times").alias("l"))
    right = parts.select("lang", F.col("phrase").alias("rest"), F.col("times").alias("r"))
    cuts = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(totals, "lang")
    worst = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(_score().alias("score"), "cut", "l", "r")).alias("cut"))
    scored = worst.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")

    order = "ORDER BY score DESC, a DESC, phrase"
    scored = scored.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALTS)))
    first = scored.selectExpr("*", f"row_number() OVER (PARTITION BY lang, salt {order}) AS place").where(F.col("place") <= most)
    ranked = first.selectExpr("*", f"row_number() OVER (PARTITION BY lang {order}) AS rank").where(F.col("rank") <= most)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
