"""Document fingerprints by randomised edit embedding.

A pointer walks along the text: at step j it notes the character under it and then stays or moves
on, as a random table shared by all documents decides from j and the character.  Texts at a small
edit distance soon walk in step again, so the Hamming distance of the notes follows the edit distance.
Notes are sampled: every step has a level, each level half as many steps as the one before, and a
document keeps the steps of the lowest level at which about ``SAMPLES`` remain, four bits of each.  Two
fingerprints are compared at the steps of the higher level of the two.  Bands of sampled notes
bring similar documents together, and the likeness of the whole fingerprints verifies them.

Defined results: a null text counts as empty; the empty text's fingerprint has no notes, and is like
itself (1) and unlike others (0).  Equal texts have equal fingerprints.  Long texts are walked whole.
Repeated rows are rows each; an empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import SLICE_BYTES, Staged, slices
from quayside.llm.counters import counter_of, frequent, held
from quayside.llm.neardup import by_block, components

#: Sampled steps that a fingerprint has at most; on average three quarters of it.
SAMPLES = 512
_BLOCK, _PERIOD = 256, 4099
_random = np.random.default_rng(41)
#: Whether the pointer moves on, by step (in turn) and class of character; class 0 is the end, where it stays.
_MOVES = (_random.random((_PERIOD, 256)) < 0.5).astype(np.int32)
_MOVES[:, 0] = 0
#: Four bits of note per class, with a mark above them; none at the end.
_NOTES_AT = _random.integers(0, 16, 256).astype(np.uint8) | np.uint8(16)
_NOTES_AT[0] = 0


def classes(text: str) -> np.ndarray:
    """A class from 1 to 255 for each character."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    return ((points * np.uint64(0x9E3779B1) >> np.uint64(13)) % np.uint64(255) + np.uint64(1)).astype(np.uint8)


def _mixed(steps: np.ndarray) -> np.ndarray:
    mixed = (steps.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(30)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(27))


def levels(steps: np.ndarray) -> np.ndarray:
    """The level of each step: the zeros at the end of a hash of it."""
    mixed = _mixed(steps)
    lowest = mixed & (~mixed + np.uint64(1))
    return np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)


def level_of(length: int) -> int:
    """The level at which a text of this many characters keeps its notes: half its walk's expected ones fit."""
    level = 0
    while (2 * length >> level) > SAMPLES:
        level += 1
    return level


_SAMPLED: dict[tuple[int, int], np.ndarray] = {}
_REACH = 1 << 12


def _sampled(level: int, coarse: int) -> np.ndarray:
    """Which of the first steps of a level are of a higher level too."""
    if (level, coarse) not in _SAMPLED:
        span = np.arange(_REACH << level) if level < 12 else None
        if span is None:
            found, start = [], 0
            while sum(map(len, found)) < _REACH:
                part = np.arange(start, start + (1 << 22))
                found.append(part[levels(part) >= level])
                start += 1 << 22
            steps = np.concatenate(found)
        else:
            steps = span[levels(span) >= level]
        _SAMPLED[level, coarse] = levels(steps) >= coarse
    return _SAMPLED[level, coarse]


class Notes:
    """What one walk noted at its sampled steps, in their order."""

    __slots__ = ("level", "notes")

    def __init__(self, level: int, notes: np.ndarray):
        self.level, self.notes = level, notes

    @classmethod
    def parse(cls, text: str) -> Notes:
        level, _, digits = text.partition(":")
        found = np.frombuffer(digits.encode(), dtype=np.uint8)
        return cls(int(level), found - np.uint8(48) - np.uint8(39) * (found > 57))

    def text(self) -> str:
        """The level, and a hexadecimal digit per sampled step."""
        return f"{self.level:02d}:" + (self.notes + np.uint8(48) + np.uint8(39) * (self.notes > 9)).tobytes().decode()

    def coarse(self, level: int) -> np.ndarray:
        return self.notes if level <= self.level else self.notes[_sampled(self.level, level)[: len(self.notes)]]

    def likeness(self, other: Notes) -> float:
        """The share of the longer one's compared steps where both noted the same."""
        level = max(self.level, other.level)
        a, b = self.coarse(level), other.coarse(level)
        most, both = max(len(a), len(b)), min(len(a), len(b))
        if not most:
            return 1.0 if len(self.notes) == len(other.notes) else 0.0
        return float(np.count_nonzero(a[:both] == b[:both])) / most


def walk(texts: list[np.ndarray]) -> list[Notes]:
    """Walk all texts (as classes) in step, the longest first, and drop those that have ended."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sizes = np.array([len(texts[k]) for k in order], dtype=np.int64)
    end = np.zeros(1, dtype=np.uint8)
    flat = np.concatenate([x for k in order for x in (texts[k], end)] or [end])
    pointer = np.cumsum(sizes + 1) - (sizes + 1)
    last = pointer + sizes
    level = np.array([level_of(n) for n in sizes.tolist()], dtype=np.int64)
    parts: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {int(w): [] for w in np.unique(level)}
    alive = np.flatnonzero(sizes > 0)
    pointer, step = pointer[alive], 0
    seen = np.empty((_BLOCK, len(alive)), dtype=np.uint8)
    while len(alive):
        if seen.shape[1] != len(alive):
            seen = np.empty((_BLOCK, len(alive)), dtype=np.uint8)
        for k in range(_BLOCK):
            np.take(flat, pointer, out=seen[k], mode="clip")
            pointer += _MOVES[(step + k) % _PERIOD].take(seen[k])
        heights = levels(np.arange(step, step + _BLOCK))
        own = level[alive]
        for wanted in np.unique(own).tolist():
            rows, columns = np.flatnonzero(heights >= wanted), np.flatnonzero(own == wanted)
            parts[wanted].append((alive[columns], _NOTES_AT[seen[np.ix_(rows, columns)].T]))
        step += _BLOCK
        going = pointer < last[alive]
        alive, pointer = alive[going], pointer[going]
    out: list[Notes | None] = [None] * len(texts)
    for wanted, found in parts.items():
        members = np.flatnonzero(level == wanted)
        width = sum(part.shape[1] for _, part in found)
        lines = np.zeros((len(members), width), dtype=np.uint8)
        at = 0
        for who, part in found:
            lines[np.searchsorted(members, who), at : at + part.shape[1]] = part
            at += part.shape[1]
        counts = np.count_nonzero(lines, axis=1)
        for place, line, count in zip(members.tolist(), lines, counts.tolist(), strict=True):
            out[order[place]] = Notes(wanted, line[:count] & np.uint8(15))
    return out


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text."""

    def run(texts: pa.Array) -> pa.Array:
        out = []
        for part in slices(texts, 4 * SLICE_BYTES):
            out += [n.text() for n in walk([classes(t or "") for t in part.to_pylist()])]
        return pa.array(out, pa.string())

    return F.arrow_udf(run, "string").asNondeterministic()(text)


class _Ranges:
    """Ranges of (id, hash of the text) in ascending order; an id that would fill several is split by the hash."""

    def __init__(self, bounds: list[float]):
        self.cuts, times = np.unique(np.array(bounds, dtype=np.int64), return_counts=True)
        # A bound that comes up several times is an id with as many shares of all rows.
        self.parts = np.where(times > 1, times, 0)
        self.starts = np.concatenate([[0], np.cumsum(1 + self.parts)])

    @property
    def count(self) -> int:
        return int(self.starts[-1]) + 1

    def __call__(self, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        place = np.searchsorted(self.cuts, ids, "left")
        found = self.starts[place]
        if len(self.cuts):
            inner = np.minimum(place, len(self.cuts) - 1)
            hot = (place < len(self.cuts)) & (self.cuts[inner] == ids) & (self.parts[inner] > 0)
            share = (hashes >> 32) + (1 << 31)
            found = found + np.where(hot, 1 + (share * self.parts[inner] >> 32), 0)
        return found.astype(np.int32)


def in_order(documents: DataFrame, key: str = "doc_id", text: str = "text", partitions: int = 0) -> DataFrame:
    """``id, text, copy``: one range of ids to a partition, from the largest id down, then a copy of the row that comes next.

    Rows of one id follow each other by a hash of their texts, downwards; an id with several shares of all rows
    is split by it.  The next row is the first of the next lower range, and above the lowest range that of the
    highest.  The bounds are quantiles of the ids, and each range's first place is gathered: a few numbers for
    each partition, whatever the data.  Rows without an id come last, in any partition.  Texts are shuffled once.
    """
    rows = documents.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    ids = rows.select("id", "h").where("id IS NOT NULL")
    partitions = partitions or max(1, documents.rdd.getNumPartitions())
    shares = [k / partitions for k in range(1, partitions)]
    ranges = _Ranges(ids.approxQuantile("id", shares, 0.1 / partitions) if shares else [])

    def range_of(found: pa.Array, hashes: pa.Array) -> pa.Array:
        return pa.array(ranges(*(x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (found, hashes))))

    first = F.max(F.struct("id", "h")).alias("top")
    tops = ids.select("id", "h", F.arrow_udf(range_of, "int")("id", "h").alias("b")).groupBy("b").agg(first).collect()
    tops = sorted((r.b, (r.top.id, r.top.h)) for r in tops)
    follows = {top: above for (_, top), (above, _) in zip(tops, tops[1:] + tops[:1], strict=True)}

    def places(found: pa.Array, hashes: pa.Array, spread: pa.Array) -> pa.Array:
        own = range_of(found.fill_null(0), hashes).to_pylist()
        counts, flat, copy = [0], [], []
        for i, h, b, free in zip(found.to_pylist(), hashes.to_pylist(), own, spread.to_pylist(), strict=True):
            flat.append(free if i is None else b)
            copy.append(False)
            if i is not None and (i, h) in follows:
                flat.append(follows[i, h])
                copy.append(True)
            counts.append(len(flat))
        cells = pa.StructArray.from_arrays([pa.array(flat, pa.int32()), pa.array(copy, pa.bool_())], ["b", "copy"])
        return pa.ListArray.from_arrays(pa.array(counts, pa.int32()), cells)

    spread = F.pmod(F.col("h"), F.lit(ranges.count)).cast("int")
    found = F.arrow_udf(places, "array<struct<b: int, copy: boolean>>")("id", "h", spread)
    dealt = rows.select("id", "text", "h", F.explode(found).alias("p")).select("id", "text", "h", "p.b", "p.copy")
    placed = dealt.repartitionById(ranges.count, "b")
    order = (F.col("id").isNull(), "copy", F.col("id").desc(), F.col("h").desc(), "text")
    return placed.sortWithinPartitions(*order).select("id", "text", "copy")


_COMPARED = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


def compare_in_order(documents: DataFrame, key: str = "doc_id", text: str = "text", partitions: int = 0) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and the likeness to the edited and to the next text.

    The next document has the next smaller id (after the smallest: the largest); of rows with one id, the
    next text in order.  The edited text has its last third (of characters, rounded down) replaced by as many
    of the next one's first characters, or all.  A row without an id is its own next.
    """

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
        """Runs of rows, each but the last run followed by the first row of the next."""
        held: list[tuple] = []
        for batch in batches:
            for part in slices(batch.column(1), 4 * SLICE_BYTES):
                start = part.offset - batch.column(1).offset
                columns = (batch.column(0).slice(start, len(part)), part, batch.column(2).slice(start, len(part)))
                held += [(i, t or "", c) for i, t, c in zip(*(x.to_pylist() for x in columns), strict=True)]
                if len(held) > 1:
                    yield held
                    held = held[-1:]
        if held:
            yield [*held, held[0]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in rows_of(batches):
            plain = [classes(t) for _, t, _ in rows]
            edited, sums, subjects = [], [], []
            for k, (i, t, copy) in enumerate(rows[:-1]):
                if copy:
                    continue
                nxt = k if i is None or rows[k + 1][0] is None else k + 1
                cut = len(t) // 3
                edited.append(np.concatenate([plain[k][: len(t) - cut], plain[nxt][:cut]]))
                sums.append(hashlib.sha256((t[: len(t) - cut] + rows[nxt][1][:cut]).encode()).hexdigest())
                subjects.append((k, nxt))
            walked = walk(plain + edited)
            own, changed = walked[: len(plain)], walked[len(plain) :]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([rows[k][0] for k, _ in subjects], pa.int64()),
                    pa.array([len(plain[k]) for k, _ in subjects], pa.int64()),
                    pa.array(sums, pa.string()),
                    pa.array([own[k].text() for k, _ in subjects], pa.string()),
                    pa.array([c.text() for c in changed], pa.string()),
                    pa.array([own[k].likeness(c) for (k, _), c in zip(subjects, changed, strict=True)], pa.float64()),
                    pa.array([own[k].likeness(own[nxt]) for k, nxt in subjects], pa.float64()),
                ],
                ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )

    return in_order(documents, key, text, partitions).mapInArrow(run, _COMPARED)


#: Notes of a band, the strides at which bands take them, and the least likeness of a link.
BAND_NOTES, STRIDES, LEAST_LIKENESS = 9, (3, 5, 11), 0.8
#: One of so many bands is used, the same ones for all documents.  A band of nine notes is shared by 0.8 ** 9 = 13 %
#: of the links at the threshold, so that of about 32 bands at least one is by 99 %.
_THIN = 4
#: Fingerprints of level 0 with fewer notes have bands drawn from all of their notes besides, for prefixes of some lengths.
_SHORT, _DRAWN = 280, 32


def _prefixes() -> list[int]:
    """Lengths a quarter apart, or 1."""
    found = [1]
    while (nxt := max(found[-1] + 1, found[-1] * 5 // 4)) <= _SHORT:
        found.append(nxt)
    return found


_PREFIXES = _prefixes()
#: Members of a block of the last comparison.
_MEMBERS = 512
#: Counters that tell bands which several fingerprints have; a byte each in a task, a bit each for all.
_COUNTERS = 1 << 27


def _drawn(prefix: int) -> np.ndarray:
    """Places below ``prefix``, a line per band; the shorter the prefix, the fewer notes to a band."""
    width = 8 if prefix >= 40 else 6 if prefix >= 16 else 4 if prefix >= 8 else max(1, prefix // 2)
    random = np.random.default_rng(prefix)
    lines = {tuple(sorted(random.permutation(prefix)[:width].tolist())) for _ in range(_DRAWN)}
    return np.array(sorted(lines), dtype=np.int64)


_PLACES: dict[tuple[int, bool], tuple[np.ndarray, np.ndarray]] = {}


def _places(count: int, short: bool) -> tuple[np.ndarray, np.ndarray]:
    """The notes of each band of a fingerprint with ``count`` notes, and what names the band; place ``count`` is none."""
    if (count, short) not in _PLACES:
        lines, names = [], []
        for stride in STRIDES:
            span = stride * BAND_NOTES
            for at in range(count // span * stride):
                name = (stride << 32) + at
                if int(_mixed(np.array([name]))[0] >> np.uint64(40)) % _THIN == 0:
                    window, first = divmod(at, stride)
                    lines.append(window * span + first + stride * np.arange(BAND_NOTES))
                    names.append(name)
        # The longer one of two like texts has at most 1.25 times the notes; the longest prefix that the shorter
        # one fills is a quarter shorter at most.
        for prefix in _PREFIXES if short and count <= _SHORT else ():
            if prefix <= count <= 1.5625 * prefix:
                for k, line in enumerate(_drawn(prefix)):
                    lines.append(line)
                    names.append((1 << 48) + (prefix << 32) + k)
        places = np.full((len(lines), BAND_NOTES), count, dtype=np.int64)
        for row, line in zip(places, lines, strict=True):
            row[: len(line)] = line
        _PLACES[count, short] = places, np.array(names, dtype=np.uint64)
    return _PLACES[count, short]


def band_keys(notes: Notes) -> np.ndarray:
    """Keys of all bands: those of the own level, and of the next where a text of that level may be alike."""
    keys = [np.zeros(0, dtype=np.uint64)]
    for level in (notes.level, notes.level + 1):
        own = notes.coarse(level)
        if level > notes.level and len(own) < SAMPLES * 5 // 16:
            # A text of the next level has about SAMPLES / 2 notes or more, one like it 0.8 times as many.
            continue
        places, names = _places(len(own), level == 0)
        held = np.append(own.astype(np.uint64), np.uint64(0))[places]
        content = (held << (np.uint64(4) * np.arange(BAND_NOTES, dtype=np.uint64))).sum(axis=1, dtype=np.uint64)
        keys.append(_mixed(content ^ _mixed(names ^ np.uint64(level << 56))))
    return np.unique(np.concatenate(keys))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The counters of all bands of a task's fingerprints."""
    for batch in batches:
        for at in range(0, len(batch), 4096):
            keys = [band_keys(Notes.parse(line)) for line in batch.column(0).slice(at, 4096).to_pylist()]
            yield counter_of(np.concatenate([np.zeros(0, dtype=np.uint64), *keys]), _COUNTERS)


def _shared_bands(bits: np.ndarray):
    """The bands that others may share: a band that comes up once has a counter to itself, but for chance."""

    def run(found: pa.Array) -> pa.Array:
        keys = [own[held(bits, counter_of(own, _COUNTERS))] for own in (band_keys(Notes.parse(line)) for line in found.to_pylist())]
        ends = np.cumsum([0, *map(len, keys)])
        flat = np.concatenate([np.zeros(0, dtype=np.uint64), *keys]).view(np.int64)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))

    return run


class _Lines:
    """The notes of some fingerprints at any level, a line each; 255 where there are none."""

    def __init__(self, prints: list[Notes]):
        self._prints, self._known = prints, {}
        self.levels = np.array([n.level for n in prints])

    def at(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        if level not in self._known:
            notes = [n.coarse(level) for n in self._prints]
            counts = np.array([len(n) for n in notes])
            lines = np.full((len(notes), int(counts.max())), 255, dtype=np.uint8)
            for line, own in zip(lines, notes, strict=True):
                line[: len(own)] = own
            self._known[level] = lines, counts
        return self._known[level]

    def like(self, one: int, others: np.ndarray, least: float) -> np.ndarray:
        """Those of the others that are alike."""
        found = []
        for level in np.unique(np.maximum(self.levels[others], self.levels[one])).tolist():
            some = others[np.maximum(self.levels[others], self.levels[one]) == level]
            lines, counts = self.at(level)
            count = int(counts[one])
            same = np.count_nonzero(lines[some, :count] == lines[one, :count], axis=1)
            found.append(some[same / np.maximum(np.maximum(counts[some], count), 1) >= least])
        return np.concatenate(found) if found else others[:0]


def _cross_links(least: float):
    """Of the links of the rows that ask to the others of a block, one for each two components that they join."""

    def found(block: pa.Table) -> list[tuple[int, int]]:
        ids, labels, asks = (block[c].to_numpy().copy() for c in ("id", "comp", "asks"))
        lines = _Lines([Notes.parse(line) for line in block["print"].to_pylist()])
        asking, asked, out = np.flatnonzero(asks), np.flatnonzero(~asks.astype(bool)), []
        for one in asking.tolist():
            open_ = asked[labels[asked] != labels[one]]
            for other in lines.like(one, open_, least).tolist() if len(open_) else ():
                if labels[other] != labels[one]:
                    out.append((int(min(ids[one], ids[other])), int(max(ids[one], ids[other]))))
                    labels[labels == labels[other]] = labels[one]
        return out

    return by_block(found)


def _across(crowd: DataFrame, comps: DataFrame, members: DataFrame, staged: Staged, least: float) -> DataFrame:
    """Links between components that have members in one band, besides those to its centre.

    Members of a band's largest component are not compared with each other: all others ask every member, block
    by block within tasks.  Bands with the same largest component are put together, as near copies share most of
    their bands, so that two members are compared once.
    """
    named = crowd.select("key", F.col("node").alias("id")).join(comps, "id", "left").select("key", "id", F.coalesce("comp", "id").alias("comp"))
    parts = named.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = parts.groupBy("key").agg(F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "comp")).alias("top"))
    mixed = mixed.where("parts > 1").select("key", F.col("top.comp").alias("top"))
    met = staged(named.join(mixed, "key").select(F.col("top").alias("key"), "id", "comp").distinct())
    counts = met.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("comp") != F.col("key")).alias("m"))
    blocks, chunks = (F.ceil(F.col(c) / _MEMBERS).cast("int").alias(name) for c, name in (("n", "blocks"), ("m", "chunks")))
    near = staged(met.join(counts.select("key", blocks, chunks), "key"))

    def part(seed: int, count: str) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(seed)), count).cast("int")

    def every(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    asked = near.select("key", "id", "comp", F.lit(False).alias("asks"), part(77, "blocks").alias("k"), every("chunks").alias("c"))
    asking = near.where("comp <> key").select("key", "id", "comp", F.lit(True).alias("asks"), part(78, "chunks").alias("c"), every("blocks").alias("k"))
    dealt = asked.unionByName(asking).select(F.xxhash64("key", "k", "c").alias("block"), "id", "comp", "asks")
    dealt = dealt.join(members.select(F.col("node").alias("id"), "print"), "id")
    pairs = dealt.repartition("block").sortWithinPartitions("block").mapInArrow(_cross_links(least), "a bigint, b bigint")
    return staged(pairs.distinct())


def link_prints(spark: SparkSession, prints: DataFrame, staged: Staged, least: float = LEAST_LIKENESS) -> DataFrame:
    """``print, class_id, joining_links`` for each fingerprint of ``id, print``.

    Bands are sampled notes, neighbouring by a stride or drawn; those that only one fingerprint has are told by a
    counter table of fixed size and not shuffled.  In a band every member is compared
    with one centre, so that a band of n members gives n - 1 candidates; where it still holds several
    components, all its members are compared within tasks.  No link between two that share a band is lost.
    """
    firsts = staged(prints.groupBy("print").agg(F.min("id").alias("rep")), "zstd")
    seed = 0
    while True:
        # Numbers that are each one fingerprint's alone.
        members = firsts.withColumn("node", F.xxhash64(F.lit(seed), "print"))
        if members.groupBy("node").count().where("count > 1").isEmpty():
            break
        seed += 1
    members = members.select("node", "rep", "print")
    bits = frequent(spark, firsts.select("print"), _counted, 2, _COUNTERS)
    dealt = staged(members.select("node", F.explode(F.arrow_udf(_shared_bands(bits), "array<bigint>")("print")).alias("key")))
    hubs = dealt.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("far")).where("hub < far").select("key", "hub")
    crowd = staged(dealt.join(hubs, "key").select("key", "node", "hub"))
    staged.drop(dealt)
    pairs = crowd.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    pairs = pairs.join(members.select(F.col("node").alias("a"), F.col("print").alias("x")), "a")
    pairs = pairs.join(members.select(F.col("node").alias("b"), F.col("print").alias("y")), "b")

    def like(a: pa.Array, b: pa.Array) -> pa.Array:
        both = zip(a.to_pylist(), b.to_pylist(), strict=True)
        return pa.array([Notes.parse(x).likeness(Notes.parse(y)) >= least for x, y in both], pa.bool_())

    edges = staged(pairs.where(F.arrow_udf(like, "boolean")("x", "y")).select("a", "b"))
    comps = components(spark, edges, staged)
    more = _across(crowd, comps, members, staged, least)
    staged.drop(crowd)
    if not more.isEmpty():
        edges = staged(edges.union(more).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
        comps = components(spark, edges, staged)
    links = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("joining_links"))
    linked = staged(members.drop("print").join(comps.select(F.col("id").alias("node"), "comp"), "node").join(links, "node"))
    lowest = linked.groupBy("comp").agg(F.min("rep").alias("class_id"))
    linked = linked.join(lowest, "comp").select("node", "class_id", "joining_links")
    named = members.join(linked, "node", "left")
    return staged(named.select("print", F.coalesce("class_id", "rep").alias("class_id"), F.coalesce("joining_links", F.lit(0)).alias("joining_links")))


def similar(
    spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST_LIKENESS
) -> DataFrame:
    """``doc_id, class_id, joining_links`` for each row: the least id of its class, and how many links joined its fingerprint to it.

    Documents with one fingerprint are one class member.  Not all links two by two within a class are
    counted.  Rows without an id are left out.
    """
    staged = Staged(spark, "fingerprints")
    own = documents.where(F.col(key).isNotNull()).select(F.col(key).cast("bigint").alias("id"), fingerprint(F.col(text)).alias("print"))
    prints = staged(own)
    return prints.join(link_prints(spark, prints, staged, least), "print").select(F.col("id").alias("doc_id"), "class_id", "joining_links")


def compare_and_link(spark: SparkSession, documents: DataFrame, key: str = "doc_id", text: str = "text", partitions: int = 0) -> DataFrame:
    """The rows of ``compare_in_order`` with the ``class_id`` and ``joining_links`` of ``similar``; null and 0 without an id.

    Texts are walked once: the fingerprints that are compared are those that are linked.
    """
    staged = Staged(spark, "fingerprints")
    compared = staged(compare_in_order(documents, key, text, partitions), "zstd")
    prints = compared.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"), F.col("fingerprint").alias("print"))
    linked = link_prints(spark, prints, staged)
    named = compared.join(linked, compared["fingerprint"] == linked["print"], "left").drop("print")
    known = F.col("doc_id").isNotNull()
    return named.withColumns({"class_id": F.when(known, F.col("class_id")), "joining_links": F.when(known, F.col("joining_links")).otherwise(F.lit(0))})
