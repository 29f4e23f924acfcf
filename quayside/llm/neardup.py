"""Near duplicates by one-permutation hashing with optimal densification.

Every document is the set of its word shingles.  One hash of each shingle picks a bin and a value;
a bin keeps its least value, and an empty bin copies that of a full one, by a hash of its own that
all documents share.  Bands of four bins are buckets.  Documents with the same set are one class,
by a 128-bit hash of the set, and only classes go on.

Candidates are star-shaped: in a bucket, every class is paired with one centre, so a bucket of n
classes gives n - 1 pairs.  Pairs whose signatures rule the similarity out are dropped, the others
are confirmed on the full sets.  What the confirmed links connect needs no further comparison.  Where
a bucket still holds several components, its classes are compared on the full sets, block by block
within tasks that give out only the links which join components, so no link within a bucket is lost.  At a similarity of 0.85 a pair shares none of the 32 buckets once in 10**10 times.

Defined results: null or empty texts have no shingles and are linked with nothing.  A document
with fewer words than a shingle has its whole sequence as its one shingle.  Rows with the same id
are one document with several texts.  Rows without an id are linked with nothing: their component
is null and they are kept.  An empty table gives no rows.  Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import Staged, slices

_BINS, _ROWS = 128, 4
_BANDS = _BINS // _ROWS
#: Classes of a block of the last comparison, and columns of a bitmap there.
_BLOCK, _COLUMNS = 512, 1 << 16


def _mix(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(31))
    values = values * np.uint64(0x9E3779B97F4A7C15)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    return values ^ (values >> np.uint64(32))


def shingle_sets(texts: list[str | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles' hashes of all texts, ordered within each, and how many each has."""
    from xxhash import xxh3_64_intdigest as hash_of

    split = [(t or "").encode().lower().split() for t in texts]
    counts = np.fromiter(map(len, split), dtype=np.int64, count=len(split))
    total = int(counts.sum())
    hashes = np.fromiter((h for own in split for h in map(hash_of, own)), dtype=np.uint64, count=total)
    rolled = np.full(total, 0x1234567, dtype=np.uint64)
    left = np.repeat(np.cumsum(counts), counts) - np.arange(total)
    for k in range(words):
        # Beyond its document's end a short sequence goes on with nothing.
        ahead = np.zeros(total, dtype=np.uint64)
        ahead[: total - k] = hashes[k:]
        rolled = np.where(left > k, _mix(rolled * np.uint64(0x100000001B3) + ahead), rolled)
    own = np.where(counts >= words, counts - words + 1, np.minimum(counts, 1))
    starts, keep = np.cumsum(counts) - counts, np.zeros(total, dtype=bool)
    place = np.arange(total) - np.repeat(starts, counts)
    keep = place < np.repeat(own, counts)
    rolled = rolled[keep]
    out, sizes, at = [np.zeros(0, dtype=np.uint64)], np.zeros(len(split), dtype=np.int64), 0
    for k, n in enumerate(own.tolist()):
        if n:
            found = np.unique(rolled[at : at + n])
            out.append(found)
            sizes[k], at = len(found), at + n
    return np.concatenate(out), sizes


_random = np.random.default_rng(20)
#: Where an empty bin looks, attempt by attempt.
_PROBES = _random.integers(0, _BINS, (256, _BINS))


def signatures(shingles: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One line of bins per document; documents without shingles have zeros."""
    lines = np.zeros((len(sizes), _BINS), dtype=np.uint64)
    full = np.zeros((len(sizes), _BINS), dtype=bool)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    bins = (shingles >> np.uint64(57)).astype(np.int64)
    cell = owner * _BINS + bins
    # Ordered within a document, the first of a bin is its least.
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    lines.ravel()[cell[first]] = shingles[first] | np.uint64(1)
    full.ravel()[cell[first]] = True
    rows, empty = np.nonzero(~full & (sizes > 0)[:, None])
    for attempt in range(len(_PROBES)):
        if not len(rows):
            break
        there = _PROBES[attempt][empty]
        found = full[rows, there]
        lines[rows[found], empty[found]] = lines[rows[found], there[found]]
        rows, empty = rows[~found], empty[~found]
    for row in np.unique(rows):
        lines[row, empty[rows == row]] = lines[row, np.flatnonzero(full[row])[0]]
    return lines


_FEATURES = "struct<n: bigint, set_hash: binary, bands: array<bigint>, marks: binary>"


def features(text: Column, words: int) -> Column:
    """Set size, hash of the set, band keys, and a byte per bin."""

    def run(texts: pa.Array) -> pa.Array:
        from xxhash import xxh3_128_digest

        sums, sizes_, bands, marks = [], [], [np.zeros((0, _BANDS), dtype=np.uint64)], []
        for part in slices(texts):
            shingles, sizes = shingle_sets(part.to_pylist(), words)
            at = 0
            for n in sizes.tolist():
                sums.append(xxh3_128_digest(shingles[at : at + n]))
                at += n
            lines = signatures(shingles, sizes)
            keys = np.arange(_BANDS, dtype=np.uint64)[None, :] + np.uint64(1)
            for k in range(_ROWS):
                keys = _mix(keys * np.uint64(0x100000001B3) + lines[:, k::_ROWS])
            bands.append(keys)
            marks += [line.tobytes() for line in (lines >> np.uint64(40)).astype(np.uint8)]
            sizes_.append(sizes)
        flat = np.concatenate(bands)
        offsets = pa.array(np.arange(len(flat) + 1) * _BANDS, pa.int32())
        return pa.StructArray.from_arrays(
            [
                pa.array(np.concatenate([np.zeros(0, dtype=np.int64), *sizes_])), pa.array(sums, pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(flat.ravel().view(np.int64))), pa.array(marks, pa.binary()),
            ],
            ["n", "set_hash", "bands", "marks"],
        )

    return F.arrow_udf(run, _FEATURES).asNondeterministic()(text)


def _least_alike(n: np.ndarray, percent: int) -> np.ndarray:
    """Bins that two sets must share to be worth a look, the smaller with ``n`` members."""
    share = percent / 100
    really = 0.75 * _BINS * (1 - np.exp(-n / _BINS))
    return _BINS * (share - 5 * np.sqrt(share * (1 - share) / np.maximum(really, 1)))


def _may_link(percent: int):
    def run(marks: pa.Array, others: pa.Array, n: pa.Array, m: pa.Array) -> pa.Array:
        a, b = (np.frombuffer(b"".join(x.to_pylist()), dtype=np.uint8).reshape(-1, _BINS) for x in (marks, others))
        less = np.minimum(*(x.to_numpy(zero_copy_only=False) for x in (n, m)))
        return pa.array((a == b).sum(axis=1) >= _least_alike(less, percent))

    return F.arrow_udf(run, "boolean")


def _links(words: int, percent: int):
    def run(texts: pa.Array, others: pa.Array) -> pa.Array:
        out = []
        for at in range(0, len(texts), 64):
            pairs = [texts.slice(at, 64).to_pylist(), others.slice(at, 64).to_pylist()]
            distinct = list({t for side in pairs for t in side})
            shingles, sizes = shingle_sets(distinct, words)
            ends = np.cumsum(sizes)
            sets = {t: shingles[e - n : e] for t, e, n in zip(distinct, ends, sizes, strict=True)}
            for a, b in zip(*(map(sets.__getitem__, side) for side in pairs), strict=True):
                both = len(np.intersect1d(a, b, assume_unique=True))
                out.append(100 * both >= percent * (len(a) + len(b) - both) > 0)
        return pa.array(out, pa.bool_())

    return F.arrow_udf(run, "boolean").asNondeterministic()


def components(spark: SparkSession, edges: DataFrame, staged: Staged) -> DataFrame:
    """``id`` and ``comp``, the least id that its edges (``a``, ``b``) reach, for every id in an edge.

    Every round moves each node to the neighbour that comes first in a hashed order, and on to that one's,
    and goes on with the edges between what is left.  In a hashed order ascents are short, so
    edges and nodes shrink by a constant factor a round, whatever the ids are.
    """
    links = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct())
    if links.isEmpty():
        return links.select(F.col("a").alias("id"), F.col("b").alias("comp"))
    steps = []
    while not links.isEmpty():
        ways = links.select("a", "b").union(links.select("b", "a"))
        first = ways.groupBy("a").agg(F.min(_ranked("b")).alias("low"))
        moved = staged(first.select(F.col("a").alias("id"), F.least("low", _ranked("a"))["id"].alias("to")))
        onward = moved.select(F.col("id").alias("to"), F.col("to").alias("next"))
        step = staged(moved.join(onward, "to").select("id", F.col("next").alias("to")))
        ends = links
        for side in "ab":
            ends = ends.join(step.select(F.col("id").alias(side), F.col("to").alias(f"{side}_to")), side)
        ends = ends.where("a_to <> b_to").select(F.least("a_to", "b_to").alias("a"), F.greatest("a_to", "b_to").alias("b"))
        rest = staged(ends.distinct())
        staged.drop(moved, links)
        steps.append(step)
        links = rest
    label = steps[0]
    for step in steps[1:]:
        onward = step.select(F.col("id").alias("to"), F.col("to").alias("next"))
        label = label.join(onward, "to", "left").select("id", F.coalesce("next", "to").alias("to"))
    label = staged(label)
    least = label.groupBy("to").agg(F.min("id").alias("comp"))
    out = staged(label.join(least, "to").select("id", "comp"))
    staged.drop(links, label, *steps)
    return out


def _ranked(node: str) -> Column:
    return F.struct(F.xxhash64(node).alias("rank"), F.col(node).alias("id"))


def _confirm(pairs: DataFrame, reps: DataFrame, texts: DataFrame, words: int, percent: int, staged: Staged) -> DataFrame:
    """Of pairs of classes (``a``, ``b``), those that are links."""
    pairs = pairs.distinct()
    for side in "ab":
        own = reps.select(F.col("cid").alias(side), F.col("n").alias(f"n_{side}"), F.col("marks").alias(f"marks_{side}"))
        pairs = pairs.join(own, side)
    near = pairs.where(F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b"))
    near = staged(near.where(_may_link(percent)("marks_a", "marks_b", "n_a", "n_b")).select("a", "b").distinct())
    ids = near.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    some = texts.join(ids, "id", "left_semi")
    full = near.join(some.select(F.col("id").alias("a"), F.col("text").alias("t_a")), "a")
    full = full.join(some.select(F.col("id").alias("b"), F.col("text").alias("t_b")), "b")
    return staged(full.where(_links(words, percent)("t_a", "t_b")).select("a", "b").distinct())


def _shared(sets: list[np.ndarray]) -> np.ndarray:
    """How many members every two of the sets have in common, by bitmaps over members of two sets or more."""
    sizes = np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner, place = owner[often[place] > 1], place[often[place] > 1]
    _, place = np.unique(place, return_inverse=True)
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(sets), len(sets)), dtype=np.int64)
    for low in range(0, int(place.max(initial=-1)) + 1, _COLUMNS):
        part = slice(*np.searchsorted(place, (low, low + _COLUMNS)))
        bits = np.zeros((len(sets), _COLUMNS), dtype=bool)
        bits[owner[part], place[part] - low] = True
        packed = np.packbits(bits, axis=1).view(np.uint64)
        packed = packed[:, : -(-(int(place[part][-1]) - low + 1) // 64)]
        for k in range(len(sets)):
            out[k] += np.bitwise_count(packed & packed[k]).sum(axis=1, dtype=np.int64)
    return out


def _block_links(ids: np.ndarray, comps: np.ndarray, sets: list[np.ndarray], crossed: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links between different components of a block, one for each two components that they join."""
    both, sizes = _shared(sets), np.fromiter(map(len, sets), dtype=np.int64, count=len(sets))
    return joining(ids, comps, 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both), crossed)


def joining(ids: np.ndarray, comps: np.ndarray, linked: np.ndarray, crossed: np.ndarray) -> list[tuple[int, int]]:
    """Of the links within a block, one for each two components that they join."""
    linked = linked & (crossed[:, None] != crossed[None, :] if crossed.any() and not crossed.all() else True)
    labels, out = comps.copy(), []
    for k in range(len(ids)):
        for other in np.flatnonzero(linked[k, k + 1 :] & (labels[k + 1 :] != labels[k])) + k + 1:
            if labels[other] != labels[k]:
                out.append((int(min(ids[k], ids[other])), int(max(ids[k], ids[other]))))
                labels[labels == labels[other]] = labels[k]
    return out


def _within_blocks(words: int, percent: int):
    """Confirmed links between components, block by block, of rows ordered by block."""

    def found(block: pa.Table) -> list[tuple[int, int]]:
        shingles, sizes = shingle_sets(block["text"].to_pylist(), words)
        ends = np.cumsum(sizes)
        sets = [shingles[e - n : e] for e, n in zip(ends, sizes, strict=True)]
        ids, comps, crossed = (block[c].to_numpy() for c in ("id", "comp", "second"))
        return _block_links(ids, comps, sets, crossed.astype(bool), percent)

    return by_block(found)


def by_block(found):
    """``found`` of each block of rows ordered by block, as rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            blocks = held["block"].to_numpy()
            bounds = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist()]
            yield shown([p for a, b in zip(bounds, bounds[1:], strict=False) if b - a > 1 for p in found(held.slice(a, b - a))])
            held = held.slice(bounds[-1])
        if held is not None and held.num_rows > 1:
            yield shown(found(held))

    def shown(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = (pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1))
        return pa.RecordBatch.from_arrays([a, b], ["a", "b"])

    return run


def link(
    spark: SparkSession,
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``documents``.

    Documents are linked if ``100 * intersection >= percent * union`` of their shingle sets.
    """
    staged = Staged(spark, "neardup")
    texts = documents.select(F.col(key).alias("id"), F.col(text).alias("text"))
    rows = staged(texts.withColumn("f", features(F.col("text"), words)).select("id", "f.*"))
    sets = rows.where("id IS NOT NULL AND n > 0")
    classes = staged(sets.groupBy("set_hash").agg(F.min("id").alias("cid")))
    reps = sets.join(classes, (sets.id == classes.cid) & (sets.set_hash == classes.set_hash), "left_semi")
    reps = staged(reps.select(F.col("id").alias("cid"), "n", "bands", "marks").dropDuplicates(["cid", "bands"]))
    bands = reps.select("cid", F.explode("bands").alias("key"))
    hubs = bands.groupBy("key").agg(F.min("cid").alias("hub"), F.max("cid").alias("far")).where("hub < far")
    crowd = staged(bands.join(hubs.select("key", "hub"), "key").select("key", "cid", "hub"))
    # All that is compared from here on lies in a bucket with others.
    close = staged(texts.join(crowd.select(F.col("cid").alias("id")).distinct(), "id", "left_semi"))
    # A document with several texts is in several classes, which it links.
    of_id = sets.join(classes, "set_hash").select("id", "cid")
    least = of_id.groupBy("id").agg(F.min("cid").alias("a"), F.max("cid").alias("z")).where("a < z").select("id", "a")
    edges = staged(of_id.join(least, "id").where("cid > a").select("a", F.col("cid").alias("b")).distinct())
    star = crowd.where("cid <> hub").select(F.col("hub").alias("a"), F.col("cid").alias("b"))
    edges = edges.union(_confirm(star, reps, close, words, percent, staged))
    comps = components(spark, edges, staged)

    more = staged(_across(spark, crowd, comps, close, staged, words, percent))
    if not more.isEmpty():
        comps = components(spark, edges.union(more), staged)

    of = sets.select("id", "set_hash").join(classes, "set_hash").groupBy("id").agg(F.min("cid").alias("cid"))
    of = of.join(comps.select(F.col("id").alias("cid"), "comp"), "cid", "left").select("id", F.coalesce("comp", "cid").alias("comp"))
    out = rows.select("id", "n").join(of, "id", "left")
    return out.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.coalesce("comp", "id").alias("component_id"),
        (F.col("id").isNull() | (F.coalesce("comp", "id") == F.col("id"))).alias("kept"),
    )


def deal(near: DataFrame) -> DataFrame:
    """``block, id, comp, second``: every two of the blocks of a neighbourhood (``comp``) come together once."""
    dealt = near.withColumn("k", F.pmod(F.xxhash64("id", F.lit(77)), "blocks").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        F.xxhash64("comp", F.least("k", "other"), F.greatest("k", "other")).alias("block"),
        "id", F.col("own").alias("comp"), (F.col("k") > F.col("other")).alias("second"),
    )


def _across(
    spark: SparkSession, crowd: DataFrame, comps: DataFrame, texts: DataFrame, staged: Staged, words: int, percent: int
) -> DataFrame:
    """Links between components that have classes in one bucket, besides those to its centre.

    Classes that such buckets connect are a neighbourhood.  It is cut into blocks, and each two blocks
    of a neighbourhood are compared on the full sets within one task.
    """
    named = crowd.select("key", "cid").join(comps.select(F.col("id").alias("cid"), "comp"), "cid", "left")
    named = named.select("key", "cid", F.coalesce("comp", "cid").alias("comp"))
    several = named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("cid").alias("first"))
    mixed = staged(named.join(several.where("lo < hi").select("key", "first"), "key"))
    near = components(spark, mixed.where("cid > first").select(F.col("first").alias("a"), F.col("cid").alias("b")), staged)
    near = near.join(mixed.select(F.col("cid").alias("id"), F.col("comp").alias("own")).distinct(), "id")
    near = near.join(near.groupBy("comp").agg(F.ceil(F.count(F.lit(1)) / _BLOCK).cast("int").alias("blocks")), "comp")
    dealt = texts.join(deal(near), "id").select("block", "id", "comp", "second", "text")
    pairs = dealt.repartition("block").sortWithinPartitions("block").mapInArrow(_within_blocks(words, percent), "a bigint, b bigint")
    return pairs.distinct()
