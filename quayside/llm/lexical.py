"""Ranking of all documents for each query item by their shared terms, with integer scores.

Terms are owned by stages, the rarest terms by the first.  Items travel in bundles, and a bundle visits
the owners one after the other, by one cogroup for each stage: it brings the sparse accumulators that its
items have of documents so far (the documents' rows and scores) and meets the owner's postings, which add
their integer contributions.  Bundles and postings are dealt by shards of documents, so that a common term,
which most documents hold, is spread over as many groups as it needs.

Between stages an accumulator is dropped only if it is lost: if its score with everything that the item's
later terms can still add stays under the score that k documents of its shard have already.  A document
dropped so may come back with a part of its score, which then is under that bound too; results are exact.
The last owner hands over the best documents of each shard.

The documents are read once; of their terms those are kept that may be an item's, by a bitmap of fixed size.

Defined results: null and empty texts, of documents and items, have no terms.  Every row of documents counts
as a document; one without an id counts in all statistics and is not returned.  Rows that repeat an id are
ranked each by itself.  Items without an id are left out, and repeated rows of an item are answered once.
Only scores above 0 are returned; equal scores go by the document's id.  An empty table on either side gives
no rows.  Texts are read whole, whatever their length.  Only the named columns are read.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm.common import Remembered, Staged, slices, worker_wide

#: Owners of terms: the first has those in fewer than a thousandth of all documents, and so on.
OWNER_SHARES = (1000, 100, 10)
OWNERS = len(OWNER_SHARES) + 1
#: Items that travel together at about, postings of a shard at about, and bits that tell items' terms.
BUNDLE_ITEMS, SHARD_POSTINGS, VOCABULARY_BITS = 256, 400_000, 1 << 22

#: Lower-case ASCII; everything in ASCII that is no letter or digit is a blank.
_PLAIN = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def _terms(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


def term_counts(text: Column, bits: np.ndarray | None = None) -> Column:
    """A struct of a text's number of terms, and its distinct terms with their occurrences; only those in the bitmap, if given."""

    def known() -> Remembered:
        return Remembered(lambda term: bool(bits[(at := zlib.crc32(term) % VOCABULARY_BITS) >> 3] >> (at & 7) & 1))

    get = worker_wide(known)

    def run(texts: pa.Array) -> pa.Array:
        sizes, counts, terms, ends = [], [], [], [0]
        wanted = get() if bits is not None else None
        for part in slices(texts):
            for own in part.cast(pa.binary()).to_pylist():
                found = _terms(own) if own else []
                sizes.append(len(found))
                if wanted is not None:
                    found = [t for t in found if wanted[t]]
                tally = Counter(found)
                terms += tally.keys()
                counts += tally.values()
                ends.append(len(terms))
            if wanted is not None:
                wanted.settle()
        offsets = pa.array(ends, pa.int32())
        return pa.StructArray.from_arrays(
            [
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(offsets, pa.array(terms, pa.binary()).cast(pa.string())),
                pa.ListArray.from_arrays(offsets, pa.array(counts, pa.int64())),
            ],
            ["n", "terms", "counts"],
        )

    return F.arrow_udf(run, "struct<n: bigint, terms: array<string>, counts: array<bigint>>").asNondeterministic()(text)


def _vocabulary_bits(terms: DataFrame) -> np.ndarray:
    """A bitmap of the terms' CRC-32; one row for 32 bits comes to the driver, so its size is bounded."""
    place = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(VOCABULARY_BITS))
    words = terms.select(place.alias("p")).groupBy(F.expr("p div 32").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p % 32 as int))")).alias("bits")
    )
    found = words.toArrow()
    out = np.zeros(VOCABULARY_BITS // 32, dtype=np.uint32)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out.astype("<u4").view(np.uint8)


_STATE = "bundle int, shard int, item bigint, terms array<bigint>, weights array<bigint>, owners array<int>, most array<bigint>, rows array<bigint>, docs array<bigint>, scores array<bigint>"


def _numbers(column: pa.ChunkedArray, row: int) -> np.ndarray:
    return column[row].values.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])]) if parts else [0]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts) if parts else [], pa.int64()))


def _visit(owner: int, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """One stage: what a bundle takes along after meeting this owner's postings in one shard."""

    def run(bundle: pa.Table, postings: pa.Table) -> pa.Table:
        if len(postings):
            order = np.argsort(postings["term"].to_numpy(), kind="stable")
            term, row, doc, impact = (postings[c].to_numpy()[order] for c in ("term", "row", "doc", "impact"))
        else:
            term = row = doc = impact = np.zeros(0, dtype=np.int64)
        carried = bundle["rows"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        carried_docs = bundle["docs"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        space, first, place = np.unique(np.concatenate([row, carried]), return_index=True, return_inverse=True)
        doc_of = np.concatenate([doc, carried_docs])[first]
        posting_at = place[: len(row)]
        out: dict[str, list[np.ndarray]] = {"rows": [], "docs": [], "scores": []}
        for item in range(len(bundle)):
            owners, terms, weights = (_numbers(bundle[c], item) for c in ("owners", "terms", "weights"))
            ahead = int(_numbers(bundle["most"], item)[owners > owner].sum())
            sums = np.zeros(len(space), dtype=np.int64)
            sums[np.searchsorted(space, _numbers(bundle["rows"], item))] = _numbers(bundle["scores"], item)
            mine = owners == owner
            starts, stops = np.searchsorted(term, terms[mine], "left"), np.searchsorted(term, terms[mine], "right")
            for start, stop, weight in zip(starts, stops, weights[mine], strict=True):
                # A document has one posting of a term, so no place occurs twice here.
                sums[posting_at[start:stop]] += weight * impact[start:stop]
            there = np.flatnonzero(sums)
            if len(there) > k:
                bound = np.partition(sums[there], len(there) - k)[len(there) - k]
                there = there[sums[there] + ahead >= bound]
            if owner == OWNERS - 1:
                there = there[np.lexsort((space[there], doc_of[there], -sums[there]))[:k]]
            out["rows"].append(space[there])
            out["docs"].append(doc_of[there])
            out["scores"].append(sums[there])
        for name, parts in out.items():
            bundle = bundle.set_column(bundle.schema.get_field_index(name), name, _lists(parts))
        return bundle

    return run


def _with_scores(spark: SparkSession, documents: DataFrame, items: DataFrame, doc_key: str, item_key: str, text: str, staged: Staged):
    """Staged postings by owner and staged bundles; none, if no document has a term of an item."""
    asked = items.where(F.col(item_key).isNotNull()).select(F.col(item_key).alias("item_id"), F.col(text).alias("text"))
    asked = asked.dropDuplicates(["item_id", "text"]).select("item_id", term_counts(F.col("text")).alias("t"))
    asked = staged(asked.select(F.monotonically_increasing_id().alias("item"), "item_id", "t.*"))
    bundles = max(1, -(-asked.count() // BUNDLE_ITEMS))
    asked_terms = asked.select(
        "item", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int").alias("bundle"), F.explode(F.arrays_zip("terms", "counts")).alias("z")
    ).select("item", "bundle", F.col("z.terms").alias("term"), F.col("z.counts").alias("times"))

    bits = _vocabulary_bits(asked_terms)
    read = documents.select(F.col(doc_key).cast("bigint").alias("doc"), term_counts(F.col(text), bits).alias("t"))
    read = staged(read.select(F.monotonically_increasing_id().alias("row"), "doc", "t.*"))
    whole = read.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("l")).first()
    if not whole.n:
        return None
    length = F.expr(f"100 - 25 + ((25 * n * {whole.n}L) div {whole.l}L)")
    postings = read.select("row", "doc", length.alias("m"), F.explode(F.arrays_zip("terms", "counts")).alias("z")).select(
        "row", "doc", F.col("z.terms").alias("term"), F.expr("(1000000000L * z.counts) div (1000L * z.counts + 12 * m)").alias("impact")
    )

    # By term: where its postings go, what it weighs and what it can add at most.
    held = postings.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("impact").alias("most"))
    owner = F.lit(len(OWNER_SHARES))
    for n, share in reversed(list(enumerate(OWNER_SHARES))):
        owner = F.when(F.col("df") * share < whole.n, n).otherwise(owner)
    weight = F.floor(1000 * F.log((F.lit(2.0) * whole.n + 2) / (F.lit(2.0) * F.col("df") + 1))).cast("bigint")
    held = held.select("term", "df", "most", weight.alias("weight"), owner.cast("int").alias("owner"))
    wanted = staged(asked_terms.groupBy("term").agg(F.collect_set("bundle").alias("bundles")))
    held = staged(held.join(wanted, "term").where("weight > 0").select(F.monotonically_increasing_id().alias("term_no"), "*"))
    size = held.agg(F.sum(F.col("df") * F.size("bundles")).alias("s")).first().s
    if not size:
        return None
    shards = -(-size // SHARD_POSTINGS)

    dealt = postings.where("doc IS NOT NULL").join(held.select("term", "term_no", "owner", "bundles"), "term").select(
        F.explode("bundles").alias("bundle"), F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int").alias("shard"),
        "owner", F.col("term_no").alias("term"), "row", "doc", "impact",
    )
    plan = asked_terms.join(held.drop("bundles"), "term").groupBy("bundle", "item").agg(
        F.collect_list(F.struct(
            F.col("term_no").alias("terms"), (F.col("times") * F.col("weight")).alias("weights"), F.col("owner").alias("owners"),
            (F.col("times") * F.col("weight") * F.col("most")).alias("most"),
        )).alias("p")
    )
    none = F.array().cast("array<bigint>")
    start = plan.select(
        "bundle", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "item",
        "p.terms", "p.weights", "p.owners", "p.most", none.alias("rows"), none.alias("docs"), none.alias("scores"),
    )
    dealt = staged(dealt)
    staged.drop(read)
    return dealt, start, asked.select("item", "item_id")


def rank(
    spark: SparkSession, documents: DataFrame, items: DataFrame, k: int = 20, doc_key: str = "doc_id", item_key: str = "item_id", text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents."""
    staged = Staged(spark, "lexical")
    item_type = items.schema[item_key].dataType.simpleString()
    prepared = _with_scores(spark, documents, items, doc_key, item_key, text, staged)
    if prepared is None:
        return spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id bigint, score bigint")
    dealt, state, names = prepared
    for owner in range(OWNERS):
        met = dealt.where(F.col("owner") == owner).drop("owner")
        state = state.groupBy("bundle", "shard").cogroup(met.groupBy("bundle", "shard")).applyInArrow(_visit(owner, k), _STATE)
    best = state.select("item", F.explode(F.arrays_zip("rows", "docs", "scores")).alias("z")).select(
        "item", F.col("z.rows").alias("row"), F.col("z.docs").alias("doc_id"), F.col("z.scores").alias("score")
    )
    ranked = best.selectExpr("*", "row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id, row) AS rank").where(F.col("rank") <= k)
    return ranked.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
