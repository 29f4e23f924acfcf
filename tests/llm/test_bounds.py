"""Samples, ids that a third of all rows share, and texts that are hard on patterns."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quayside.llm import fingerprint, language, neardup, packing, pii, quality, toxicity
from quayside.llm.common import bounded
from quayside.llm.queries import BYTE_TOKENIZER


def skewed(spark, hot, rows=9000):
    """A third of all rows with one id (or none), every row with a text of its own."""
    own = F.when(F.col("id") % 3 == 0, F.lit(hot).cast("long")).otherwise(F.col("id"))
    text = F.concat(F.lit("text of row number "), F.col("id"), F.lit(" word " * 3))
    return spark.range(rows).select(own.alias("doc_id"), text.alias("text"), F.lit("en").alias("lang"))


@pytest.mark.parametrize("hot", [7, None])
@pytest.mark.parametrize("seed", range(4))
def test_samples_keep_their_bound(spark, hot, seed):
    frame = skewed(spark, hot)
    drawn = bounded(frame, 1000, seed).collect()
    assert 900 <= len(drawn) <= 1000 and 230 <= sum(r.doc_id == hot for r in drawn) <= 440
    assert sorted(drawn, key=str) == sorted(bounded(frame.repartition(7), 1000, seed).collect(), key=str)
    assert bounded(frame, 9000, seed).count() == 9000
    same = spark.range(9000).select(F.lit(1).alias("k"), F.lit("x").alias("t"))
    assert bounded(same, 100, seed).count() <= 1


def test_models_learn_from_bounded_samples(spark, monkeypatch):
    frame = skewed(spark, 7, 3000)
    seen = []
    for module in (language, toxicity, quality):
        fit = module.fit
        monkeypatch.setattr(module, "fit", lambda *a, fit=fit, **k: seen.append(len(a[0])) or fit(*a, **k))
    language.learn(frame, rows=200)
    labels = spark.createDataFrame([(7, 1, 1), (8, 0, 0)], "doc_id long, quality int, toxic int")
    toxicity.learn(frame, labels, rows=50)
    quality.learn(frame, labels, rows=50)
    assert 150 <= seen[0] <= 200 and seen[1] <= 50 and seen[2] <= 100


def test_every_language_is_learnt(spark):
    frame = skewed(spark, 7, 3000).withColumn("lang", F.when(F.col("text").contains("number 44 "), "rare").otherwise("en"))
    assert language.learn(frame, rows=50).languages == ["en", "rare"]


@pytest.mark.parametrize("hot", [7, 8999, 0])
def test_a_hot_id_is_split_and_keeps_its_order(spark, hot):
    frame = skewed(spark, hot)
    placed = fingerprint.in_order(frame, partitions=8)
    sizes = [r["count"] for r in placed.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 9000 * 0.25
    rows = [r for part in placed.rdd.glom().collect() for r in [list(map(tuple, part))]]
    own = [r for part in rows for r in part if not r[2]]
    assert len(own) == 9000
    hashes = {r.text: r.h for r in frame.select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(own, key=lambda r: (-r[0], -hashes[r[1]]))
    follows = {order[k][1]: order[(k + 1) % len(order)][1] for k in range(len(order))}
    for part in rows:
        for a, b in zip(part, part[1:]):
            if not a[2]:
                assert follows[a[1]] == b[1]
        assert not part or part[-1][2]


def test_an_id_with_many_texts_links_its_classes(spark):
    words = lambda n: " ".join(f"w{n}x{k}" for k in range(30))
    rows = [(1, words(k)) for k in range(300)] + [(2, words(299)), (3, words(500))]
    found = neardup.link(spark, spark.createDataFrame(rows, "doc_id long, text string"), words=3, percent=85).collect()
    assert {(r.doc_id, r.component_id) for r in found} == {(1, 1), (2, 1), (3, 3)}


def test_repeated_rows_are_packed_by_many_groups(spark):
    frame = spark.range(4000).select(F.lit(1).alias("doc_id"), F.lit("some words to pack").alias("text"))
    rows = packing.pack(spark, frame, BYTE_TOKENIZER).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 4000


@pytest.mark.parametrize("text", ["1" * 10**6, "1." * 500_000, "1 " * 500_000, "+1" * 500_000, "a@" * 500_000, "+" + "1" * 10**6 + "-" * 10**6, "1.1.1" * 200_000])
def test_rules_take_linear_time(text):
    start = time.perf_counter()
    pii.base_spans(text)
    assert time.perf_counter() - start < 3


def test_digit_runs_equal_a_search_from_every_place():
    import random
    import re

    plain = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
    random_ = random.Random(1)
    for _ in range(3000):
        text = "".join(random_.choices("1.25 a", weights=[5, 4, 3, 1, 1, 1], k=30))
        assert [m.span() for m in pii._IP.finditer(text)] == [m.span() for m in plain.finditer(text)]


def test_recall_of_bands_at_the_threshold():
    """Pairs of texts with a likeness near 0.8 share a band nearly always, and fingerprints have few."""
    random_ = np.random.default_rng(4)
    letters = np.array(list("abcdefghijklmnopqrstuvwxyz    "))
    shared = total = 0
    counts = []
    for size in (20, 60, 130, 200, 400, 1500, 6000):
        for _ in range(120):
            text = "".join(random_.choice(letters, size))
            edited = list(text)
            for _ in range(max(1, int(size * random_.uniform(0.002, 0.03)))):
                edited[random_.integers(len(edited))] = str(random_.choice(letters))
            a, b = fingerprint.walk([fingerprint.classes(text), fingerprint.classes("".join(edited))])
            if 0.8 <= a.likeness(b) < 0.95:
                total += 1
                shared += len(np.intersect1d(fingerprint.band_keys(a), fingerprint.band_keys(b))) > 0
            counts.append(len(fingerprint.band_keys(a)))
    print(f"recall {shared / total:.4f} of {total}, keys {np.mean(counts):.1f}, at most {max(counts)}")
    assert total > 100 and shared / total >= 0.95 and max(counts) <= 160
