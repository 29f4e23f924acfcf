from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from check import compare, connect
from quayside.llm import pii
from quayside.llm.queries import ORACLES, QUERIES

SMALL = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_query_with_reference_sql(spark, key):
    assert compare(spark, connect(SMALL), SMALL, key) is None


def test_stages_on_odd_rows(spark, odd, empty):
    docs = odd
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        assert docs.columns == corpus_pipeline.COLUMNS
    corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_language_stage_rejects_what_no_language_makes_likely(spark):
    folder = "/root/testdata/sf0.01"
    own = spark.read.parquet(f"{folder}/documents.parquet").select(corpus_pipeline.COLUMNS)
    strange = ["яблоко груша слива вишня " * 20, "漢字仮名 交文 " * 30, "12 34 !!"]
    rows = [(-1 - k, t, None, "s", len(t)) for k, t in enumerate(strange)]
    unnamed = own.limit(50).withColumn("lang", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10**6)
    docs = own.union(spark.createDataFrame(rows, own.schema)).union(unnamed)
    kept = corpus_pipeline.find_language(spark, docs, folder)
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    assert not ids & {-1, -2, -3} and kept.where("doc_id >= 0 AND doc_id < 1000000").count() == own.count()
    # A language that was not given is filled in.
    wanted = {r.doc_id: r.lang for r in own.collect()}
    filled = kept.where("doc_id >= 1000000").collect()
    assert len(filled) == 50 and sum(r.lang == wanted[r.doc_id - 10**6] for r in filled) >= 49


def test_near_duplicates_are_decided_by_row(spark):
    text = lambda n: " ".join(f"w{n}x{k}" for k in range(40))
    rows = [(5, text(1)), (5, text(1)), (None, text(2)), (None, text(2)), (3, text(2)), (None, text(4)), (None, text(4))]
    # One id with many texts, of which one is near a document with a smaller id.
    rows += [(9, text(k)) for k in range(10, 15)] + [(2, text(12) + " more"), (6, " "), (6, " "), (7, " "), (7, None), (7, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, SMALL).collect()
    wanted = [(5, text(1)), (3, text(2)), (None, text(4)), *((9, text(k)) for k in (10, 11, 13, 14)), (2, text(12) + " more")]
    wanted += [(6, " "), (7, " "), (7, None)]
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept))) == sorted(map(str, wanted))


def test_each_stage_takes_effect(spark, tmp_path):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    docs, counts = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(docs.count())
    assert counts[0] == documents.count() > counts[1] > counts[2] == counts[3]
    texts = [r.text for r in docs.collect()]
    assert not any(pii.base_spans(t) for t in texts) and any("[EMAIL]" in t for t in texts)
    assert docs.where(F.length("text") != F.col("n_chars")).isEmpty()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    sequences = defaultdict(int)
    for r in packed:
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 1024


def test_run_gives_the_same_rows(spark):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and len({(r.doc_id, r.piece) for r in rows}) == len(rows)
