"""From documents to packed training sequences: five stages, each written as Parquet and read by the next.

1. ``language`` drops documents without any text in a language that was learnt (null, no letter, or letters that
   no learnt language makes likelier than evenly drawn ones, as other scripts), and fills in a missing ``lang``.
2. ``quality`` drops documents that the quality classifier predicts to be 0.
3. ``near_duplicates`` keeps of each group of near duplicates the one row with the smallest id.
4. ``personal_data`` replaces personal data in the texts by its kind in brackets.
5. ``packing`` cuts the texts into token pieces and packs these into sequences.

Every stage but the last returns the columns of documents, ``n_chars`` matching its ``text``.  A table
without rows passes through all stages; null texts go in the first; null ids stay until the last stage.
Columns beyond those of documents are dropped by the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import language, neardup, packing, pii, quality
from quayside.llm.common import Staged, crc32_of, ship, table
from quayside.llm.queries import BYTE_TOKENIZER

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Quality from which a document stays.
LEAST_QUALITY = 0.3


def find_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = language.learn(docs.where(crc32_of("doc_id") % 4 != 2))
    found = docs.withColumn("_found", language.identify(F.col("text"), model))
    # What no learnt language makes likelier than chance is text in another one, or no language at all.
    kept = found.where("_found.lang_pred <> 'und' AND _found.margin > 0")
    return kept.withColumn("lang", F.coalesce("lang", "_found.lang_pred")).select(COLUMNS)


def find_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    model = quality.learn(docs, table(spark, sf_dir, "labels"), may_learn=crc32_of("doc_id") % 5 != 0)
    scored = docs.withColumn("_score", quality.score(F.col("text"), model))
    return scored.where(F.col("_score") >= LEAST_QUALITY).select(COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row is a document of its own: of a group, and of rows that repeat an id and a text, one row stays.

    It is the one with the smallest id (an id before none), then by a hash of its columns.  Texts without
    any word are in no group.
    """
    ship(spark)
    staged = Staged(spark, "rows")
    # Written once, a row keeps its number.
    rows = staged(docs.select(*COLUMNS, F.monotonically_increasing_id().alias("_row")))
    found = neardup.link(spark, rows.select("_row", "text"), key="_row").select(F.col("doc_id").alias("_row"), "n_shingles", "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text", "lang", "source", "n_chars"), "_row")
    own = rows.select("_row", "doc_id", F.xxhash64(F.lit(1), F.col("text").isNull(), "text").alias("_text"), order.alias("_order")).join(found, "_row")
    wordless = F.col("n_shingles") == 0
    group = [F.when(~wordless, F.col("component_id")), *(F.when(wordless, F.col(c)) for c in ("doc_id", "_text"))]
    kept = own.groupBy(*(g.alias(f"_g{k}") for k, g in enumerate(group))).agg(F.min("_order").alias("o")).select("o._row")
    return rows.join(kept, "_row", "left_semi").select(COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    masked = pii.masked(F.col("text"), pii.learn(docs))
    return docs.withColumn("text", masked).withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return packing.pack(spark, docs, BYTE_TOKENIZER)


STAGES = [
    ("language", find_language),
    ("quality", find_quality),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: Learnt models, near duplicates and packing are beyond SQL; tests hold the stages against plain versions or planted rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents."""
    staged, docs = Staged(spark, "pipeline"), table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
