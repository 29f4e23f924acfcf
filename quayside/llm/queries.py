"""The registered queries of this package, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import (
    collocations, fingerprint, language, lexical, licenses, neardup, packing, pieces, pii, quality, secret_scan, topk, toxicity,
)
from quayside.llm.common import crc32_of, ship, table

#: The vocabularies of public tokenizers.
PIECE_MODEL, BYTE_TOKENIZER = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_and_link(spark, table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held_out = table(spark, sf_dir, "documents"), crc32_of("doc_id") % 5 == 0
    model = toxicity.learn(documents, table(spark, sf_dir, "labels").where(~held_out))
    scored = documents.select("doc_id", held_out.alias("held_out"), toxicity.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held_out = table(spark, sf_dir, "documents"), crc32_of("doc_id") % 4 == 2
    model = language.learn(documents.where(~held_out))
    return documents.select("doc_id", held_out.alias("held_out"), language.identify(F.col("text"), model).alias("r")).select(
        "doc_id", "held_out", "r.*"
    )


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(PIECE_MODEL, "rb") as file:
        content = file.read()
    found = pieces.digest(F.col("text"), content)
    return table(spark, sf_dir, "documents").select("doc_id", found.alias("r")).select("doc_id", "r.*")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, held_out = table(spark, sf_dir, "documents"), crc32_of("doc_id") % 5 == 0
    model = quality.learn(documents, table(spark, sf_dir, "labels"), may_learn=~held_out)
    scored = documents.select("doc_id", held_out.alias("held_out"), quality.score(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = pii.learn(documents)
    return documents.select("doc_id", pii.digest(F.col("text"), model).alias("r")).select("doc_id", "r.*")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return licenses.scan(documents, licenses.learn(documents))


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.link(spark, table(spark, sf_dir, "documents"), words=3, percent=85)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), BYTE_TOKENIZER)


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.digest(F.col("text")).alias("r")
    return table(spark, sf_dir, "documents").select("doc_id", found).select("doc_id", "r.*")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(spark, table(spark, sf_dir, "documents"))


def op13_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.rank(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def _shipped(query):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: _shipped(f)
    for f in (
        op1_fingerprints, op2_toxicity, op3_language, op4_sentencepiece, op5_quality, op6_pii, op7_licenses,
        op8_topk, op9_neardup, op10_packing, op11_secrets, op12_collocations, op13_lexical,
    )
}

_VALID = (
    "vec_id IS NOT NULL AND embedding IS NOT NULL"
    " AND len(list_filter(embedding, lambda v: v IS NULL OR isnan(v) OR isinf(v))) = 0"
)

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The same results in DuckDB's SQL, for those that SQL can express.
ORACLES = {
    "op8_topk": f"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256.0 * CAST(x AS DOUBLE))) AS e FROM embeddings WHERE {_VALID}),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op12_collocations": f"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS words FROM d),
s AS (SELECT lang, words, unnest(range(1, 6)) AS k FROM w),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS phrase
      FROM s WHERE len(words) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY ALL),
t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS words, f AS a FROM f WHERE k >= 2 AND f >= 100),
x AS (SELECT lang, a, words, k, unnest(range(2, k)) AS m FROM c),
y AS (SELECT lang, a, words, m, unnest(range(1, k - m + 2)) AS i FROM x),
z AS (SELECT lang, array_to_string(words[i:i + m - 1], ' ') AS phrase, max(a) AS around FROM y GROUP BY ALL),
o AS (SELECT c.* FROM c LEFT JOIN z USING (lang, phrase) WHERE around IS NULL OR 100 * around < 100 * a),
u AS (SELECT *, unnest(range(1, k)) AS cut FROM o),
v AS (SELECT u.lang, u.phrase, a, cut, l.f AS l, r.f AS r, n, CAST((1000 * CAST(a AS HUGEINT) * n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
      FROM u JOIN t USING (lang)
      JOIN f l ON l.lang = u.lang AND l.phrase = array_to_string(words[1:cut], ' ')
      JOIN f r ON r.lang = u.lang AND r.phrase = array_to_string(words[cut + 1:], ' ')),
m AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
q AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM m)
SELECT lang, rank, phrase, a, l, r, n, score FROM q WHERE rank <= 2000""",
    "op13_lexical": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS d, regexp_extract_all({_LOWER}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') AS t FROM documents),
i AS (SELECT DISTINCT item_id, text, regexp_extract_all({_LOWER}, '[a-z0-9\\x{{80}}-\\x{{10FFFF}}]+') AS t FROM benchmark),
s AS (SELECT count(*) AS docs, CAST(sum(len(t)) AS BIGINT) AS terms FROM d WHERE len(t) > 0),
p AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * docs + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term, docs),
m AS (SELECT d, doc_id, 100 - 25 + ((25 * len(t) * docs) // terms) AS m FROM d, s),
q AS (SELECT item_id, text, term, count(*) AS times FROM (SELECT item_id, text, unnest(t) AS term FROM i) GROUP BY ALL),
r AS (SELECT item_id, text, d, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM q JOIN w USING (term) JOIN p USING (term) JOIN m USING (d) GROUP BY ALL),
k AS (SELECT *, row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id, d) AS rank FROM r WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM k WHERE rank <= 20""",
}
