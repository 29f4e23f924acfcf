import duckdb
import pytest
from pyspark.sql import functions as F

from quayside.llm.common import ship

SMALL = "/root/testdata/sf0.001"

#: Nulls in every column, empty and long texts, ties and repeated rows.
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today", "en", "a", 10),
    (2, None, "en", "a", 10),
    (3, "", "en", None, None),
    (4, "the quick brown fox jumps over the lazy dog near the river bank today", None, "b", 1),
    (None, "the quick brown fox jumps over the lazy dog near the river bank today", "en", "b", 1),
    (5, " \n\t ", "en", "b", 1),
    (6, "12 34 !!", "en", "b", 1),
    (7, "mail me at someone@example.com or +1 (415) 555-0100 from 10.0.0.1, card 4111 1111 1111 1111.", "en", "b", 1),
    (7, "mail me at someone@example.com or +1 (415) 555-0100 from 10.0.0.1, card 4111 1111 1111 1111.", "en", "b", 1),
    (8, "Der schnelle braune Fuchs springt über den faulen Hund 日本 😀 a  b", "de", "b", 1),
    (9, "word " * 9000, "en", "b", 1),
    (10, "x" * 5000, "en", "b", 1),
    (None, None, None, None, None),
]
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="session")
def odd(spark):
    """With columns whose names clash with those that operators make."""
    frame = spark.createDataFrame(ODD, COLUMNS)
    return frame.select("*", *(F.lit("x").alias(c) for c in ("id", "t", "r", "score", "label", "comp", "k", "_score", "piece")))


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SMALL}/labels.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.select("doc_id", "text").collect()}


@pytest.fixture(scope="session")
def held(spark):
    """(text, lang, quality, toxic) of the larger table, to learn from and to hold out."""
    path = "/root/testdata/sf0.01"
    return duckdb.sql(
        f"SELECT doc_id, text, lang, quality, toxic FROM '{path}/documents.parquet' LEFT JOIN '{path}/labels.parquet' USING (doc_id) ORDER BY 1"
    ).fetchall()
