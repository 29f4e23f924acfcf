"""Column functions against a character-by-character model of the same rules."""

import random

import pytest
from pyspark.sql import functions as F

from quayside.functions import sqltext


def spans(text):
    """Model scanner: (kind, text) pieces; kind is code, quote, comment or cut."""
    found, i = [], 0
    while i < len(text):
        if text[i] in "'\"":
            end = text.find(text[i], i + 1)
            kind, stop = "quote", len(text) if end < 0 else end + 1
        elif text.startswith("--", i):
            end = text.find("\n", i)
            kind, stop = "comment", len(text) if end < 0 else end
        elif text.startswith("/*", i):
            end = text.find("*/", i + 2)
            kind, stop = "comment", len(text) if end < 0 else end + 2
        else:
            kind, stop = ("cut" if text[i] == ";" else "code"), i + 1
        found.append((kind, text[i:stop]))
        i = stop
    return found


def model_strip(text):
    return "".join(" " if kind == "comment" else part for kind, part in spans(text))


def model_split(text):
    pieces = [""]
    for kind, part in spans(text):
        if kind == "cut":
            pieces.append("")
        else:
            pieces[-1] += part
    return [piece.strip() for piece in pieces if model_strip(piece).strip()]


HAND_MADE = [
    "", " \n\t ", ";;;", "SELECT 1", "SELECT 1;", "a; b ;c", "  a  ;  b  ",
    "INSERT INTO t VALUES ('x;y'); SELECT \"p;q\" FROM t",
    "-- c; d\nSELECT 1", "/* a; b */ SELECT 1; SELECT /**/ 2", "SELECT 1 /* open; ended",
    "-- only\n/* comments */", "SELECT '--no' ; SELECT '/*no;*/'", "SELECT 1 - 2; SELECT 4 / 2",
    "'it''s; fine'; x", "'open; quote", "\"open; name", "/*/ ; */ x; y", "a\u0001b\u0002;c\u0002a",
    "  SELECT　1 ; ", "SELECT 'ünï — 漢字' /* 漢; */ AS v; x",
    "--a\r\n;b--c;d", "- - /- *;", "x/*;*/;*/;y",
]


@pytest.fixture(scope="module")
def texts(spark):
    pick = random.Random(11)
    alphabet = list("a;'\"-/*\n b") + ["--", "/*", "*/", "ä", "\u0001", "\u0002"]
    made = ["".join(pick.choice(alphabet) for _ in range(pick.randint(0, 25))) for _ in range(3000)]
    return HAND_MADE + made


def mapped(spark, texts, function):
    rows = list(enumerate(texts))
    frame = spark.createDataFrame(rows, "i int, t string")
    return [r[1] for r in frame.select("i", function(F.col("t"))).orderBy("i").collect()]


def test_split(spark, texts):
    for text, found in zip(texts, mapped(spark, texts, sqltext.split_statements)):
        assert found == model_split(text), text


def test_strip(spark, texts):
    for text, found in zip(texts, mapped(spark, texts, sqltext.strip_comments)):
        assert found == model_strip(text), text


def test_long_scripts_are_whole(spark):
    text = "".join(f"INSERT INTO t VALUES ({i}, '{'x' * 50};');\n" for i in range(20000))
    text += "/*" + "y;" * 500000 + "*/ SELECT '" + ";z" * 500000 + "'"
    found = mapped(spark, [text], sqltext.split_statements)[0]
    assert len(found) == 20001 and found == model_split(text)


def test_classify(spark):
    cases = {
        "SELECT 1": "Query", "  with x as (select 1) select 1": "Query", "DESCRIBE t": "Query",
        "explain select 1": "Query", "Show TABLES": "Query", "insert into t values (1)": "Dml",
        "UPDATE t SET a = 1": "Dml", "Delete FROM t": "Dml", "MERGE INTO t USING s ON 1": "Dml",
        "execute script s.r()": "Execute", "/* h */ EXECUTE SCRIPT r()": "Execute",
        "CREATE TABLE t (a INT)": "Ddl", "GRANT SELECT ON t TO u": "Ddl", "": "Ddl",
        "-- nothing\n": "Ddl", "SELECT(1)": "Ddl", "SELECT/**/1": "Query",
        "-- a\n/* b */\tINSERT INTO t SELECT 1": "Dml", "'SELECT' 1": "Ddl",
    }
    assert dict(zip(cases, mapped(spark, list(cases), sqltext.classify))) == cases


def test_truncate(spark):
    cases = {
        "  SELECT 1 \n": "SELECT 1",
        "q" * 60: "q" * 60,
        "q" * 61: "q" * 57 + "...",
        "ä" * 30: "ä" * 30,
        "ä" * 40: "ä" * 40 + "...",
        "ä" * 70: "ä" * 57 + "...",
    }
    assert dict(zip(cases, mapped(spark, list(cases), sqltext.truncate_sql))) == cases


def test_error_hints(spark):
    cases = {
        "Object T1 NOT FOUND": sqltext.HINT_OBJECT,
        "not found": None,
        "object not allowed": sqltext.HINT_PERMISSION,
        "Insufficient Privileges": sqltext.HINT_PERMISSION,
        "Syntax Error, connection kept": sqltext.HINT_SYNTAX,
        "could not connect": sqltext.HINT_CONNECTION,
        "something else": None,
    }
    assert dict(zip(cases, mapped(spark, list(cases), sqltext.error_hint))) == cases
