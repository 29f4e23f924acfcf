import pytest
from pyspark.sql import functions as F

from quayside.sources import audit
from quayside.sources.dialect import CsvDialect


def verdicts(spark, folder, names, **arguments):
    paths = spark.createDataFrame([(n,) for n in names], "path string").repartition(3)
    return {r.path: r.verdict for r in audit.audit_files(paths, folder, **arguments).collect()}


def test_every_input_gets_a_verdict(spark, folder, monkeypatch):
    monkeypatch.setattr(audit, "_BLOCK", 5)
    texts = {
        "ok.csv": "id,name\n1,x\n", "no end.CSV": "id,name\r\n1", "header.csv": "id,name\n", "bare.csv": "id", "empty.csv": "",
        "blank.csv": "id\n\n\r\n\n", "late.csv": "id" + "\n" * 100 + "5", "quoted.csv": '"a\nb"\n', "a.json": "{}", "none": "x",
    }
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w", newline="") as file:
            file.write(text)
    spark.range(3).coalesce(1).write.parquet(f"{folder}/p")
    spark.range(0).coalesce(1).write.parquet(f"{folder}/q")
    with open(f"{folder}/broken.parquet", "w") as file:
        file.write("not a table")
    import glob

    names = [*texts, "gone.csv", "gone.parquet", "broken.parquet", "p"]
    for kind in "pq":
        names += [p.removeprefix(f"{folder}/") for p in glob.glob(f"{folder}/{kind}/part*")]
    found = verdicts(spark, folder, names)
    parts = {kind: next(v for n, v in found.items() if n.startswith(f"{kind}/")) for kind in "pq"}
    assert parts == {"p": audit.OK, "q": audit.EMPTY}
    assert {n: found[n] for n in names if "/" not in n} == {
        "ok.csv": audit.OK, "no end.CSV": audit.OK, "header.csv": audit.EMPTY, "bare.csv": audit.EMPTY, "empty.csv": audit.EMPTY,
        "blank.csv": audit.EMPTY, "late.csv": audit.OK, "quoted.csv": audit.OK, "a.json": audit.UNSUPPORTED, "none": audit.UNSUPPORTED,
        "gone.csv": audit.MISSING, "gone.parquet": audit.MISSING, "broken.parquet": audit.UNREADABLE, "p": audit.UNSUPPORTED,
    }
    bare = verdicts(spark, folder, ["header.csv", "bare.csv", "empty.csv"], dialect=CsvDialect(header=False))
    assert bare == {"header.csv": audit.OK, "bare.csv": audit.OK, "empty.csv": audit.EMPTY}
    assert verdicts(spark, folder, []) == {}


@pytest.mark.parametrize(
    "table, query, wanted",
    [("t", None, audit.OK), (None, "q", audit.OK), ("t", "q", audit.BOTH_SOURCES), (None, None, audit.NO_SOURCE)],
)
def test_requests_name_one_source(spark, table, query, wanted):
    frame = spark.createDataFrame([(table, query)], "t string, q string")
    assert frame.select(audit.source_verdict(F.col("t"), F.col("q"))).first()[0] == wanted
