import os

import pytest
from pyspark.sql import functions as F

from quayside.operators.export import PARQUET_CODECS, export, export_json
from quayside.sources.dialect import CsvDialect
from quayside.sources.scan import scan_csv, scan_parquet, zero_rows


@pytest.fixture(scope="module", autouse=True)
def people(spark):
    rows = [(1, "Ann", 9.5, True), (2, None, 8.0, False), (3, "O'Neil, \"Z\"", None, True)]
    spark.createDataFrame(rows, "id int, name string, score double, active boolean") \
        .coalesce(1).createOrReplaceTempView("people")


def text_of(result):
    return "".join(open(path.removeprefix("file:")).read() for path in result.paths)


def test_csv_text(spark, folder):
    result = export(spark, f"{folder}/p.csv", "csv", table="people")
    assert result.rows == 3
    assert text_of(result) == (
        'id,name,score,active\n1,Ann,9.5,true\n2,,8.0,false\n3,"O\'Neil, ""Z""",,true\n'
    )


def test_csv_settings(spark, folder):
    dialect = CsvDialect("\t", "'", header=False, null_value="NA")
    result = export(spark, f"{folder}/p.csv", "CSV", table="people", dialect=dialect)
    assert text_of(result) == "1\tAnn\t9.5\ttrue\n2\tNA\t8.0\tfalse\n3\t'O''Neil, \"Z\"'\tNA\ttrue\n"


def test_query_with_filter(spark, folder):
    query = "SELECT id, name FROM people WHERE active = true -- only these"
    for format in ("csv", "parquet"):
        assert export(spark, f"{folder}/q.{format}", format, query=query).rows == 2


def test_codecs(spark, folder):
    for codec in [*PARQUET_CODECS, None]:
        path = f"{folder}/{codec}.parquet"
        result = export(spark, path, "parquet", table="people", compression=codec)
        assert result.rows == 3 and scan_parquet(spark, path).count() == 3
        import pyarrow.parquet as pq

        found = pq.ParquetFile(result.paths[0].removeprefix("file:")).metadata.row_group(0).column(0)
        wanted = {"none": "UNCOMPRESSED", None: "SNAPPY"}.get(codec, str(codec).upper())
        assert found.compression == wanted


def test_rejected_arguments(spark, folder):
    out = f"{folder}/x"
    cases = [
        ({"format": "csv", "table": "people", "compression": "snappy"}, "only supported for Parquet"),
        ({"format": "parquet", "table": "people", "compression": "brotli"}, "unknown compression"),
        ({"format": "csv"}, "either table or query"),
        ({"format": "csv", "table": "people", "query": "SELECT 1"}, "together"),
        ({"format": "orc", "table": "people"}, "unsupported export format"),
        ({"format": "csv", "table": "people", "max_file_size": "1.5MB"}, "invalid size"),
        ({"format": "csv", "query": "SELECT array(1) AS a, 2 AS b"}, "written as CSV: a"),
    ]
    for arguments, message in cases:
        with pytest.raises(ValueError, match=message):
            export(spark, out, **arguments)
    assert os.listdir(folder) == []


def test_missing_directory_is_named(spark, folder):
    with pytest.raises(FileNotFoundError, match="nowhere/x.csv"):
        export(spark, f"{folder}/nowhere/x.csv", "csv", table="people")


def test_missing_table_and_bad_query(spark, folder):
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        export(spark, f"{folder}/x.csv", "csv", table="no.such")
    with pytest.raises(Exception, match="PARSE_SYNTAX_ERROR"):
        export(spark, f"{folder}/x.csv", "csv", query="SELEC * FROM people")


def test_empty_results(spark, folder):
    query = "SELECT * FROM people WHERE id > 9"
    result = export(spark, f"{folder}/e.csv", "csv", query=query)
    assert result.rows == 0 and text_of(result) == "id,name,score,active\n"
    assert export(spark, f"{folder}/e.parquet", "parquet", query=query).rows == 0
    assert spark.read.parquet(f"{folder}/e.parquet").schema == spark.table("people").schema


def test_manifest(spark, folder):
    result = export(
        spark, f"{folder}/m.csv", "csv", table="people", max_rows_per_file=2, order_by=["id"]
    )
    rows = result.manifest(spark).orderBy("file_id").collect()
    assert [(r.file_id, r.file_name) for r in rows] == [(0, "m_000.csv"), (1, "m_001.csv")]
    assert [r.bytes for r in rows] == [os.path.getsize(r.path) for r in rows]
    assert [r.rows for r in rows] == [2, 1]


def test_json_rows(spark, folder):
    result = export_json(spark.table("people"), f"{folder}/p.json")
    assert result.rows == 3
    assert text_of(result).splitlines()[1] == '{"id":2,"score":8.0,"active":false}'


def test_zero_rows_reads_nothing(spark):
    empty = zero_rows(spark.table("people"))
    assert empty.schema == spark.table("people").schema
    plan = empty._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in plan and "Range" not in plan


def test_filters_and_columns_reach_the_scan(spark, folder):
    spark.range(100).selectExpr("id", "id * 2 AS b", "id * 3 AS c").write.parquet(f"{folder}/w")
    query = f"SELECT id FROM parquet.`{folder}/w` WHERE b > 10"
    plan = spark.sql(query)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(b), GreaterThan(b,10)]" in plan
    assert "ReadSchema: struct<id:bigint,b:bigint>" in plan


def test_split_plan_shuffles_the_rows_once(spark, folder):
    """Stored rows are numbered in place: a broadcast lookup, then one exchange by file."""
    from quayside.operators.numbering import number_rows, position_rows
    from quayside.operators.split import FILE_ID, SplitLimits, assign_files, place_files

    spark.range(0, 1000, 1, 4).write.parquet(f"{folder}/in")
    positioned = position_rows(spark.read.parquet(f"{folder}/in"), True, f"{folder}/scratch")
    assert not os.path.exists(f"{folder}/scratch")
    numbered = number_rows(positioned, f"{folder}/offsets")
    assigned = assign_files(numbered, SplitLimits(max_rows=300), None, f"{folder}/stretches")
    placed = place_files(assigned, numbered.file_bytes)
    placed.write.format("noop").mode("overwrite").save()
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") == 1
    assert plan.count("Exchange shufflepartitionidpassthrough") == 1
    assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan
    assert placed.agg(F.max(FILE_ID)).first()[0] == 3
