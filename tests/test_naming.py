import pytest
from pyspark.sql import functions as F

from quayside.functions.naming import (
    detect_format,
    format_of,
    parse_size,
    split_file_name,
    split_file_path,
    table_identifier,
)


@pytest.mark.parametrize(
    "text, size",
    [("7", 7), ("64kb", 64_000), (" 3 MB ", 3_000_000), ("5Gb", 5_000_000_000), ("0KB", 0)],
)
def test_sizes(text, size):
    assert parse_size(text) == size


@pytest.mark.parametrize("text", ["", "  ", "xMB", "-2KB", "2.5GB", "KB", "10TB", "99999999999999GB"])
def test_bad_sizes(text):
    with pytest.raises(ValueError):
        parse_size(text)


def test_split_names(spark):
    cases = {
        ("/a/b.csv", 0): "/a/b_000.csv",
        ("b.parquet", 42): "b_042.parquet",
        ("/a/b", 10): "/a/b_010",
        ("s3://k/b.csv", 12345): "s3://k/b_12345.csv",
        ("/a.d/b", 1): "/a.d/b_001",
        ("/a/b.tar.gz", 1): "/a/b.tar_001.gz",
        ("/a/.b", 1): "/a/.b_001",
        ("/a/50%.csv", 1): "/a/50%_001.csv",
    }
    for (path, index), wanted in cases.items():
        assert split_file_path(path, index) == wanted
        name = spark.sql("SELECT 1").select(split_file_name(path, F.lit(index))).first()[0]
        assert name == wanted.rpartition("/")[2]


def test_formats(spark):
    cases = {"x.csv": "csv", "/d/X.CSV": "csv", "a.b.Parquet": "parquet", "x.json": None,
             "x": None, "d.csv/x": None, ".csv": None}
    frame = spark.createDataFrame([(path,) for path in cases], "path string")
    found = dict(frame.select("path", format_of(F.col("path"))).collect())
    assert found == cases
    for path, wanted in cases.items():
        if wanted:
            assert detect_format(path) == wanted
        else:
            with pytest.raises(ValueError, match=r"\.parquet, \.csv"):
                detect_format(path)


def test_table_identifiers():
    assert table_identifier("t") == "`t`"
    assert table_identifier("s.Order") == "`s`.`Order`"
    assert table_identifier("parquet.`/x/y.parquet`") == "parquet.`/x/y.parquet`"
