"""Split exports against a brute-force cut of the same rows."""

import datetime
import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from quayside.operators import export as export_module
from quayside.operators import numbering
from quayside.operators.export import export
from quayside.operators.split import SplitLimits, csv_header_bytes, csv_line_bytes
from quayside.sources.dialect import CsvDialect
from quayside.sources.scan import scan_csv, scan_parquet
from quayside.storage import HadoopFiles


def letters(spark, count, seed=7, longest=60):
    """(id, text) rows with text of very uneven length and no special characters."""
    pick = random.Random(seed)
    rows = [(i, "x" * pick.choice([1, 2, 5, longest])) for i in range(count)]
    return rows, spark.createDataFrame(rows, "id long, text string")


def cut(lines, max_rows, max_bytes, header):
    """Brute force, one row after the other: a full file ends before the next row, whose file counts anew."""
    files, held = [], 0
    for line in lines:
        full = files and (
            (max_rows is not None and len(files[-1]) >= max_rows)
            or (max_bytes is not None and held >= max_bytes)
        )
        if not files or full:
            files.append([])
            held = header
        files[-1].append(line)
        held += len(line)
    return files


def read_all(paths):
    return [open(path).read() for path in paths]


@pytest.mark.parametrize(
    "max_rows, max_bytes",
    [
        (3, None), (1, None), (7, None), (100, None), (None, 200), (None, 75), (None, 9),
        (None, 9000), (5, 200), (2, 90), (1, 20), (39, 500),
    ],
)
def test_csv_files_equal_brute_force(spark, folder, max_rows, max_bytes):
    rows, frame = letters(spark, 40)
    frame.repartition(5, "text").createOrReplaceTempView("uneven")
    result = export(
        spark, f"{folder}/u.csv", "csv", query="SELECT * FROM uneven",
        max_rows_per_file=max_rows, max_file_size=max_bytes, order_by=["id"],
    )
    lines = [f"{i},{text}\n" for i, text in rows]
    wanted = cut(lines, max_rows, max_bytes, len("id,text\n"))
    assert read_all(result.paths) == ["id,text\n" + "".join(part) for part in wanted]
    assert result.rows == 40
    names = [os.path.basename(path) for path in result.paths]
    many = [f"u_{i:03d}.csv" for i in range(len(wanted))]
    assert names == (many if len(wanted) > 1 else ["u.csv"])
    assert [file.bytes for file in result.files] == [os.path.getsize(p) for p in result.paths]
    assert [file.rows for file in result.files] == [len(part) for part in wanted]


@pytest.mark.parametrize("together", [2, 8])
@pytest.mark.parametrize("max_rows, room", [(None, 1), (None, 13), (None, 100), (None, 5000), (None, 10**6), (4, 30), (3, 7), (60, 900)])
def test_files_are_followed_through_many_parts(spark, folder, monkeypatch, together, max_rows, room):
    """Parts of every size, files within a part and over many, against one row after the other."""
    from quayside.operators import chain

    monkeypatch.setattr(chain, "STRETCHES", together)
    pick = random.Random(room)
    sizes = [pick.choice([1, 1, 2, 3, 8, 40, 300]) for _ in range(700)]
    bounds = sorted(pick.sample(range(1, 700), 20))
    rows, before = [], 0
    for number, size in enumerate(sizes):
        rows.append((3 * sum(b <= number for b in bounds), number, before))
        before += size
    columns = f"{numbering.PART} int, {numbering.NUMBER} long, {numbering.BEFORE} long"
    frame = spark.createDataFrame(rows, columns).repartition(4)
    found = chain.file_starts(frame, chain.FileLimit(room, max_rows), folder)
    wanted = cut(["x" * size for size in sizes], max_rows, room, 0)
    starts = [0]
    for file in wanted[:-1]:
        starts.append(starts[-1] + len(file))
    assert [tuple(r) for r in found.starts.orderBy("file_id").collect()] == list(enumerate(starts))


def test_row_limit_alone_decides_when_bytes_never_fill(spark, folder):
    _, frame = letters(spark, 40, longest=5)
    frame.createOrReplaceTempView("short")
    result = export(
        spark, f"{folder}/s.csv", "csv", query="SELECT * FROM short",
        max_rows_per_file=15, max_file_size="1KB", order_by=["id"],
    )
    assert [text.count("\n") - 1 for text in read_all(result.paths)] == [15, 15, 10]


def test_ten_rows_by_three(spark, folder):
    spark.range(10).write.parquet(f"{folder}/in.parquet")
    result = export(
        spark, f"{folder}/ten.parquet", "parquet",
        table=f"parquet.`{folder}/in.parquet`", max_rows_per_file=3,
    )
    counts = [spark.read.parquet(path).count() for path in result.paths]
    assert counts == [3, 3, 3, 1]
    assert not glob.glob(f"{folder}/.ten.parquet.*"), "staging is removed"


def test_stored_rows_keep_their_order(spark, folder):
    spark.range(0, 1000, 1, 7).write.parquet(f"{folder}/in.parquet")
    result = export(
        spark, f"{folder}/o.csv", "csv",
        table=f"parquet.`{folder}/in.parquet`", max_rows_per_file=130,
    )
    found = [int(x) for text in read_all(result.paths) for x in text.split()[1:]]
    assert found == list(range(1000))


def test_table_and_view_sources(spark, folder, table):
    spark.range(20).write.option("path", f"{folder}/t").saveAsTable(table)
    spark.sql(f"CREATE OR REPLACE TEMP VIEW odd AS SELECT * FROM {table} WHERE id % 2 = 1")
    for source, rows in ((table, 20), ("odd", 10)):
        result = export(
            spark, f"{folder}/{source}.parquet", "parquet", table=source, max_rows_per_file=6
        )
        back = scan_parquet(spark, result.paths)
        assert result.rows == back.count() == rows
        assert back.distinct().count() == rows


def test_one_hot_order_key_spreads_over_tasks(spark, folder):
    """Equal order keys must not end up in one task: the file position breaks ties."""
    frame = spark.range(0, 8000, 1, 4).select(F.lit(1).alias("hot"), "id")
    frame.write.parquet(f"{folder}/hot")
    positioned = numbering.position_rows(
        spark.read.parquet(f"{folder}/hot"), True, f"{folder}/scratch", ["hot"]
    )
    sizes = [r["count"] for r in positioned.frame.groupBy(numbering.PART).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 4000


def test_numbers_are_dense_and_repeatable(spark, folder):
    frame = spark.range(0, 5000, 1, 9).withColumn("k", F.col("id") % 13)
    frame.write.parquet(f"{folder}/in")
    scan = spark.read.parquet(f"{folder}/in")
    positioned = numbering.position_rows(
        scan, True, f"{folder}/scratch", [F.desc("k")], F.lit(3)
    )
    numbered = numbering.number_rows(positioned, f"{folder}/offsets")
    assert (numbered.rows, numbered.weight) == (5000, 15000)
    for _ in range(2):
        rows = numbered.frame.orderBy(numbering.NUMBER).collect()
        assert [r[numbering.NUMBER] for r in rows] == list(range(5000))
        assert [r[numbering.BEFORE] for r in rows] == [3 * i for i in range(5000)]
        assert [r.k for r in rows] == sorted((r.k for r in rows), reverse=True)


@pytest.mark.parametrize("in_files", [True, False])
def test_offsets_of_many_files_are_summed_in_groups(spark, folder, monkeypatch, in_files):
    monkeypatch.setattr(numbering, "GROUP_FILES", 3)
    spark.range(0, 300, 1, 11).write.parquet(f"{folder}/in")
    scan = spark.read.parquet(f"{folder}/in")
    positioned = numbering.position_rows(scan, in_files, f"{folder}/scratch", ["id"] if not in_files else ())
    numbered = numbering.number_rows(positioned, f"{folder}/offsets")
    rows = numbered.frame.orderBy(numbering.NUMBER).collect()
    assert [r[numbering.NUMBER] for r in rows] == list(range(300)) == [r.id for r in rows]


def test_lookup_joins_work_without_broadcast(spark, folder, monkeypatch):
    monkeypatch.setattr(numbering, "BROADCAST_BYTES", 0)
    rows, frame = letters(spark, 50)
    frame.createOrReplaceTempView("uneven")
    result = export(
        spark, f"{folder}/u.csv", "csv", query="SELECT * FROM uneven",
        max_file_size=150, max_rows_per_file=4, order_by=["id"],
    )
    text = "".join(part.partition("\n")[2] for part in read_all(result.paths))
    assert text == "".join(f"{i},{t}\n" for i, t in rows)


def test_line_bytes_equal_the_written_bytes(spark, folder):
    rows = [
        (1, "plain", 1.5, True, datetime.date(2020, 1, 2), datetime.datetime(2020, 1, 2, 3, 4, 5, 6)),
        (2, 'quo"te, and\nbreak', 1e300, False, None, None),
        (3, "", -0.1, None, datetime.date(1, 1, 1), datetime.datetime(1999, 12, 31)),
        (None, None, None, None, None, None),
        (5, "  spaced  ", float("nan"), True, None, None),
        (6, "größe 漢字 \t tab", float("inf"), True, None, None),
    ]
    schema = "a int, b string, c double, d boolean, e date, f timestamp_ntz"
    wide = spark.createDataFrame(rows, schema)
    for plain in (wide, wide.select("a"), wide.select("b"), wide.select("f")):
        for dialect in (CsvDialect(), CsvDialect("\t", "'", "\\", False, "NULL")):
            path = f"{folder}/{random.random()}"
            frame = plain.select(*dialect.line_columns(plain.schema))
            frame.coalesce(1).write.options(**dialect.write_options()).csv(path)
            written = HadoopFiles(spark).glob(f"{path}/part-*")[0][1]
            lines = plain.select(F.sum(csv_line_bytes(plain.schema, dialect))).first()[0]
            assert csv_header_bytes(spark, frame.schema, dialect) + lines == written


def test_line_breaks_inside_fields_do_not_cut_rows(spark, folder):
    rows = [(i, f"a\nb{i}\r\n\"c\"") for i in range(11)]
    spark.createDataFrame(rows, "id int, text string").createOrReplaceTempView("broken")
    result = export(
        spark, f"{folder}/b.csv", "csv", query="SELECT * FROM broken", max_rows_per_file=4
    )
    assert result.num_files == 3
    back = scan_csv(spark, result.paths, schema=spark.table("broken").schema)
    assert sorted(tuple(r) for r in back.collect()) == rows


@pytest.mark.parametrize("format", ["csv", "parquet"])
def test_empty_split_leaves_one_file_with_the_columns(spark, folder, format):
    query = "SELECT 1 AS a, 'x' AS b WHERE false"
    result = export(spark, f"{folder}/e.{format}", format, query=query, max_rows_per_file=5)
    assert (result.rows, result.num_files) == (0, 1)
    assert os.path.isfile(f"{folder}/e.{format}")
    if format == "csv":
        assert open(f"{folder}/e.csv").read() == "a,b\n"
    else:
        back = spark.read.parquet(f"{folder}/e.parquet")
        assert back.dtypes == [("a", "int"), ("b", "string")] and back.count() == 0


def test_parquet_size_limit_alone_splits(spark, folder):
    frame = spark.range(60000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("hash"))
    frame.write.parquet(f"{folder}/in")
    result = export(
        spark, f"{folder}/p.parquet", "parquet",
        table=f"parquet.`{folder}/in`", max_file_size="500KB",
    )
    sizes = [file.bytes for file in result.files]
    assert result.num_files > 3 and max(sizes) <= 500_000
    assert scan_parquet(spark, result.paths).distinct().count() == 60000


@pytest.mark.parametrize("as_directory", [False, True])
def test_files_over_a_parquet_limit_are_cut_again(spark, folder, monkeypatch, as_directory):
    """Planned far too large, so that nearly every file has to be cut, some of them twice."""
    from quayside.operators import export as module

    monkeypatch.setattr(module, "PARQUET_FILL", 6.0)
    many = F.concat(*(F.sha2(F.concat_ws("-", "id", F.lit(n)), 256) for n in range(30)))
    text = F.when(F.col("id") % 100 < 5, many).otherwise(F.lit("x"))
    spark.range(0, 4000, 1, 3).select("id", text.alias("v")).write.parquet(f"{folder}/in")
    result = export(
        spark, f"{folder}/p.parquet", "parquet", table=f"parquet.`{folder}/in`", max_file_size="40KB",
        order_by=["id"], as_directory=as_directory,
    )
    assert result.num_files > 10 and max(f.bytes for f in result.files) <= 40_000
    found = []
    for file in result.files:
        ids = [r.id for r in spark.read.parquet(file.path).collect()]
        assert len(ids) == file.rows
        found += ids
    assert found == list(range(4000))
    if not as_directory:
        assert [os.path.basename(p) for p in result.paths] == [f"p_{i:03d}.parquet" for i in range(result.num_files)]


def test_a_row_over_a_parquet_limit_stays_whole(spark, folder):
    rows = [(i, ("%032x" % random.Random(i).getrandbits(128)) * (2000 if i == 5 else 1)) for i in range(12)]
    spark.createDataFrame(rows, "i int, v string").coalesce(1).write.parquet(f"{folder}/in")
    result = export(spark, f"{folder}/p.parquet", "parquet", table=f"parquet.`{folder}/in`", max_file_size=2500, order_by=["i"])
    back = scan_parquet(spark, result.paths)
    assert sorted(tuple(r) for r in back.collect()) == rows
    assert [f.rows for f in result.files if f.bytes > 2500] in ([], [1])


def test_many_small_files_share_tasks(spark, folder):
    spark.range(500).createOrReplaceTempView("small")
    result = export(
        spark, f"{folder}/s.csv", "csv", query="SELECT * FROM small", max_rows_per_file=1,
        order_by=["id"], dialect=CsvDialect(header=False),
    )
    assert result.num_files == 500
    assert read_all(result.paths) == [f"{i}\n" for i in range(500)]


@pytest.mark.parametrize("by", ["tasks", "driver"])
@pytest.mark.parametrize("limits", [{"max_rows_per_file": 1}, {"max_file_size": 5}, {"max_rows_per_file": 2, "max_file_size": 9}])
def test_files_are_named_by_tasks_or_the_driver(spark, folder, monkeypatch, by, limits):
    from quayside.operators import export as module

    monkeypatch.setattr(module, "_FILES_A_TASK", 40)
    if by == "driver":
        def unknown(spark, path):
            raise ValueError("no such store")

        monkeypatch.setattr(module, "address_for_tasks", unknown)
    else:
        # Nothing about single files passes through the driver.
        monkeypatch.setattr(module, "_numbered_files", None)
        monkeypatch.setattr(HadoopFiles, "walk", None)
        monkeypatch.setattr(HadoopFiles, "replace_all", None)
    spark.range(700).createOrReplaceTempView("small")
    with open(f"{folder}/s_003.csv", "w") as file:
        file.write("from before")
    result = export(
        spark, f"{folder}/s.csv", "csv", query="SELECT * FROM small", order_by=["id"], dialect=CsvDialect(header=False), **limits
    )
    rows = result.manifest(spark).orderBy("file_id").collect()
    assert [r.file_id for r in rows] == list(range(result.num_files)) and result.num_files >= 340
    assert [r.file_name for r in rows] == [f"s_{k:03d}.csv" for k in range(result.num_files)]
    lines = [open(r.path).read() for r in rows]
    assert "".join(lines) == "".join(f"{i}\n" for i in range(700))
    assert [(r.rows, r.bytes) for r in rows] == [(text.count("\n"), len(text)) for text in lines]
    assert sorted(n for n in os.listdir(folder) if not n.endswith(".crc")) == sorted(r.file_name for r in rows)
    result.drop_manifest(spark)


def test_an_output_that_is_a_directory_is_an_error(spark, folder):
    os.makedirs(f"{folder}/d_001.csv")
    with pytest.raises(Exception, match="output path is a directory"):
        export(spark, f"{folder}/d.csv", "csv", query="SELECT * FROM range(5)", max_rows_per_file=2)


def test_failed_exports_leave_nothing_behind(spark, folder):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(f"{shared}/quayside"))
    query = "SELECT id, raise_error('stop') AS e FROM range(9)"
    with pytest.raises(Exception, match="stop"):
        export(spark, f"{folder}/f.csv", "csv", query=query, max_rows_per_file=2)
    assert os.listdir(folder) == [] and set(os.listdir(f"{shared}/quayside")) == before


def test_keep_as_directory(spark, folder):
    spark.range(10).createOrReplaceTempView("small")
    result = export(
        spark, f"{folder}/d.csv", "csv", query="SELECT * FROM small", max_rows_per_file=4,
        order_by=["id"], as_directory=True,
    )
    assert [text.split()[1:] for text in read_all(
        path.removeprefix("file:") for path in result.paths
    )] == [["0", "1", "2", "3"], ["4", "5", "6", "7"], ["8", "9"]]


def test_upper_bound_mode(spark, folder):
    spark.range(0, 100, 1, 3).createOrReplaceTempView("small")
    result = export(
        spark, f"{folder}/b.parquet", "parquet", query="SELECT * FROM small",
        max_rows_per_file=10, exact=False,
    )
    counts = [spark.read.parquet(path).count() for path in result.paths]
    assert sum(counts) == 100 == result.rows and max(counts) <= 10
    with pytest.raises(ValueError):
        export(spark, f"{folder}/c.csv", "csv", query="SELECT 1", max_file_size=10, exact=False)


@pytest.mark.parametrize("limits", [{"max_rows": 0}, {"max_bytes": 0}, {"max_rows": -1}])
def test_limits_below_one_are_rejected(limits):
    with pytest.raises(ValueError):
        SplitLimits(**limits)


def test_limit_not_above_the_header_is_rejected(spark, folder):
    with pytest.raises(ValueError, match="header"):
        export(spark, f"{folder}/x.csv", "csv", query="SELECT 1 AS abc", max_file_size=4)


def test_single_column_keeps_rows_without_a_value(spark, folder):
    rows = [(1,), (None,), (3,), (None,), (5,)]
    spark.createDataFrame(rows, "a int").coalesce(1).write.parquet(f"{folder}/in")
    result = export(
        spark, f"{folder}/a.csv", "csv",
        table=f"parquet.`{folder}/in`", max_rows_per_file=2, max_file_size=100,
    )
    assert (result.rows, result.num_files) == (5, 3)
    back = scan_csv(spark, result.paths, schema=spark.read.parquet(f"{folder}/in").schema)
    assert sorted(str(r[0]) for r in back.collect()) == sorted(str(r[0]) for r in rows)


@pytest.mark.parametrize("limits", [{"max_rows_per_file": 4}, {"max_file_size": 60}, {"max_rows_per_file": 3, "max_file_size": 60}])
@pytest.mark.parametrize("name", ["__file_id", "__FILE_ID", "__bucket", "__first_number", "__offset_rows", "__row"])
def test_no_user_column_is_lost(spark, folder, limits, name):
    export(spark, f"{folder}/c.csv", "csv", query=f"SELECT id AS {name}, id * 2 AS v FROM range(10)", **limits)
    written = scan_csv(spark, f"{folder}/c*.csv")
    assert written.columns == [name, "v"]
    assert sorted(tuple(r) for r in written.collect()) == [(i, 2 * i) for i in range(10)]


@pytest.mark.parametrize("header", [True, False])
@pytest.mark.parametrize("files", [1, 3])
def test_one_large_csv_file_is_written_by_many_tasks(spark, folder, monkeypatch, header, files):
    query = "SELECT id, concat('line ', id, if(id % 3 = 0, '\n\"q\"', '')) AS `a,\"b\"` FROM range(0, 5000, 1, 7)"
    dialect, rows = CsvDialect(header=header), -(-5000 // files)
    options = dict(query=query, dialect=dialect, max_rows_per_file=rows, order_by=[F.col("id").desc()])
    plain = export(spark, f"{folder}/plain.csv", "csv", **options)
    monkeypatch.setattr(numbering, "TASK_BYTES", 3000)
    joined, join = [], export_module._join_parts

    def seen(spark, directory, header_bytes):
        joined.append(sum(name.startswith("part-") for _, _, names in os.walk(directory) for name in names))
        join(spark, directory, header_bytes)

    monkeypatch.setattr(export_module, "_join_parts", seen)
    parts = export(spark, f"{folder}/parts.csv", "csv", **options)
    assert joined[0] >= 2 * files and parts.rows == plain.rows == 5000 and parts.num_files == files
    for one, other in zip(plain.files, parts.files, strict=True):
        with open(one.path.removeprefix("file:"), "rb") as a, open(other.path.removeprefix("file:"), "rb") as b:
            assert a.read() == b.read()
        assert (one.bytes, one.rows) == (other.bytes, other.rows)
    assert sorted(n for n in os.listdir(folder) if "parts" in n) == sorted(p.rpartition("/")[2] for p in parts.paths)
    assert spark.read.options(**dialect.read_options()).csv(parts.paths).count() == 5000
