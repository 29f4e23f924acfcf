import datetime

import pytest
from pyspark.sql import types as T
from pyspark.sql import functions as F

from quayside.operators.load import append, load
from quayside.sources.dialect import CsvDialect
from quayside.sources.infer import (
    NoDataRowsError,
    create_table_ddl,
    dry_run,
    infer_csv_schema,
    infer_schema,
)
from quayside.sources import scan
from quayside.sources import records
from quayside.sources.scan import scan_csv, scan_files, scan_parquet, scan_source, settle_line_breaks


def write(path, text):
    with open(path, "w", newline="") as file:
        file.write(text)
    return path


PEOPLE = "id,name,score\n1,Ann,9.5\n2,Ben,8\n3,,7.25\n"


def test_inference(spark, folder):
    path = write(
        f"{folder}/a.csv",
        "i,big,x,flag,day,at,s\n1,9999999999,1.5,true,2024-01-02,2024-01-02 03:04:05,x\n"
        "2,1,2,false,2024-01-03,2024-01-02 03:04:05.5,1y\n",
    )
    schema = infer_csv_schema(spark, path)
    assert [(f.name, f.dataType) for f in schema] == [
        ("i", T.LongType()), ("big", T.LongType()), ("x", T.DoubleType()),
        ("flag", T.BooleanType()), ("day", T.DateType()), ("at", T.TimestampNTZType()),
        ("s", T.StringType()),
    ]
    row = scan_csv(spark, path).where("i = 2").first()
    assert row.at == datetime.datetime(2024, 1, 2, 3, 4, 5, 500000)


def test_null_token_does_not_change_the_type(spark, folder):
    path = write(f"{folder}/n.csv", "id,name\n1,x\nNA,y\n3,NA\n")
    frame = scan_csv(spark, path, CsvDialect(null_value="NA"))
    assert frame.dtypes == [("id", "bigint"), ("name", "string")]
    assert [tuple(r) for r in frame.collect()] == [(1, "x"), (None, "y"), (3, None)]


@pytest.mark.parametrize(
    "text, dialect, rows",
    [
        ("id\tname\n1\ta,b\n", CsvDialect("\t"), [(1, "a,b")]),
        ("id,name\n1,'a,b'\n2,'c''d'\n", CsvDialect(quote="'"), [(1, "a,b"), (2, "c'd")]),
        ('id,v\n1,"a\\"b"\n', CsvDialect(escape="\\"), [(1, 'a"b')]),
        ('id,v\n1,"a""b"\n2,"x\ny"\n', CsvDialect(), [(1, 'a"b'), (2, "x\ny")]),
        ("1, a \n2,b\n", CsvDialect(header=False), [(1, " a "), (2, "b")]),
    ],
)
def test_dialects(spark, folder, text, dialect, rows):
    frame = scan_csv(spark, write(f"{folder}/d.csv", text), dialect)
    assert sorted(tuple(r) for r in frame.collect()) == rows
    if not dialect.header:
        assert frame.columns == ["col_1", "col_2"]


@pytest.mark.parametrize("arguments", [
    {"delimiter": ",,"}, {"quote": ""}, {"escape": "ab"}, {"delimiter": '"'},
])
def test_bad_dialects(arguments):
    with pytest.raises(ValueError):
        CsvDialect(**arguments)


def test_header_only_is_an_error(spark, folder, table):
    path = write(f"{folder}/e.csv", "id,name\n")
    for call in (
        lambda: infer_schema(spark, path),
        lambda: dry_run(spark, path, "t"),
        lambda: load(spark, path, table),
    ):
        with pytest.raises(NoDataRowsError, match="no data rows"):
            call()
    assert not spark.catalog.tableExists(table)


def test_missing_file_is_named(spark, folder):
    for name in ("gone.csv", "gone.parquet"):
        with pytest.raises(FileNotFoundError, match=name):
            scan_files(spark, f"{folder}/{name}")


def test_ragged_rows_fail(spark, folder):
    path = write(f"{folder}/r.csv", "a,b\n1,2\n3\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, path, schema=T.StructType.fromDDL("a int, b int")).collect()


def test_headers_in_other_order(spark, folder):
    write(f"{folder}/a.csv", "id,name\n1,x\n")
    write(f"{folder}/b.csv", "name,id\ny,2\n")
    schema = T.StructType.fromDDL("id bigint, name string")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, f"{folder}/*.csv", schema=schema).collect()
    for given in (None, schema):
        frame = scan_csv(spark, f"{folder}/*.csv", schema=given, align_headers=True)
        assert sorted((r.id, r.name) for r in frame.collect()) == [(1, "x"), (2, "y")]


def test_aligned_files_share_their_types(spark, folder):
    write(f"{folder}/a.csv", "id,code,n\n1,007,1\n")
    write(f"{folder}/b.csv", "code,n,id\nx1,2.5,2\n")
    write(f"{folder}/c.csv", "n,id,code\n")
    frame = scan_csv(spark, f"{folder}/*.csv", align_headers=True, lineage="file")
    assert frame.dtypes == [
        ("id", "bigint"), ("code", "string"), ("n", "double"), ("file", "string")
    ]
    assert sorted(tuple(r) for r in frame.collect()) == [
        (1, "007", 1.0, "a.csv"), (2, "x1", 2.5, "b.csv")
    ]
    schema = T.StructType.fromDDL("n string, code string, id int")
    frame = scan_csv(spark, f"{folder}/*.csv", schema=schema, align_headers=True)
    assert sorted(tuple(r) for r in frame.collect()) == [("1", "007", 1), ("2.5", "x1", 2)]


def test_aligned_load(spark, folder, table):
    write(f"{folder}/a.csv", "id,code\n1,007\n")
    write(f"{folder}/b.csv", "code,id\n008,2\n")
    spark.sql(f"CREATE TABLE {table} (ID INT, Code STRING) USING parquet")
    assert load(spark, f"{folder}/*.csv", table, align_headers=True) == 2
    assert sorted(tuple(r) for r in spark.table(table).collect()) == [(1, "007"), (2, "008")]
    spark.sql(f"DROP TABLE {table}")
    assert load(spark, f"{folder}/*.csv", table, align_headers=True) == 2
    assert sorted(tuple(r) for r in spark.table(table).collect()) == [(1, 7), (2, 8)]


def test_many_paths_and_lineage(spark, folder):
    for i in range(3):
        spark.range(i, i + 1).write.parquet(f"{folder}/p{i}.parquet")
        write(f"{folder}/c{i}.csv", f"id\n{i}\n")
    paths = [f"{folder}/p0.parquet", f"{folder}/p2.parquet"]
    assert sorted(r.id for r in scan_files(spark, paths).collect()) == [0, 2]
    assert scan_parquet(spark, f"{folder}/p*.parquet").count() == 3
    rows = scan_files(spark, [f"{folder}/c*.csv"], lineage="file").collect()
    assert sorted((r.file, r.id) for r in rows) == [(f"c{i}.csv", i) for i in range(3)]
    with pytest.raises(ValueError, match="same format"):
        scan_files(spark, [f"{folder}/p0.parquet", f"{folder}/c0.csv"])


def test_source_needs_exactly_one(spark):
    with pytest.raises(ValueError, match="together"):
        scan_source(spark, table="t", query="SELECT 1")
    with pytest.raises(ValueError, match="must be provided"):
        scan_source(spark)


@pytest.mark.parametrize(
    "line, dialect, whole",
    [
        ('{i},"a ""b"", c",x', CsvDialect(), True),
        ("{i},plain,", CsvDialect(), True),
        ('{i},"two\nlines",x', CsvDialect(), False),
        ('{i},5" pipe,x', CsvDialect(), False),
        ('{i},"a\\"b",x', CsvDialect(escape="\\"), True),
        ("{i}|'it''s|'|x", CsvDialect("|", "'"), True),
        ("{i}^'it\n''s'^x", CsvDialect("^", "'"), False),
    ],
)
def test_large_files_are_split_if_lines_are_whole(spark, folder, line, dialect, whole):
    text = "".join(line.replace("{i}", str(i)) + "\n" for i in range(2000))
    header = dialect.delimiter.join(["id", "v", "w"]) + "\n"
    path = write(f"{folder}/w.csv", header + text)
    schema = T.StructType.fromDDL("id int, v string, w string")
    small = scan_csv(spark, path, dialect, schema)
    assert settle_line_breaks(spark, [path], dialect).multi_line is not whole
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        assert settle_line_breaks(spark, [path], dialect).multi_line is not whole
        large = scan_csv(spark, path, dialect, schema)
        assert large.count() == 2000
        assert (large.rdd.getNumPartitions() > 1) is whole
        assert large.exceptAll(small).isEmpty()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_types_hold_for_all_rows(spark, folder):
    for i in range(40):
        write(f"{folder}/f{i}.csv", "id,x\n" + "".join(f"{i},{j}.5\n" for j in range(20)))
    assert infer_csv_schema(spark, f"{folder}/*.csv").simpleString() == "struct<id:bigint,x:double>"
    write(f"{folder}/f40.csv", "id,x\nnot a number,1\n")
    assert scan_csv(spark, f"{folder}/*.csv").dtypes == [("id", "string"), ("x", "double")]
    schema = T.StructType.fromDDL("id bigint, x double")
    with pytest.raises(Exception, match="(?i)malformed"):
        scan_csv(spark, f"{folder}/*.csv", schema=schema).collect()


def test_a_lone_carriage_return_reads_alike_at_any_size(spark, folder):
    path = write(f"{folder}/r.csv", "id,v\n" + "".join(f"{i},a\rb\n" for i in range(200)))
    schema = T.StructType.fromDDL("id int, v string")
    small = scan_csv(spark, path, schema=schema).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "500")
    try:
        assert scan_csv(spark, path, schema=schema).collect() == small and len(small) == 200
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("kind, value", [("INT", "1.7D"), ("INT", "3000000000L"), ("INT", "'abc'"), ("DECIMAL(4,1)", "1.25D")])
def test_append_loses_nothing(spark, table, ansi, kind, value):
    spark.sql(f"CREATE TABLE {table} (v {kind}) USING parquet")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="does not fit"):
            append(spark.sql(f"SELECT {value} AS v"), table)
        assert append(spark.sql("SELECT 2.0D AS v UNION ALL SELECT NULL"), table) == 2
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert sorted(str(r.v) for r in spark.table(table).collect())[1] == "None"


def test_dry_run_changes_nothing(spark, folder):
    path = write(f"{folder}/people.csv", PEOPLE)
    before = spark.catalog.listTables()
    columns, ddl = dry_run(spark, path, "s.people")
    assert [tuple(r) for r in columns.orderBy("ordinal").collect()] == [
        (1, "id", "BIGINT", True), (2, "name", "STRING", True), (3, "score", "DOUBLE", True)
    ]
    assert ddl == (
        "CREATE TABLE `s`.`people` (`id` BIGINT, `name` STRING, `score` DOUBLE) USING parquet"
    )
    assert spark.catalog.listTables() == before


def test_ddl_keeps_nested_names_and_case():
    schema = T.StructType.fromDDL("`Group By` struct<aB:int>, `a``b` decimal(5,2)")
    assert create_table_ddl(schema, "t") == (
        "CREATE TABLE `t` (`Group By` struct<aB:int>, `a``b` DECIMAL(5,2)) USING parquet"
    )


def test_load_creates_then_appends(spark, folder, table):
    path = write(f"{folder}/people.csv", PEOPLE)
    assert load(spark, path, table) == 3
    assert load(spark, path, table) == 3
    rows = spark.table(table).orderBy("id").collect()
    assert [tuple(r) for r in rows[::2]] == [(1, "Ann", 9.5), (2, "Ben", 8.0), (3, None, 7.25)]


def test_existing_table_keeps_its_types(spark, folder, table):
    spark.sql(f"CREATE TABLE {table} (ID DECIMAL(18,0), NAME VARCHAR(100), SCORE DOUBLE) USING parquet")
    types = spark.table(table).dtypes
    path = write(f"{folder}/people.csv", PEOPLE)
    spark.createDataFrame([(7.5, 4, "Di")], "score double, Id int, nAme string").write.parquet(
        f"{folder}/more.parquet"
    )
    assert load(spark, path, table) == 3
    assert load(spark, f"{folder}/more.parquet", table) == 1
    assert spark.table(table).dtypes == types
    assert sorted((int(r.ID), r.NAME) for r in spark.table(table).collect()) == [
        (1, "Ann"), (2, "Ben"), (3, None), (4, "Di")
    ]


def test_headerless_load_is_by_position(spark, folder, table):
    spark.sql(f"CREATE TABLE {table} (b BIGINT, a STRING) USING parquet")
    path = write(f"{folder}/h.csv", "1,2\n3,4\n")
    assert load(spark, path, table, CsvDialect(header=False)) == 2
    assert sorted(tuple(r) for r in spark.table(table).collect()) == [(1, "2"), (3, "4")]
    with pytest.raises(ValueError, match="expected"):
        load(spark, write(f"{folder}/w.csv", "1,2,3\n"), table, CsvDialect(header=False))


def test_csv_settings_do_not_touch_parquet(spark, folder, table):
    spark.range(3).write.parquet(f"{folder}/p.parquet")
    assert load(spark, f"{folder}/p.parquet", table, CsvDialect(";", header=False)) == 3


def test_columns_must_match(spark, table):
    spark.sql(f"CREATE TABLE {table} (a INT, b INT) USING parquet")
    with pytest.raises(ValueError, match="missing"):
        append(spark.sql("SELECT 1 AS a, 2 AS c"), table)


def test_reserved_words_as_columns(spark, folder, table):
    frame = spark.sql("SELECT 1 AS `timestamp`, 2 AS `select`, 3 AS `Mixed Case`")
    frame.write.parquet(f"{folder}/r.parquet")
    assert load(spark, f"{folder}/r.parquet", table) == 1
    assert spark.table(table).columns == ["timestamp", "select", "Mixed Case"]


def test_one_odd_file_leaves_the_others_split(spark, folder):
    for n in range(3):
        write(f"{folder}/a b{n}.csv", "id,v\n" + "".join(f'{n}{i},"some ""text"" of a row"\n' for i in range(100, 4000)))
    write(f"{folder}/odd.csv", "id,v\n" + "".join(f'9{i},"one\ntwo"\n' for i in range(100, 400)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        frame = scan_csv(spark, f"{folder}/*.csv", lineage="file")
        tasks = frame.select("file", F.spark_partition_id().alias("t")).distinct().groupBy("file").agg(F.count("t").alias("n")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    by_file = {r.file: r.n for r in tasks}
    assert by_file.pop("odd.csv") == 1 and len(by_file) == 3 and min(by_file.values()) > 3
    assert frame.count() == 3 * 3900 + 300 and frame.where("v = 'one\ntwo'").count() == 300
    assert frame.dtypes[:2] == [("id", "bigint"), ("v", "string")]


def test_odd_and_plain_files_share_their_types(spark, folder):
    write(f"{folder}/a.csv", "k,v\n1,2\n")
    write(f"{folder}/b.csv", 'k,v\n2.5,"x\ny"\n')
    frame = scan_csv(spark, f"{folder}/*.csv")
    assert frame.dtypes == [("k", "double"), ("v", "string")]
    assert sorted(tuple(r) for r in frame.collect()) == [(1.0, "2"), (2.5, "x\ny")]
    write(f"{folder}/c.csv", "k,other\n1,2\n")
    with pytest.raises(Exception, match="(?i)header|different columns"):
        scan_csv(spark, f"{folder}/*.csv").collect()


def test_only_the_first_block_is_read_for_a_header(spark, folder):
    for n in range(3):
        write(f"{folder}/big {n}.csv", ("id,v\n" if n else "v,id\n") + "1,abcdefghijklmnopqrstuvwxyz\n" * 300_000)
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics

    def read():
        """By the JVM, from anywhere; what tasks open by themselves ends with the first block."""
        return sum(s.getBytesRead() for s in statistics() if s.getScheme() == "file")

    before = read()
    groups = scan._files_by_header(spark, [f"{folder}/*.csv"])
    assert sorted(map(len, groups)) == [1, 2] and all(" " in path for files in groups for path in files)
    assert read() - before < 4_000_000


def test_empty_files_have_no_first_line(spark, folder):
    write(f"{folder}/a.csv", "")
    write(f"{folder}/b.csv", "id,v\n1,2\n")
    assert [tuple(r) for r in scan.first_lines(spark, [f"{folder}/*.csv"]).select(scan._RECORD).collect()] == [("id,v",)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("header, multi_line", [(True, None), (False, True)])
def test_large_files_with_line_breaks_are_read_by_many_tasks(spark, folder, monkeypatch, end, header, multi_line):
    def quoted(text):
        return '"' + text.replace('"', '""') + '"'

    values = ["plain", "", quoted("two\nlines"), quoted('a "q"\n\n"b"'), quoted(""), quoted('"'), quoted("x,\r\ny"), quoted("é\r" * 900), " "]
    lines = [f"{n},{values[n % len(values)]},{n % 7}.5" + end * (1 + (n % 5 == 0)) for n in range(3000)]
    lines.insert(1500, "id,v,w" + end if not header else "")
    text = ("id,v,w" + end if header else "") + "".join(lines)
    path = f"{folder}/big ü.csv"
    with open(path, "w", newline="", encoding="utf-8") as file:
        file.write(text.rstrip() if multi_line else text)
    dialect = CsvDialect(header=header, multi_line=multi_line)
    whole = scan_csv(spark, path, dialect, lineage="file")
    kept = whole.schema, sorted(map(repr, whole.collect()))
    monkeypatch.setattr(records, "WHOLE_BYTES", 1000)
    monkeypatch.setattr(records, "RANGE_BYTES", 1777)
    read = scan_csv(spark, path, dialect, lineage="file")
    assert (read.schema, sorted(map(repr, read.collect()))) == kept
    assert whole.rdd.getNumPartitions() == 1 < 10 < read.rdd.getNumPartitions()
    with pytest.raises(Exception, match="(?i)header|malformed"):
        scan_csv(spark, path, dialect, T.StructType.fromDDL("id int, v string")).collect()


def test_doubtful_quotes_leave_a_large_file_to_one_task(spark, folder, monkeypatch):
    sound = 'id,v\n1,"a\nb"\n'
    for n, odd in enumerate(['2,5" pipe\n', '2,"a" b\n', '2,"open\n', "2,x\r\n", "2,x\ry\n"]):
        path = f"{folder}/{n}.csv"
        with open(path, "w", newline="") as file:
            file.write(sound * 50 + odd)
        monkeypatch.setattr(records, "WHOLE_BYTES", 10)
        monkeypatch.setattr(records, "RANGE_BYTES", 40)
        size = len(sound * 50 + odd)
        assert records.cut_by_records(spark, {f"file://{path}": size}, CsvDialect()).ranges == [], odd
    assert len(records.cut_by_records(spark, {f"file://{path}": len(sound) * 50}, CsvDialect()).ranges) == -(-len(sound) * 50 // 40)
