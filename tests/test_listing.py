import os

import pytest
from pyspark.sql import functions as F

from quayside.sources import listing
from quayside.sources.listing import (
    extract_blobs,
    ingest_blobs,
    list_children,
    list_files,
    list_recursive,
    scan_blobs,
    target_path,
)

PATHS = ["a/x.txt", "a/b/y.txt", "a/b/z.txt", "ab/w.txt", "top.txt", "a"]


@pytest.fixture(scope="module")
def paths(spark):
    return spark.createDataFrame([(p,) for p in PATHS], "path string")


@pytest.mark.parametrize("prefix", ["", "a", "a/", "a/b", "a/b//", "top", "a/x.tx"])
def test_listing_model(paths, prefix):
    lead = prefix.rstrip("/")
    below = [p[len(lead):].removeprefix("/") for p in PATHS if p.startswith(lead) and len(p) > len(lead)]
    below = PATHS if not lead else below
    assert sorted(r.name for r in list_recursive(paths, prefix).collect()) == sorted(below)
    children = {p.split("/")[0] for p in below}
    assert sorted(r.name for r in list_children(paths, prefix).collect()) == sorted(children)


def test_unknown_prefix(paths):
    for call in (list_recursive, list_children):
        with pytest.raises(FileNotFoundError, match="nope"):
            call(paths, "nope/")
    assert list_children(paths.limit(0)).collect() == []


@pytest.fixture
def tree(folder):
    for name in ("m/one.bin", "m/deep/two.bin", "three.bin"):
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "wb") as file:
            file.write(name.encode() * 3 + b"\x00\xff")
    return folder


def test_list_files(spark, tree):
    assert sorted(r.name for r in list_files(spark, tree).collect()) == ["m", "three.bin"]
    found = sorted(r.name for r in list_files(spark, f"file:{tree}/", "m", True).collect())
    assert found == ["deep/two.bin", "one.bin"]


def test_listing_does_not_read_content(spark, tree):
    plan = scan_blobs(spark, tree).select("path")._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_round_trip(spark, tree, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("out"))
    table = ingest_blobs(spark, tree, "drivers/", f"{out}/contents")
    assert sorted(r.target for r in table.collect()) == [
        "drivers/one.bin", "drivers/three.bin", "drivers/two.bin"
    ]
    for _ in range(2):  # overwrites what is there
        assert extract_blobs(table, f"{out}/files") == (3, sum(
            os.path.getsize(f"{tree}/{n}") for n in ("m/one.bin", "m/deep/two.bin", "three.bin")
        ))
    assert extract_blobs(table, f"{out}/part", "drivers/t")[0] == 2
    assert sorted(os.listdir(f"{out}/part")) == ["hree.bin", "wo.bin"]
    with open(f"{out}/files/drivers/two.bin", "rb") as a, open(f"{tree}/m/deep/two.bin", "rb") as b:
        assert a.read() == b.read()
    assert sorted(os.listdir(f"{out}/files/drivers")) == ["one.bin", "three.bin", "two.bin"]


def test_targets(spark):
    row = spark.sql("SELECT 'x/y/f.jar' AS p").select(
        target_path(F.col("p"), "lib/").alias("a"), target_path(F.col("p"), "lib/g.jar").alias("b")
    ).first()
    assert tuple(row) == ("lib/f.jar", "lib/g.jar")


def test_bad_arguments(spark, tree, folder):
    with pytest.raises(ValueError, match="end with"):
        ingest_blobs(spark, tree, "one-name", f"{folder}/c")
    with pytest.raises(FileNotFoundError):
        scan_blobs(spark, f"{folder}/gone")
    bad = spark.createDataFrame([("../up.txt", bytearray(b"x"))], "target string, content binary")
    with pytest.raises(Exception, match="outside the directory"):
        extract_blobs(bad, folder)


def test_one_file_to_a_path_or_into_a_directory(spark, folder):
    blobs = spark.createDataFrame([("raw/a/x.txt", bytearray(b"one")), ("raw/a/y", bytearray(b""))], "target string, content binary")
    os.makedirs(f"{folder}/there")
    assert listing.extract_blob(blobs, "raw/a/x.txt", f"{folder}/there") == f"{folder}/there/x.txt"
    assert listing.extract_blob(blobs, "raw/a/y", f"{folder}/new/") == f"{folder}/new/y"
    assert listing.extract_blob(blobs, "raw/a/x.txt", f"{folder}/there/z") == f"{folder}/there/z"
    assert open(f"{folder}/there/x.txt").read() == open(f"{folder}/there/z").read() == "one"
    assert open(f"{folder}/new/y").read() == ""
    with pytest.raises(FileNotFoundError, match="raw/a/z"):
        listing.extract_blob(blobs, "raw/a/z", f"{folder}/there")


def test_very_many_small_files_are_read_by_few_tasks(spark, folder):
    names = [f"{n % 3}/{n}.txt" for n in range(2000)]
    blobs = spark.createDataFrame([(name, name.encode() * (n % 4 + 1)) for n, name in enumerate(names)], "target string, content binary")
    for _ in range(2):  # the second time onto the first's files
        assert listing.extract_blobs(blobs, f"{folder}/out") == (2000, sum(len(name) * (n % 4 + 1) for n, name in enumerate(names)))
    read = scan_blobs(spark, f"{folder}/out")
    own = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{folder}/out")
    assert 4 <= read.rdd.getNumPartitions() <= own.rdd.getNumPartitions() // 2
    assert read.columns == own.columns and read.exceptAll(own).isEmpty() and read.count() == 2000
    assert bytes(read.where("path LIKE '%/1/7.txt'").first().content) == b"1/7.txt" * 4
    assert scan_blobs(spark, f"{folder}/out/0").select("path").distinct().count() == 667


def _of_spark(spark, *roots):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(roots))


def test_the_driver_holds_none_of_the_files(spark, folder):
    names = [f"{n % 3}/{n}.txt" for n in range(600)]
    for name in names:
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "w") as file:
            file.write(name)
    read = scan_blobs(spark, folder)
    assert len(read.inputFiles()) <= 4
    assert sorted(bytes(row.content).decode() for row in read.collect()) == sorted(names)


@pytest.mark.parametrize("most", [1, 4, 10_000])
def test_tasks_list_what_sparks_reader_lists(spark, folder, monkeypatch, most):
    monkeypatch.setattr(listing, "_NAMES_A_TASK", most)
    monkeypatch.setattr(listing, "_BATCH_BYTES", 10)
    odd = ["_h", ".h", "_a=1", "x._COPYING_", "_metadata", "_common_metadata.x", "_metadata=1", "a b%20ü#&+.txt", "zip.gz"]
    names = [f"{at}{name}" for at in ("", "s/", "s/_x/", "s/_x=2/", "s/.y/", "_metadata_d/", "s/d/e/e/p/", "s%41 b/") for name in odd]
    for name in names:
        os.makedirs(os.path.dirname(f"{folder}/{name}"), exist_ok=True)
        with open(f"{folder}/{name}", "w") as file:
            file.write(name)
    for name in ("empty", "s/empty"):
        open(f"{folder}/{name}", "w").close()
    open(os.fsencode(f"{folder}/s/no text ") + b"\xff", "w").close()
    os.makedirs(f"{folder}/nothing")
    os.symlink(f"{folder}/gone", f"{folder}/broken")
    os.symlink(f"{folder}/s/d", f"{folder}/link")
    roots = [
        [folder], [f"{folder}/"], [f"{folder}/s", folder, f"{folder}/s/d", f"{folder}/zip.gz", f"{folder}/s"], [f"{folder}/s/.y"],
        [f"{folder}/_h"], [f"{folder}/nothing"], [f"file:{folder}/s/../s/d//e"], [f"{folder}/zip.gz", f"{folder}/_a=1"],
    ]
    for some in roots if most == 4 else roots[:1]:
        found, own = scan_blobs(spark, some), _of_spark(spark, *some)
        assert found.schema == own.schema
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, own.collect())), some
    assert _of_spark(spark, folder).count() > 20


def test_files_are_read_as_columns_ask(spark, folder):
    for n in range(20):
        with open(f"{folder}/{n}.txt", "w") as file:
            file.write("x" * (n + 1))
    read = scan_blobs(spark, folder)
    with open(f"{folder}/20.txt", "w") as file:  # came later
        file.write("late")
    assert read.where(F.length("content") == F.col("length")).select(F.length("content"), "content", "path").count() == 20
    os.remove(f"{folder}/3.txt")
    assert read.select("path", "length").agg(F.sum("length")).first()[0] == 210
    assert read.where("length > 4").select(F.sum(F.length("content"))).first()[0] == 200
    with pytest.raises(Exception, match="3.txt"):
        read.select("content").collect()


def test_a_file_over_sparks_limit_is_an_error(spark, folder):
    with open(f"{folder}/large", "w") as file:
        file.write("12345")
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "4")
    try:
        read = scan_blobs(spark, folder)
        assert read.select("length").first().length == 5
        with pytest.raises(Exception, match="5 bytes, of at most 4"):
            read.collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")


def test_globs_and_stores_of_spark_only(spark, tree, monkeypatch):
    assert sorted(row.length for row in scan_blobs(spark, f"{tree}/m/*").collect()) == [29, 44]
    assert not listing._open_to_tasks(spark, ["viewfs://store/in"]) and not listing._open_to_tasks(spark, [f"file:{tree}", "s3a://b/c"])
    monkeypatch.setattr(listing, "_open_to_tasks", lambda *_: False)
    assert scan_blobs(spark, tree).count() == 3
