import os
import random

import pytest
from pyspark.sql import functions as F

from quayside.operators import dml
from quayside.operators.dml import AmbiguousMergeError, MergeClause, delete, merge, update
from quayside.operators.dml_sql import run_dml


@pytest.fixture
def filled(spark, table):
    spark.sql(f"CREATE TABLE {table} (k INT, v STRING, n INT) USING parquet")
    spark.sql(f"INSERT INTO {table} VALUES (1,'a',10),(2,NULL,20),(3,'c',NULL),(4,'d',40)")
    return table


def content(spark, table):
    return sorted((tuple(r) for r in spark.table(table).collect()), key=str)


def test_update(spark, filled):
    done = update(spark, filled, {"V": "concat(v, '!')", "n": "k"}, "n > 10")
    assert done.rows == 2
    assert content(spark, filled) == [(1, "a", 10), (2, None, 2), (3, "c", None), (4, "d!", 4)]
    assert done.previous_location
    done.drop_previous(spark)
    assert len(content(spark, filled)) == 4
    assert update(spark, filled, {"n": "0"}).rows == 4


def test_update_of_nothing_writes_nothing(spark, filled):
    done = update(spark, filled, {"n": "0"}, "k > 100")
    assert (done.rows, done.previous_location) == (0, None)
    with pytest.raises(ValueError, match="unknown"):
        update(spark, filled, {"zz": "0"})


def test_delete_keeps_rows_whose_condition_is_null(spark, filled):
    assert delete(spark, filled, "n >= 20").rows == 2
    assert content(spark, filled) == [(1, "a", 10), (3, "c", None)]
    assert delete(spark, filled).rows == 2
    assert content(spark, filled) == []


def test_merge(spark, filled):
    source = spark.createDataFrame([(2, "two"), (4, "four"), (9, "nine"), (None, "none")], "id int, w string")
    done = merge(
        spark, filled, source, {"k": "id"},
        update={"v": "s.w", "n": "t.n + 1"}, delete_matched=True, delete_when="t.n = 40",
        insert={"k": "s.id", "v": "s.w"},
    )
    assert done.rows == 4
    assert content(spark, filled) == sorted(
        [(1, "a", 10), (2, "two", 21), (3, "c", None), (9, "nine", None), (None, "none", None)],
        key=str,
    )


def test_ambiguous_merge_changes_nothing(spark, filled):
    before = content(spark, filled)
    twice = spark.createDataFrame([(1, "x"), (1, "y"), (7, "p"), (7, "q")], "k int, w string")
    with pytest.raises(AmbiguousMergeError):
        merge(spark, filled, twice, ["k"], update={"v": "s.w"})
    assert content(spark, filled) == before
    # Repeated keys that match nothing are no conflict.
    done = merge(spark, filled, twice.where("k = 7"), ["k"], insert={"k": "s.k", "v": "s.w"})
    assert done.rows == 2


def test_merge_with_empty_sides(spark, filled):
    nothing = spark.createDataFrame([], "k int, v string, n int")
    copy = {"k": "s.k", "v": "s.v", "n": "s.n"}
    assert merge(spark, filled, nothing, ["k"], update=copy, insert=copy).rows == 0
    assert merge(spark, filled, spark.table(filled).limit(0), ["k"], update=copy).rows == 0
    assert len(content(spark, filled)) == 4
    assert delete(spark, filled).rows == 4
    assert merge(spark, filled, nothing, ["k"], update=copy, insert=copy).rows == 0
    some = spark.createDataFrame([(1, "a", 2)], "k int, v string, n int")
    assert merge(spark, filled, some, ["k"], update=copy, insert=copy).rows == 1
    assert content(spark, filled) == [(1, "a", 2)]


def test_merge_against_a_model(spark, table):
    pick = random.Random(3)
    old = [(i, pick.randrange(100)) for i in range(400)] + [(7, i) for i in range(300)]
    new = {k: pick.randrange(100) for k in pick.sample(range(600), 250)}
    spark.sql(f"CREATE TABLE {table} (k INT, v INT) USING parquet")
    spark.createDataFrame(old, "k int, v int").write.insertInto(table)
    source = spark.createDataFrame(list(new.items()), "k int, v int")
    done = merge(
        spark, table, source, ["k"], update={"v": "s.v"}, update_when="s.v > t.v",
        delete_matched=True, delete_when="s.v < 10", insert={"k": "s.k", "v": "-s.v"},
        insert_when="s.v % 2 = 0",
    )
    wanted, changed = [], 0
    for k, v in old:
        if k in new and new[k] < 10:
            changed += 1
        elif k in new and new[k] > v:
            wanted.append((k, new[k]))
            changed += 1
        else:
            wanted.append((k, v))
    added = [(k, -v) for k, v in new.items() if k not in {k for k, _ in old} and v % 2 == 0]
    assert content(spark, table) == sorted(wanted + added, key=str)
    assert done.rows == changed + len(added)


@pytest.mark.parametrize(
    "statement, rows, left",
    [
        ("UPDATE {t} SET n = n + 1, v = 'x;y' WHERE k IN (1, 3)", 2, 4),
        ("update {t} as a set a.n = a.k where a.v is null", 1, 4),
        ("/* all */ DELETE FROM {t}", 4, 0),
        ("DELETE FROM {t} a WHERE a.k > 2 -- some", 2, 2),
        ("DELETE FROM {t} WHERE k IN (SELECT id FROM range(2, 4))", 2, 2),
        ("DELETE FROM {t} WHERE v = 'd' OR EXISTS (SELECT 1 FROM range(2) r WHERE r.id = k)", 2, 2),
        ("UPDATE {t} SET n = (SELECT max(id) FROM range(9)) WHERE k = 1", 1, 4),
        ("MERGE INTO {t} USING (SELECT 1 AS k, 'z' AS v, 0 AS n) s ON {t}.k = s.k"
         " WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *", 1, 4),
        ("MERGE INTO {t} AS x USING (SELECT 8 AS q) AS y ON x.k = y.q"
         " WHEN NOT MATCHED AND y.q > 7 THEN INSERT (k) VALUES (y.q)", 1, 5),
        ("MERGE INTO {t} AS x USING {t} AS y ON x.k = y.k AND y.v = x.v"
         " WHEN MATCHED AND y.k > 3 THEN DELETE", 1, 3),
    ],
)
def test_statements(spark, filled, statement, rows, left):
    assert run_dml(spark, statement.format(t=filled)).rows == rows
    assert spark.table(filled).count() == left


def test_other_statements_are_left_alone(spark, filled):
    assert run_dml(spark, f"INSERT INTO {filled} VALUES (1, 'a', 1)") is None
    assert run_dml(spark, "SELECT 1") is None
    with pytest.raises(ValueError, match="an equality of a value of the target"):
        run_dml(spark, f"MERGE INTO {filled} t USING {filled} s ON t.k > s.k WHEN MATCHED THEN DELETE")


def stored_files(folder):
    """Name, size and time of every file that readers of a table see."""
    found = {}
    for place, _, names in os.walk(folder):
        if "/_" not in place:
            found |= {
                f"{place}/{n}": (os.path.getsize(f"{place}/{n}"), os.path.getmtime(f"{place}/{n}"))
                for n in names
                if n.startswith("part-")
            }
    return found


@pytest.fixture
def in_files(spark, folder, table):
    """Keys 0 to 499 in 50 files of ten."""
    spark.range(0, 500, 1, 50).selectExpr("id AS k", "id % 7 AS v").write.parquet(f"{folder}/t")
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{folder}/t'")
    return table


def test_only_files_that_are_hit_are_written(spark, folder, in_files):
    before = stored_files(f"{folder}/t")
    done = update(spark, in_files, {"v": "-1"}, "k = 123")
    after = stored_files(f"{folder}/t")
    gone, new = before.keys() - after.keys(), after.keys() - before.keys()
    assert (done.rows, done.files) == (1, 1) and len(gone) == len(new) == 1
    assert done.bytes_written == sum(after[f][0] for f in new) < 2 * max(size for size, _ in before.values())
    assert all(after[f] == before[f] for f in before.keys() & after.keys())
    done = delete(spark, in_files, "k BETWEEN 95 AND 104")
    assert (done.rows, done.files) == (10, 2)
    assert content(spark, in_files) == sorted(
        [(k, -1 if k == 123 else k % 7) for k in range(500) if not 95 <= k <= 104], key=str
    )
    done = merge(spark, in_files, spark.range(203, 206).selectExpr("id AS k"), ["k"], update={"v": "s.k"}, insert={"k": "s.k"})
    assert (done.rows, done.files) == (3, 1)


def test_untouched_files_are_not_read_again(spark, folder, in_files):
    rows = dml._current(spark, in_files, None)
    hit = dml._hit_files(rows, F.col("k") == 123)
    again = rows.where(F.col(dml._FILE).isin(hit))
    assert len(again.collect()) == 10
    scan = again._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    assert scan.metrics().get("numFiles").get().value() == 1


def test_a_small_source_is_broadcast(spark, folder, in_files, monkeypatch):
    """The target is the streamed side of every join."""
    plans = []
    write = dml._replace

    def look(spark, table, place, hit, rows, *rest):
        plans.append(rows._jdf.queryExecution().executedPlan().toString())
        return write(spark, table, place, hit, rows, *rest)

    monkeypatch.setattr(dml, "_replace", look)
    merge(spark, in_files, spark.range(10).selectExpr("id AS k", "-id AS v"), ["k"], update={"v": "s.v"})
    assert plans[0].count("BroadcastHashJoin") == 2 and plans[0].count("LeftOuter, BuildRight") == 2


def test_rows_written_meanwhile_are_not_lost(spark, filled, monkeypatch):
    moved = dml._move_all

    def slow(files, table, moves):
        spark.sql(f"INSERT INTO {filled} VALUES (9,'new',9)")
        moved(files, table, moves)

    monkeypatch.setattr(dml, "_move_all", slow)
    assert update(spark, filled, {"n": "0"}).rows == 4
    assert delete(spark, filled, "k = 1").rows == 1
    assert content(spark, filled) == sorted([(2, None, 0), (3, "c", 0), (4, "d", 0), (9, "new", 9), (9, "new", 9)], key=str)


@pytest.mark.parametrize("first", ["UPDATE {t} SET n = 1 WHERE k = 1", "DELETE FROM {t} WHERE k < 3", "TRUNCATE TABLE {t}"])
def test_of_two_changes_to_a_file_one_fails_and_leaves_no_trace(spark, folder, table, monkeypatch, first):
    spark.range(0, 8, 1, 1).selectExpr("id AS k", "0 AS n").write.parquet(f"{folder}/t")
    spark.sql(f"CREATE TABLE {table} USING parquet LOCATION '{folder}/t'")
    moved, statement = dml._move_all, first.format(t=table)

    def late(files, name, moves):
        monkeypatch.setattr(dml, "_move_all", moved)
        if run_dml(spark, statement) is None:
            spark.sql(statement.replace("TRUNCATE TABLE", "INSERT OVERWRITE") + " SELECT 5, 5")
        moved(files, name, moves)

    monkeypatch.setattr(dml, "_move_all", late)
    with pytest.raises(dml.ConcurrentWriteError):
        update(spark, table, {"n": "2"}, "k = 2")
    spark.catalog.refreshTable(table)
    wanted = {"U": [(k, int(k == 1)) for k in range(8)], "D": [(k, 0) for k in range(3, 8)], "T": [(5, 5)]}
    assert content(spark, table) == wanted[first[0]]


def test_merge_that_inserts_notices_rows_written_meanwhile(spark, filled, monkeypatch):
    listing, calls = dml._listing, []

    def slow(spark, place):
        if calls:
            spark.sql(f"INSERT INTO {filled} VALUES (9,'new',9)")
        calls.append(1)
        return listing(spark, place)

    monkeypatch.setattr(dml, "_listing", slow)
    with pytest.raises(dml.ConcurrentWriteError):
        merge(spark, filled, spark.sql("SELECT 9 AS k"), ["k"], insert={"k": "s.k"})
    assert content(spark, filled)[-1] == (9, "new", 9) and len(content(spark, filled)) == 5


@pytest.fixture
def partitioned(spark, folder, table):
    spark.sql(f"CREATE TABLE {table} (k INT, v STRING, p STRING, q INT) USING parquet PARTITIONED BY (p, q) LOCATION '{folder}/t'")
    rows = [(i, f"v{i}", p, q) for i, (p, q) in enumerate([("a", 1), ("a", 2), ("b c", 1), ("d=e%/", 1), (None, 3), ("é'x\\", None)] * 3)]
    spark.createDataFrame(rows, "k int, v string, p string, q int").write.insertInto(table)
    return table, rows


def test_changes_of_partitioned_tables(spark, folder, partitioned):
    table, rows = partitioned
    before = stored_files(f"{folder}/t")
    done = update(spark, table, {"v": "'new'"}, "p = 'a' AND q = 2 OR p IS NULL")
    assert done.rows == 6
    after = stored_files(f"{folder}/t")
    assert all("/p=a/q=2/" in f or "__HIVE_DEFAULT_PARTITION__/q=3" in f for f in before.keys() ^ after.keys())
    model = {k: (k, "new" if (p, q) == ("a", 2) or p is None else v, p, q) for k, v, p, q in rows}
    assert content(spark, table) == sorted(model.values(), key=str)
    # Rows that move to partitions that were not there.
    assert update(spark, table, {"q": "q + 10", "p": "concat(p, '!', chr(39))"}, "q = 1").rows == 9
    model |= {k: (k, v, f"{p}!'", 11) for k, v, p, q in model.values() if q == 1}
    assert content(spark, table) == sorted(model.values(), key=str)
    assert delete(spark, table, "p like 'é%'").rows == 3
    model = {k: r for k, r in model.items() if not (r[2] or "").startswith("é")}
    assert content(spark, table) == sorted(model.values(), key=str)
    assert spark.table(table).where("q = 11 AND p = 'd=e%/!\\''").count() == 3


def test_merge_into_partitioned_tables(spark, folder, partitioned):
    table, rows = partitioned
    before = stored_files(f"{folder}/t")
    source = spark.createDataFrame([(0, "zero", "a", 1), (2, "two", "moved", 7), (99, "more", "a", 2)], "k int, v string, p string, q int")
    done = run_dml_from(spark, source, f"MERGE INTO {table} t USING src s ON t.k = s.k AND t.q = 1 WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")
    assert done.rows == 3
    model = {r[0]: r for r in rows} | {0: (0, "zero", "a", 1), 2: (2, "two", "moved", 7), 99: (99, "more", "a", 2)}
    assert content(spark, table) == sorted(model.values(), key=str)
    gone = before.keys() - stored_files(f"{folder}/t").keys()
    assert gone and all("/p=a/q=1/" in f or "/p=b c/q=1/" in f or "/p=b%20c/q=1/" in f for f in gone)


def run_dml_from(spark, source, statement):
    source.createOrReplaceTempView("src")
    return run_dml(spark, statement)


def test_clauses_apply_in_the_order_written(spark, table):
    """Every kind of clause, several times, with a residual condition, against a model."""
    pick = random.Random(11)
    old = [(k, pick.randrange(100)) for k in range(300)]
    new = [(k, pick.randrange(100), pick.randrange(3)) for k in pick.sample(range(450), 260)]
    spark.sql(f"CREATE TABLE {table} (k INT, v INT) USING parquet")
    spark.createDataFrame(old, "k int, v int").repartition(5).write.insertInto(table)
    done = run_dml_from(
        spark,
        spark.createDataFrame(new, "id int, w int, z int"),
        f"""MERGE INTO {table} AS t USING src AS s ON t.k = s.id AND s.z < 2 AND t.v + s.w < 150
        WHEN MATCHED AND s.w > 80 THEN UPDATE SET v = s.w
        WHEN MATCHED AND t.v < 20 THEN DELETE
        WHEN MATCHED AND s.w > 40 THEN UPDATE SET t.v = t.v + 1000, k = -t.k
        WHEN MATCHED AND s.w < 10 THEN DELETE
        WHEN NOT MATCHED AND s.w > 90 THEN INSERT (k) VALUES (s.id)
        WHEN NOT MATCHED AND s.w > 50 THEN INSERT (k, v) VALUES (s.id, -s.w)
        WHEN NOT MATCHED BY SOURCE AND t.v > 95 THEN DELETE
        WHEN NOT MATCHED BY SOURCE AND t.v > 90 THEN UPDATE SET v = 0""",
    )
    wanted, changed, used = [], 0, set()
    by_key = {k: (w, z) for k, w, z in new}
    for k, v in old:
        w, z = by_key.get(k, (None, None))
        if w is not None and z < 2 and v + w < 150:
            used.add(k)
            row = (k, w) if w > 80 else None if v < 20 else (-k, v + 1000) if w > 40 else None if w < 10 else "same"
        else:
            row = None if v > 95 else (k, 0) if v > 90 else "same"
        changed += row != "same"
        wanted += [] if row is None else [(k, v)] if row == "same" else [row]
    added = [(k, None if w > 90 else -w) for k, w, _ in new if k not in used and w > 50]
    assert content(spark, table) == sorted(wanted + added, key=str)
    assert done.rows == changed + len(added)


def test_matches_by_a_condition_alone_may_repeat(spark, filled):
    twice = spark.createDataFrame([(1, 0), (1, 1)], "k int, z int")
    # Without a clause for matched rows it does not matter how often they match.
    done = merge(
        spark, filled, twice, "t.k = s.k", not_matched_by_source=[MergeClause("update", "t.k > 2", {"v": "'alone'"})]
    )
    assert done.rows == 2 and len(content(spark, filled)) == 4
    with pytest.raises(AmbiguousMergeError):
        merge(spark, filled, twice, "t.k = s.k", matched=[MergeClause("delete")])
    done = merge(spark, filled, twice, "t.k = s.k AND s.z = 1", matched=[MergeClause("delete")])
    assert done.rows == 1


def test_the_source_of_a_merge_is_evaluated_once(spark, filled):
    seen = spark.sparkContext.accumulator(0)

    def count(k):
        seen.add(1)
        return k

    counted = F.udf(count, "int").asNondeterministic()
    source = spark.range(0, 6, 1, 2).select(counted(F.col("id").cast("int")).alias("k"))
    assert merge(spark, filled, source, ["k"], update={"n": "0"}, insert={"k": "s.k"}).rows == 6
    assert seen.value == 6


@pytest.mark.parametrize("value", ["1.7", "'x'", "3000000000", "CAST('NaN' AS DOUBLE)"])
def test_values_that_do_not_fit_are_errors(spark, filled, value):
    before = content(spark, filled)
    changes = [
        lambda: update(spark, filled, {"n": value}, "k = 1"),
        lambda: merge(spark, filled, spark.sql("SELECT 1 AS k"), ["k"], update={"n": value}),
        lambda: merge(spark, filled, spark.sql("SELECT 77 AS k"), ["k"], insert={"n": value}),
    ]
    for change in changes:
        with pytest.raises(Exception, match="does not fit column type int"):
            change()
    assert content(spark, filled) == before
    assert update(spark, filled, {"n": "'5'"}, "k = 1").rows == update(spark, filled, {"n": "6.0"}, "k = 2").rows == 1


def test_insert_only_merge_takes_repeated_keys(spark, filled):
    source = spark.sql("SELECT * FROM VALUES (1,'x',1),(1,'y',2),(7,'z',3) AS s(k, v, n)")
    assert merge(spark, filled, source, ["k"], insert={"k": "s.k", "v": "s.v", "n": "s.n"}).rows == 1
    assert (7, "z", 3) in content(spark, filled) and len(content(spark, filled)) == 5


def test_the_table_stays_where_it_is(spark, folder, table):
    spark.sql(f"CREATE TABLE {table} (k INT) USING parquet LOCATION '{folder}/a b/t%41'")
    spark.sql(f"INSERT INTO {table} VALUES (1)")
    kept = [update(spark, table, {"k": "k + 1"}) for _ in range(3)]
    assert [r.k for r in spark.table(table).collect()] == [4]
    assert len(stored_files(f"{folder}/a b/t%41")) == 1
    for done in kept:
        done.drop_previous(spark)
    assert [n for n in os.listdir(f"{folder}/a b/t%41") if n.startswith("_replaced") or n.startswith("_change")] == []
