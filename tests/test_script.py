import os

import pytest

from quayside.operators.script import EmptyScriptError, run_script


def test_statements_run_in_order(spark, table):
    result = run_script(
        spark,
        f"""-- start; here
        CREATE TABLE {table} (id INT, note STRING) USING parquet;
        INSERT INTO {table} VALUES (1, 'a;b'), (2, '--c');
        UPDATE {table} SET note = 'n' WHERE id = 2;
        SELECT * FROM {table} /* all; */;
        SHOW TABLES LIKE '{table}'; DESCRIBE {table}; EXPLAIN SELECT 1;
        ALTER TABLE {table} ADD COLUMN extra INT;
        DELETE FROM {table} WHERE id = 1;;""",
    )
    assert result.failed == 0 and result.total == 9
    assert [(o.kind, o.status, o.rows) for o in result.outcomes] == [
        ("Ddl", "ok", None), ("Dml", "affected", 2), ("Dml", "affected", 1), ("Query", "rows", 2),
        ("Query", "rows", 1), ("Query", "rows", 2), ("Query", "rows", 1), ("Ddl", "ok", None),
        ("Dml", "affected", 1),
    ]
    assert result.status_lines[1] == f"[2/9] INSERT INTO {table} VALUES (1, 'a;b'), (2, '--c') 2 rows affected"
    assert result.status_lines[3].endswith("/* all; */ 2 rows")
    assert result.summary == "9 statements executed, 0 failed"
    assert [r.n for r in result.report(spark).orderBy("n").collect()] == list(range(1, 10))


def test_stops_at_the_first_failure(spark):
    result = run_script(spark, "SELECT 1; SELECT * FROM no_such_table; SELECT 2")
    assert [o.status for o in result.outcomes] == ["rows", "failed"]
    assert result.summary == "2 statements executed, 1 failed"
    message = result.outcomes[1].message
    assert message.startswith("Error in statement 2:\n  SELECT * FROM no_such_table\n")
    assert message.endswith("Hint: Check that the table exists and the schema is correct.")


def test_syntax_errors_carry_a_hint(spark):
    result = run_script(spark, "SELEC 1")
    assert result.summary == "1 statement executed, 1 failed"
    assert "Hint: Check your SQL syntax near the marked position." in result.outcomes[0].message


@pytest.mark.parametrize("script", ["", " ;; ", "-- nothing\n/* at all */"])
def test_scripts_without_statements(spark, script):
    with pytest.raises(EmptyScriptError, match="No SQL statements to execute"):
        run_script(spark, script)


def test_results_are_kept_apart(spark, folder):
    script = "SELECT 1 AS a, NULL AS b; CREATE OR REPLACE TEMP VIEW v AS SELECT 1 AS x;" \
             "SELECT x FROM v WHERE x > 1; SELECT CAST(NULL AS INT) AS only"
    for format, wanted in (
        ("csv", {"result_001": "a,b\n1,\n", "result_003": "x\n", "result_004": 'only\n""\n'}),
        ("json", {"result_001": '{"a":1}\n', "result_003": "", "result_004": "{}\n"}),
    ):
        sink = f"{folder}/{format}"
        result = run_script(spark, script, sink=sink, format=format)
        assert [o.rows for o in result.outcomes] == [1, None, 0, 1]
        assert sorted(os.listdir(sink)) == sorted(wanted)
        for name, text in wanted.items():
            parts = [f for f in os.listdir(f"{sink}/{name}") if f.startswith("part-")]
            assert "".join(open(f"{sink}/{name}/{p}").read() for p in parts) == text
        assert len(result.results) == 3
    with pytest.raises(ValueError):
        run_script(spark, "SELECT 1", format="xml")


def test_text_reaches_the_engine_unchanged(spark):
    result = run_script(spark, "/*hint*/ SELECT '-- kept; /* too */' AS v -- end\n UNION ALL SELECT 'w'")
    assert sorted(r.v for r in result.results[0].collect()) == ["-- kept; /* too */", "w"]


def test_routines(spark):
    calls = []

    def hello(session, count=1, word="x"):
        return session.range(count).selectExpr("id", f"'{word}' AS word")

    def quiet(session):
        calls.append(session)

    result = run_script(
        spark,
        "EXECUTE SCRIPT \"S\".\"HELLO\"(1 + 2, 'a;b)');\n-- c\nexecute script s.quiet();"
        "EXECUTE SCRIPT quiet; EXECUTE IMMEDIATE 'SELECT 5 AS five'; EXECUTE SCRIPT nobody()",
        routines={"s.hello": hello, "S.Quiet": quiet, "quiet": quiet},
    )
    assert [(o.kind, o.status, o.rows) for o in result.outcomes] == [
        ("Execute", "rows", 3), ("Execute", "ok", None), ("Execute", "ok", None),
        ("Execute", "rows", 1), ("Execute", "failed", None),
    ]
    assert result.results[0].first().word == "a;b)" and len(calls) == 2
    assert "Hint: Check that the table exists" in result.outcomes[-1].message


def test_results_outlive_their_tables(spark, table):
    result = run_script(
        spark,
        f"""CREATE TABLE {table} (id INT, v STRING) USING parquet;
        INSERT INTO {table} SELECT id, concat('v', id) FROM range(100);
        SELECT * FROM {table} WHERE id < 3;
        SELECT id, id, NULL AS `a b`, rand() AS `sum(x)` FROM {table} ORDER BY -id LIMIT 20;
        UPDATE {table} SET v = 'changed';
        SELECT count(DISTINCT v) AS n FROM {table};
        DROP TABLE {table}; SELECT 1 AS one; SHOW TABLES LIKE 'nothing'""",
    )
    assert result.failed == 0, result.outcomes[-1].message
    first, ordered, counted, one, none = result.results
    assert sorted(map(tuple, first.collect())) == [(0, "v0"), (1, "v1"), (2, "v2")]
    rows = ordered.collect()
    assert [r[0] for r in rows] == list(range(99, 79, -1)) == [r[1] for r in rows]
    assert ordered.columns == ["id", "id", "a b", "sum(x)"] and rows == ordered.collect()
    assert counted.first().n == 1 == one.first().one and none.count() == 0
    assert [o.rows for o in result.outcomes if o.status == "rows"] == [3, 20, 1, 1, 0]
    result.close(spark)
    with pytest.raises(Exception, match="(?i)not.?exist|not found"):
        first.collect()


def test_scripts_leave_no_old_versions(spark, folder, table):
    run_script(
        spark,
        f"""CREATE TABLE {table} (id INT, p INT) USING parquet PARTITIONED BY (p) LOCATION '{folder}/t';
        INSERT INTO {table} SELECT id, id % 3 FROM range(9);
        UPDATE {table} SET id = -id WHERE p = 1; DELETE FROM {table} WHERE p = 2;
        MERGE INTO {table} t USING (SELECT 3 AS k) s ON t.id = s.k WHEN MATCHED THEN DELETE""",
    )
    assert sorted(r.id for r in spark.table(table).collect()) == [-7, -4, -1, 0, 6]
    assert not [n for n in os.listdir(f"{folder}/t") if n.startswith(("_replaced", "_change"))]
