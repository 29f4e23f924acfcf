"""Queries over script execution, DML, and analytics on SQL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.functions.sqltext import (
    HINT_CONNECTION,
    HINT_OBJECT,
    HINT_PERMISSION,
    HINT_SYNTAX,
    WHITE_SPACE,
    classify,
    error_hint,
    split_statements,
    strip_comments,
    truncate_sql,
)
from quayside.operators.dml import delete, merge, update
from quayside.operators.export import export
from quayside.operators.load import append, load
from quayside.operators.script import ScriptResult, run_script
from quayside.plans.common import (
    Catalog,
    file_table,
    output_dir,
    table_file,
    table_name,
    use_tables,
)
from quayside.sources.scan import scan_csv

catalog = Catalog()


def _loaded(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A table of our own with the rows of a driver table."""
    copy = table_name(name)
    load(spark, table_file(sf_dir, name), copy, location=f"{output_dir(spark, copy)}/table")
    return copy


def _run(spark: SparkSession, script: str, **arguments) -> ScriptResult:
    result = run_script(spark, script, **arguments)
    if result.failed:
        raise RuntimeError(result.outcomes[-1].message)
    return result


@catalog.add(
    "script_report",
    "SELECT 1 AS n, 'Ddl' AS kind, 'ok' AS status, CAST(NULL AS BIGINT) AS rows"
    " UNION ALL SELECT 2, 'Dml', 'affected', count(*) FROM orders"
    " UNION ALL SELECT 3, 'Dml', 'affected', count(*) FROM orders WHERE o_orderstatus = 'P'"
    " UNION ALL SELECT 4, 'Dml', 'affected', count(*) FROM orders WHERE o_orderstatus = 'O'"
    " UNION ALL SELECT 5, 'Query', 'rows', count(*) FROM orders WHERE o_orderstatus <> 'O'"
    " UNION ALL SELECT 6, 'Query', 'rows', count(DISTINCT o_orderpriority) FROM orders",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "orders")
    folder, name = output_dir(spark, "script"), table_name("script")
    script = f"""
    -- statuses; and priorities
    CREATE TABLE {name} (k BIGINT, status STRING, note STRING)
      USING parquet LOCATION '{folder}/table';
    INSERT INTO {name} SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders;
    UPDATE {name} SET note = 'pending; later', k = k + 1 WHERE status = 'P';
    DELETE FROM {name} WHERE status = 'O' /* open; */;
    /* hint */ SELECT * FROM {name};
    WITH p AS (SELECT DISTINCT o_orderpriority FROM orders) SELECT * FROM p;
    """
    result = _run(spark, script, sink=f"{folder}/results")
    return result.report(spark).select("n", "kind", "status", "rows")


@catalog.add(
    "script_results_kept",
    "SELECT o_orderstatus, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS customers FROM orders GROUP BY 1",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A result read after its table was changed and dropped."""
    use_tables(spark, sf_dir, "orders")
    folder, name = output_dir(spark, "kept"), table_name("kept")
    script = f"""
    CREATE TABLE {name} (status STRING, customer BIGINT) USING parquet LOCATION '{folder}/table';
    INSERT INTO {name} SELECT o_orderstatus, o_custkey FROM orders;
    SELECT status AS o_orderstatus, count(*) AS n, sum(customer) AS customers FROM {name} GROUP BY status;
    UPDATE {name} SET customer = 0; DELETE FROM {name} WHERE status = 'F'; DROP TABLE {name}
    """
    return _run(spark, script).results[0]


@catalog.add(
    "script_verbatim",
    "SELECT o_orderkey, '-- kept; /* too */' AS note, ';' || o_orderstatus AS shown FROM orders"
    " WHERE o_orderpriority <> '; --' AND o_totalprice > 100000",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text between quotes and in comments reaches the engine as it was written."""
    use_tables(spark, sf_dir, "orders")
    script = """/* first; */ SELECT 1 -- one; 'two
    ;/*hint*/ SELECT o_orderkey, '-- kept; /* too */' AS note, ';' || o_orderstatus AS shown -- end;
    FROM orders WHERE o_orderpriority <> '; --' /* and; */ AND o_totalprice > 100000"""
    return _run(spark, script).results[1]


@catalog.add(
    "script_ddl",
    "SELECT o_orderkey AS k, o_orderstatus AS status, NULL::VARCHAR AS note FROM orders WHERE o_orderstatus <> 'P'"
    " UNION ALL SELECT -c_custkey, 'c', c_name FROM customer WHERE c_acctbal < 0",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas, tables, columns and views made, changed and dropped by one script."""
    use_tables(spark, sf_dir, "orders", "customer")
    folder, schema = output_dir(spark, "ddl"), table_name("schema")
    script = f"""
    CREATE SCHEMA {schema} LOCATION '{folder}/schema';
    CREATE TABLE {schema}.draft (k BIGINT, status STRING) USING parquet;
    INSERT INTO {schema}.draft SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P';
    ALTER TABLE {schema}.draft ADD COLUMN note STRING;
    ALTER TABLE {schema}.draft RENAME TO {schema}.final;
    INSERT INTO {schema}.final SELECT -c_custkey, 'c', c_name FROM customer WHERE c_acctbal < 0;
    CREATE VIEW {schema}.all_rows AS SELECT * FROM {schema}.final;
    SELECT * FROM {schema}.all_rows;
    DROP VIEW {schema}.all_rows; DROP TABLE {schema}.final; DROP SCHEMA {schema}
    """
    return _run(spark, script).results[0]


@catalog.add(
    "script_describe",
    " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, column_name, CASE column_type WHEN 'BIGINT' THEN 'bigint'"
        " WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'"
        " WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' END AS data_type"
        f" FROM (DESCRIBE SELECT * FROM {table})"
        for table in ("orders", "lineitem", "embeddings")
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DESCRIBE of the tables that SHOW lists, after an EXPLAIN of each."""
    names = ("orders", "lineitem", "embeddings")
    use_tables(spark, sf_dir, *names)
    script = ";".join(f"EXPLAIN SELECT * FROM {n}; SHOW VIEWS LIKE '{n}'; DESCRIBE {n}" for n in names)
    results = _run(spark, script).results
    found = None
    for at in range(0, len(results), 3):
        plan, shown, described = results[at : at + 3]
        if "FileScan" not in plan.first()[0]:
            raise RuntimeError("EXPLAIN gave no plan of a scan")
        named = described.select(
            F.lit(shown.first().viewName).alias("table_name"), F.col("col_name").alias("column_name"), "data_type"
        )
        found = named if found is None else found.union(named)
    return found


@catalog.add("script_results", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "orders")
    folder = output_dir(spark, "results")
    script = (
        "SELECT count(*) AS n FROM orders;"
        "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority"
    )
    _run(spark, script, sink=folder, format="json")
    schema = "o_orderpriority string, n long"
    return spark.read.schema(schema).json(f"{folder}/result_002")


@catalog.add("script_results_csv", "SELECT * FROM orders WHERE o_orderstatus = 'P'")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "orders")
    folder = output_dir(spark, "results")
    _run(
        spark,
        "SELECT o_orderkey FROM orders; SELECT * FROM orders WHERE o_orderstatus = 'P'",
        sink=folder,
    )
    return scan_csv(spark, f"{folder}/result_002", schema=spark.table("orders").schema)


@catalog.add(
    "routine_rows",
    "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 1000 GROUP BY 1",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "orders")

    def by_status(session: SparkSession, least: int) -> DataFrame:
        orders = session.table("orders").where(F.col("o_totalprice") > least)
        return orders.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))

    script = 'EXECUTE SCRIPT "SALES"."BY_STATUS"(500 + 500)'
    return _run(spark, script, routines={"sales.by_status": by_status}).results[0]


@catalog.add(
    "dml_insert",
    "SELECT * FROM supplier UNION ALL"
    " SELECT s_suppkey + 1000000, s_name, s_nationkey, -s_acctbal FROM supplier",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _loaded(spark, sf_dir, "supplier")
    supplier = spark.read.parquet(table_file(sf_dir, "supplier"))
    more = supplier.selectExpr(
        "s_suppkey + 1000000 AS s_suppkey", "s_name", "s_nationkey", "-s_acctbal AS s_acctbal"
    )
    append(more, name)
    return spark.table(name)


@catalog.add(
    "dml_insert_values",
    "SELECT * FROM nation UNION ALL SELECT * FROM (VALUES (100, 'NOWHERE', 9), (101, NULL, 9))",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _loaded(spark, sf_dir, "nation")
    _run(spark, f"INSERT INTO {name} VALUES (100, 'NOWHERE', 9), (101, NULL, 9)")
    return spark.table(name)


@catalog.add(
    "dml_update",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey + 1 ELSE o_custkey END"
    " AS o_custkey, CASE WHEN o_orderstatus = 'F' THEN concat('was ', o_orderstatus)"
    " ELSE o_orderstatus END AS o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
    " FROM orders",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _loaded(spark, sf_dir, "orders")
    values = {"o_orderstatus": "concat('was ', o_orderstatus)", "O_CUSTKEY": "o_custkey + 1"}
    update(spark, name, values, "o_orderstatus = 'F'")
    return spark.table(name)


@catalog.add("dml_delete", "SELECT * FROM lineitem WHERE NOT (l_quantity > 25)")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _loaded(spark, sf_dir, "lineitem")
    delete(spark, name, "l_quantity > 25")
    return spark.table(name)


@catalog.add(
    "dml_hit_files",
    "WITH placed AS (SELECT *, (row_number() OVER (ORDER BY o_orderkey) - 1) // 300 AS f FROM orders),"
    " hit AS (SELECT * FROM placed WHERE o_orderkey BETWEEN 1000 AND 2000 OR o_totalprice > 499900)"
    " SELECT (SELECT count(*) FROM hit) AS rows, (SELECT count(DISTINCT f) FROM hit) AS files,"
    " (SELECT count(DISTINCT f) FROM placed) AS all_files, count(*) AS n, CAST(sum(o_custkey) AS BIGINT)"
    " + (SELECT count(*) FROM hit) AS customers FROM orders",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An UPDATE writes only the files that hold rows it changes."""
    folder, name = output_dir(spark, "hit"), table_name("hit")
    orders = file_table(sf_dir, "orders")
    made = export(spark, f"{folder}/o.parquet", "parquet", table=orders, max_rows_per_file=300, order_by=["o_orderkey"])
    spark.sql(f"CREATE TABLE {name} USING parquet LOCATION '{folder}'")
    done = update(spark, name, {"o_custkey": "o_custkey + 1"}, "o_orderkey BETWEEN 1000 AND 2000 OR o_totalprice > 499900")
    counts = [F.lit(n).cast("long").alias(c) for n, c in ((done.rows, "rows"), (done.files, "files"), (made.num_files, "all_files"))]
    return spark.table(name).agg(
        *[F.max(c).alias(n) for c, n in zip(counts, ("rows", "files", "all_files"))],
        F.count(F.lit(1)).alias("n"),
        F.sum("o_custkey").alias("customers"),
    )


@catalog.add(
    "dml_partitioned",
    "WITH changed AS (SELECT l_orderkey, l_linenumber,"
    " CASE WHEN l_returnflag = 'R' AND l_quantity > 25 THEN -l_quantity ELSE l_quantity END AS l_quantity, l_discount,"
    " CASE WHEN l_returnflag = 'A' AND l_discount > 0.05 THEN 'a moved' ELSE l_returnflag END AS l_returnflag, l_linestatus"
    " FROM lineitem WHERE NOT (l_returnflag = 'N' AND l_linenumber = 2))"
    " SELECT * FROM changed"
    " UNION ALL SELECT -o_orderkey, 0, 1.0, 0.0, 'new', o_orderstatus FROM orders WHERE o_orderpriority = '1-URGENT'",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPDATE, DELETE and MERGE on a partitioned table, with rows that go to other and to new partitions."""
    use_tables(spark, sf_dir, "lineitem", "orders")
    folder, name = output_dir(spark, "partitioned"), table_name("partitioned")
    _run(
        spark,
        f"""CREATE TABLE {name} USING parquet PARTITIONED BY (l_returnflag, l_linestatus) LOCATION '{folder}/table'
          AS SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_linestatus FROM lineitem;
        UPDATE {name} SET l_quantity = -l_quantity WHERE l_returnflag = 'R' AND l_quantity > 25;
        UPDATE {name} SET l_returnflag = 'a moved' WHERE l_returnflag = 'A' AND l_discount > 0.05;
        DELETE FROM {name} WHERE l_returnflag = 'N' AND l_linenumber = 2;
        MERGE INTO {name} t USING (SELECT -o_orderkey AS k, o_orderstatus AS s FROM orders WHERE o_orderpriority = '1-URGENT') s
          ON t.l_orderkey = s.k
          WHEN MATCHED THEN DELETE
          WHEN NOT MATCHED THEN INSERT (l_orderkey, l_linenumber, l_quantity, l_discount, l_returnflag, l_linestatus)
            VALUES (s.k, 0, 1.0, 0.0, 'new', s.s)""",
    )
    return spark.table(name)


@catalog.add(
    "dml_merge_clauses",
    "WITH joined AS (SELECT c.*, o.o_custkey, o.total, o.n FROM customer c LEFT JOIN"
    "  (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY 1) o"
    "  ON c.c_custkey = o.o_custkey AND o.n > 5 AND c.c_acctbal < o.total),"
    " coded AS (SELECT *, CASE WHEN o_custkey IS NULL THEN CASE WHEN c_mktsegment = 'MACHINERY' THEN 'drop'"
    "   WHEN c_acctbal < 0 THEN 'idle' ELSE 'keep' END"
    "  WHEN n > 15 THEN 'big' WHEN c_acctbal < 0 THEN 'drop' WHEN n > 8 THEN 'some' ELSE 'keep' END AS what FROM joined)"
    " SELECT c_custkey, CASE what WHEN 'big' THEN concat('big ', n) WHEN 'idle' THEN 'idle' ELSE c_name END AS c_name,"
    "  c_nationkey, CASE what WHEN 'some' THEN c_acctbal + 1000 WHEN 'idle' THEN 0.0 ELSE c_acctbal END AS c_acctbal,"
    "  c_mktsegment FROM coded WHERE what <> 'drop'"
    " UNION ALL SELECT o_custkey, CASE WHEN n > 12 THEN 'back' END, NULL, CASE WHEN n <= 12 THEN 0.5 END, NULL"
    "  FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o WHERE n > 10 AND NOT EXISTS"
    "  (SELECT 1 FROM joined j WHERE j.o_custkey = o.o_custkey)",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of MERGE clause, several of each, in the order written, with a residual condition."""
    use_tables(spark, sf_dir, "customer", "orders")
    name = _loaded(spark, sf_dir, "customer")
    _run(
        spark,
        f"""MERGE INTO {name} AS c
        USING (SELECT o_custkey, sum(o_totalprice) AS total, count(*) AS n FROM orders GROUP BY o_custkey) AS o
        ON c.c_custkey = o.o_custkey AND o.n > 5 AND c.c_acctbal < o.total
        WHEN MATCHED AND o.n > 15 THEN UPDATE SET c_name = concat('big ', o.n)
        WHEN MATCHED AND c.c_acctbal < 0 THEN DELETE
        WHEN MATCHED AND o.n > 8 THEN UPDATE SET c.c_acctbal = c.c_acctbal + 1000
        WHEN NOT MATCHED AND o.n > 12 THEN INSERT (c_custkey, c_name) VALUES (o.o_custkey, 'back')
        WHEN NOT MATCHED AND o.n > 10 THEN INSERT (c_custkey, c_acctbal) VALUES (o.o_custkey, 0.5)
        WHEN NOT MATCHED BY SOURCE AND c.c_mktsegment = 'MACHINERY' THEN DELETE
        WHEN NOT MATCHED BY SOURCE AND c.c_acctbal < 0 THEN UPDATE SET c_name = 'idle', c_acctbal = 0""",
    )
    return spark.table(name)


# New balances for the customers of one segment, and as many new customers.
_CHANGES = """
SELECT c_custkey, 'changed' AS note, c_acctbal + 1 AS balance FROM customer
 WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey + 10000000, 'new', c_acctbal FROM customer
 WHERE c_mktsegment = 'BUILDING'
"""
_MERGED = """
SELECT coalesce(c.c_custkey, s.c_custkey) AS c_custkey,
       CASE WHEN c.c_custkey IS NULL THEN s.note ELSE c.c_name END AS c_name,
       c.c_nationkey,
       CASE WHEN s.c_custkey IS NULL THEN c.c_acctbal ELSE s.balance END AS c_acctbal,
       CASE WHEN c.c_custkey IS NULL THEN NULL
            WHEN s.c_custkey IS NULL THEN c.c_mktsegment ELSE s.note END AS c_mktsegment
  FROM customer c FULL JOIN ({changes}) s ON c.c_custkey = s.c_custkey
"""


@catalog.add("dml_merge", _MERGED.format(changes=_CHANGES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "customer")
    name = _loaded(spark, sf_dir, "customer")
    merge(
        spark,
        name,
        spark.sql(_CHANGES),
        ["c_custkey"],
        update={"c_acctbal": "s.balance", "c_mktsegment": "s.note"},
        insert={"c_custkey": "s.c_custkey", "c_name": "s.note", "c_acctbal": "s.balance"},
    )
    return spark.table(name)


@catalog.add(
    "dml_merge_sql",
    "SELECT * FROM (" + _MERGED.format(changes=_CHANGES) + ") WHERE c_acctbal >= 0"
    " OR c_mktsegment IS DISTINCT FROM 'changed'",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "customer")
    name = _loaded(spark, sf_dir, "customer")
    _run(
        spark,
        f"""MERGE INTO {name} AS c USING ({_CHANGES}) AS s ON c.c_custkey = s.c_custkey
        WHEN MATCHED AND s.balance < 0 THEN DELETE
        WHEN MATCHED THEN UPDATE SET c_acctbal = s.balance, c_mktsegment = s.note
        WHEN NOT MATCHED THEN INSERT (c_custkey, c_name, c_acctbal)
          VALUES (s.c_custkey, s.note, s.balance)""",
    )
    return spark.table(name)


@catalog.add(
    "dml_affected_rows",
    "SELECT 1 AS n, count(*) AS rows FROM orders WHERE o_orderpriority = '1-URGENT'"
    " UNION ALL SELECT 2, count(*) FROM orders WHERE o_orderstatus = 'P'"
    " UNION ALL SELECT 3, count(*) FROM orders WHERE o_orderstatus = 'F'"
    " UNION ALL SELECT 4, 0",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "orders")
    name = _loaded(spark, sf_dir, "orders")
    result = _run(
        spark,
        f"""UPDATE {name} SET o_totalprice = 0 WHERE o_orderpriority = '1-URGENT';
        DELETE FROM {name} WHERE o_orderstatus = 'P';
        INSERT INTO {name} SELECT * FROM orders WHERE o_orderstatus = 'F';
        DELETE FROM {name} WHERE o_orderstatus = 'P'""",
    )
    return result.report(spark).select("n", "rows")


# One alternative per kind of token: the reference SQL cuts text into these.
_TOKENS = r"""'[^']*(?:'|\z)|"[^"]*(?:"|\z)|--[^\n]*|/\*[\s\S]*?(?:\*/|\z)|;|[^'";/-]+|[-/]"""

# A query log made from the orders (quotes, comments, empty and open pieces), and web
# pages taken as scripts.  chr(39) is a single quote and chr(10) a line break.
LOG = """
SELECT o_orderkey AS log_id, CASE o_orderpriority
  WHEN '1-URGENT' THEN concat('INSERT INTO t VALUES (', o_orderkey, ', ', chr(39), 'a;b', chr(39),
    '); -- note; x', chr(10), ' select ', o_custkey, ';')
  WHEN '2-HIGH' THEN concat('/* hint; ', o_orderstatus, ' */ SELECT * FROM t WHERE k = ',
    o_orderkey, ';Update t SET "c;d" = ', chr(39), o_orderstatus, '--', chr(39))
  WHEN '3-MEDIUM' THEN concat('-- only ', o_orderstatus, chr(10), '/* another */', chr(10))
  WHEN '4-NOT SPECIFIED' THEN concat('WITH c AS (SELECT ', o_custkey, ' - 1 / 2)', chr(10),
    'SELECT * FROM c;;  EXECUTE SCRIPT "S"."RUN"(', o_orderkey, '); /* open ; ', o_orderstatus)
  ELSE concat('  CREATE TABLE größe_', o_orderkey, ' (straße STRING, note STRING, größe INT) ',
    'COMMENT ', chr(39), 'für ', o_orderstatus, chr(39), ' ;', chr(10), chr(9), 'SELECT(1)')
  END AS script FROM orders
UNION ALL SELECT -1 - page_id, html FROM pages
"""


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "orders", "pages")
    return spark.sql(LOG)


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _trimmed(text: str) -> str:
    pattern = _sql_text(rf"^[{WHITE_SPACE}]+|[{WHITE_SPACE}]+\z")
    return f"regexp_replace({text}, {pattern}, '', 'g')"


def _mapped(text: str, case: str) -> str:
    tokens = f"regexp_extract_all({text}, {_sql_text(_TOKENS)})"
    return f"array_to_string(list_transform({tokens}, lambda x: {case}), '')"


def _stripped(text: str) -> str:
    return _mapped(
        text, "CASE WHEN starts_with(x, '--') OR starts_with(x, '/*') THEN ' ' ELSE x END"
    )


_PIECES = (
    f"SELECT log_id, generate_subscripts(pieces, 1) AS n, unnest(pieces) AS statement FROM ("
    f"SELECT log_id, list_filter(list_transform(string_split("
    f"{_mapped('script', 'CASE WHEN x = chr(59) THEN chr(1) ELSE x END')}, chr(1)),"
    f" lambda p: {_trimmed('p')}), lambda p: {_trimmed(_stripped('p'))} <> '') AS pieces"
    f" FROM ({LOG}))"
)


def _statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _log(spark, sf_dir)
    pieces = log.select("log_id", F.posexplode(split_statements(F.col("script"))))
    return pieces.select("log_id", (F.col("pos") + 1).alias("n"), F.col("col").alias("statement"))


@catalog.add("log_split", f"SELECT log_id, CAST(n AS INTEGER) AS n, statement FROM ({_PIECES})")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _statements(spark, sf_dir)


@catalog.add("log_strip", f"SELECT log_id, {_stripped('script')} AS stripped FROM ({LOG})")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).select("log_id", strip_comments(F.col("script")).alias("stripped"))


_WORD = f"upper(regexp_extract({_trimmed(_stripped('statement'))}, '^[^{WHITE_SPACE}]+'))"


@catalog.add(
    "log_classify_counts",
    "SELECT CASE WHEN w IN ('SELECT', 'WITH', 'DESCRIBE', 'EXPLAIN', 'SHOW') THEN 'Query'"
    " WHEN w IN ('INSERT', 'UPDATE', 'DELETE', 'MERGE') THEN 'Dml'"
    " WHEN w = 'EXECUTE' THEN 'Execute' ELSE 'Ddl' END AS kind, count(*) AS statements"
    f" FROM (SELECT {_WORD} AS w FROM ({_PIECES})) GROUP BY 1",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = _statements(spark, sf_dir).select(classify(F.col("statement")).alias("kind"))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("statements"))


@catalog.add(
    "log_truncate",
    "SELECT log_id, CASE WHEN strlen(t) > 60 THEN concat(substr(t, 1, 57), '...') ELSE t END"
    f" AS display FROM (SELECT log_id, {_trimmed('script')} AS t FROM ({LOG}))",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _log(spark, sf_dir).select("log_id", truncate_sql(F.col("script")).alias("display"))


_MESSAGES = """
SELECT CASE event_type
  WHEN 'error' THEN concat('Syntax error near ', props)
  WHEN 'click' THEN concat('OBJECT U', user_id, ' Not Found')
  WHEN 'view' THEN concat('operation not allowed for user ', user_id)
  WHEN 'purchase' THEN concat('Connection refused, attempt ', event_id)
  ELSE concat('unknown ', event_type) END AS message FROM events
UNION ALL SELECT text FROM conversations
"""


@catalog.add(
    "error_hint_counts",
    "SELECT CASE WHEN contains(m, 'object') AND contains(m, 'not found')"
    f" THEN {_sql_text(HINT_OBJECT)}"
    " WHEN contains(m, 'insufficient privileges') OR contains(m, 'not allowed')"
    f" THEN {_sql_text(HINT_PERMISSION)}"
    f" WHEN contains(m, 'syntax error') THEN {_sql_text(HINT_SYNTAX)}"
    " WHEN contains(m, 'connection') OR contains(m, 'connect')"
    f" THEN {_sql_text(HINT_CONNECTION)} END AS hint, count(*) AS messages"
    f" FROM (SELECT lower(message) AS m FROM ({_MESSAGES})) GROUP BY 1",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "events", "conversations")
    hints = spark.sql(_MESSAGES).select(error_hint(F.col("message")).alias("hint"))
    return hints.groupBy("hint").agg(F.count(F.lit(1)).alias("messages"))
