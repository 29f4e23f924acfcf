"""Queries over the scans, listings, inference and loads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quayside.functions.naming import format_of
from quayside.operators.export import export
from quayside.operators.load import load
from quayside.plans.common import (
    Catalog,
    file_table,
    output_dir,
    table_file,
    table_name,
    use_tables,
)
from quayside.sources.audit import audit_files, source_verdict
from quayside.sources.dialect import CsvDialect
from quayside.sources.infer import create_table_ddl, dry_run, infer_schema, schema_frame
from quayside.sources.listing import (
    extract_blob,
    extract_blobs,
    ingest_blobs,
    list_children,
    list_recursive,
    scan_blobs,
)
from quayside.sources.scan import scan_csv, scan_files, scan_parquet, scan_source

catalog = Catalog()

# One path per document; formats and letter case vary with the language.
_DOCUMENT_PATHS = """
SELECT doc_id, concat(source, '/', lang, '/', CAST(doc_id AS STRING),
                      CASE lang WHEN 'en' THEN '.csv' WHEN 'fr' THEN '.PARQUET'
                                WHEN 'de' THEN '.json' ELSE '' END) AS path
FROM documents
"""


@catalog.add("scan_parquet", "SELECT * FROM orders")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_files(spark, table_file(sf_dir, "orders"))


@catalog.add("scan_table", "SELECT * FROM lineitem")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_source(spark, table=file_table(sf_dir, "lineitem"))


def _csv_copy(
    spark: SparkSession, sf_dir: str, name: str, dialect: CsvDialect | None = None
) -> tuple[str, T.StructType]:
    """A table written as CSV files, and its schema."""
    path = f"{output_dir(spark, name)}/{name}.csv"
    export(spark, path, "csv", table=file_table(sf_dir, name), dialect=dialect)
    return path, spark.read.parquet(table_file(sf_dir, name)).schema


@catalog.add("scan_csv_roundtrip", "SELECT * FROM lineitem")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _csv_copy(spark, sf_dir, "lineitem")
    return scan_csv(spark, path, schema=schema)


@catalog.add("scan_csv_inferred", "SELECT * FROM events")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _csv_copy(spark, sf_dir, "events")
    return scan_csv(spark, path)


@catalog.add("scan_csv_dialect", "SELECT doc_id, text FROM documents")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    dialect = CsvDialect(delimiter="\t", quote="'", escape="\\")
    path, schema = _csv_copy(spark, sf_dir, "documents", dialect)
    return scan_csv(spark, path, dialect, schema).select("doc_id", "text")


@catalog.add(
    "scan_csv_no_header",
    "SELECT c_custkey AS col_1, c_name AS col_2, CAST(c_nationkey AS BIGINT) AS col_3,"
    " c_acctbal AS col_4, c_mktsegment AS col_5 FROM customer",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    dialect = CsvDialect(header=False)
    path, _ = _csv_copy(spark, sf_dir, "customer", dialect)
    return scan_csv(spark, path, dialect)


@catalog.add(
    "scan_csv_null_token",
    "SELECT o_orderkey, nullif(o_orderstatus, 'F') AS o_orderstatus,"
    " nullif(o_orderpriority, 'F') AS o_orderpriority FROM orders",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _csv_copy(spark, sf_dir, "orders")
    rows = scan_csv(spark, path, CsvDialect(null_value="F"), schema)
    return rows.select("o_orderkey", "o_orderstatus", "o_orderpriority")


@catalog.add(
    "scan_multi_file",
    "SELECT printf('orders_%03d.csv', (row_number() OVER (ORDER BY o_orderkey) - 1) // 700)"
    " AS source_file, o_orderkey, o_custkey FROM orders",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = output_dir(spark, "multi")
    export(
        spark,
        f"{folder}/orders.csv",
        "csv",
        table=file_table(sf_dir, "orders"),
        max_rows_per_file=700,
        order_by=["o_orderkey"],
    )
    schema = spark.read.parquet(table_file(sf_dir, "orders")).schema
    rows = scan_csv(spark, f"{folder}/orders_*.csv", schema=schema, lineage="source_file")
    return rows.select("source_file", "o_orderkey", "o_custkey")


@catalog.add(
    "scan_aligned_headers",
    "SELECT n_nationkey AS key, n_name AS name FROM nation"
    " UNION ALL SELECT r_regionkey, r_name FROM region"
    " UNION ALL SELECT CAST(c_custkey AS INTEGER), c_name FROM customer",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "nation", "region", "customer")
    folder = output_dir(spark, "aligned")
    texts = {
        "nation": "SELECT n_nationkey AS key, n_name AS name FROM nation",
        "region": "SELECT r_name AS name, r_regionkey AS key FROM region",
        "customer": "SELECT c_name AS name, c_custkey AS key FROM customer",
    }
    for name, query in texts.items():
        export(spark, f"{folder}/{name}.csv", "csv", query=query)
    rows = scan_csv(spark, f"{folder}/*.csv", align_headers=True)
    return rows.select(F.col("key").cast("int").alias("key"), "name")


@catalog.add(
    "scan_csv_mixed_breaks",
    "SELECT o_orderkey AS id, concat(o_orderpriority, ' \"q\"') AS note FROM orders"
    " UNION ALL SELECT -doc_id, text FROM documents",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file with line breaks inside fields among many without; only that one is not split at every line."""
    use_tables(spark, sf_dir, "orders", "documents")
    folder = output_dir(spark, "mixed")
    plain = "SELECT o_orderkey AS id, concat(o_orderpriority, ' \"q\"') AS note FROM orders"
    export(spark, f"{folder}/orders.csv", "csv", query=plain, max_rows_per_file=2000)
    texts = "SELECT -doc_id AS id, text AS note FROM documents"
    export(spark, f"{folder}/texts.csv", "csv", query=texts, max_rows_per_file=10_000_000)
    return scan_csv(spark, f"{folder}/*.csv")


# One path per nation: of another format, with a file of its customers, and without a file.
_AUDITED = """
SELECT n_nationkey AS k, concat('of/', CAST(n_nationkey AS STRING),
         CASE WHEN n_regionkey = 4 THEN '.json' ELSE '.csv' END) AS path,
       n_regionkey < 3 AS stored FROM nation
"""


@catalog.add(
    "input_audit",
    "WITH p AS (SELECT n_nationkey AS k, n_regionkey AS r,"
    " (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey AND c_acctbal > 9900) AS rows FROM nation)"
    " SELECT concat('of/', k, CASE WHEN r = 4 THEN '.json' ELSE '.csv' END) AS path, CASE WHEN r = 4 THEN 'unsupported file format'"
    " WHEN r = 3 THEN 'file not found' WHEN rows = 0 THEN 'no data rows' ELSE 'ok' END AS verdict FROM p"
    " UNION ALL SELECT concat('request ', o_orderkey), CASE WHEN o_orderstatus = 'F' THEN 'ok' WHEN o_orderstatus = 'O'"
    " THEN 'table and query cannot be used together' ELSE 'either table or query must be provided' END FROM orders",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and requests with the errors that a load or an export would stop with."""
    use_tables(spark, sf_dir, "nation", "customer", "orders")
    folder = output_dir(spark, "audit")
    paths = spark.sql(_AUDITED)
    rich = spark.table("customer").where("c_acctbal > 9900")
    lines = rich.groupBy("c_nationkey").agg(F.sort_array(F.collect_list(F.concat("c_name", F.lit("\n")))).alias("lines"))
    stored = paths.where("stored").join(lines, F.col("k") == F.col("c_nationkey"), "left")
    text = F.concat(F.lit("c_name\n"), F.coalesce(F.array_join("lines", ""), F.lit("")))
    extract_blobs(stored.select(F.col("path").alias("target"), F.encode(text, "UTF-8").alias("content")), folder)
    name = F.when(F.col("o_orderstatus") != "P", "t")
    query = F.when(F.col("o_orderstatus") == "O", "SELECT 1")
    requests = spark.table("orders").select(
        F.concat(F.lit("request "), "o_orderkey").alias("path"), source_verdict(name, query).alias("verdict")
    )
    return audit_files(paths, folder).union(requests)


@catalog.add(
    "file_format_audit",
    "SELECT CASE WHEN lang = 'en' THEN 'csv' WHEN lang = 'fr' THEN 'parquet'"
    " ELSE 'unsupported' END AS format, count(*) AS files FROM documents GROUP BY 1",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "documents")
    found = F.coalesce(format_of(F.col("path")), F.lit("unsupported")).alias("format")
    paths = spark.sql(_DOCUMENT_PATHS)
    return paths.groupBy(found).agg(F.count(F.lit(1)).alias("files"))


@catalog.add(
    "list_recursive",
    "SELECT substr(url, 13) AS name FROM pages"
    " WHERE starts_with(url, 'https://blog') AND substr(url, 13, 1) <> '/'"
    " AND length(url) > 12"
    " UNION ALL SELECT substr(url, 14) FROM pages WHERE starts_with(url, 'https://blog/')",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return list_recursive(_urls(spark, sf_dir), "https://blog/")


@catalog.add(
    "list_children",
    "SELECT DISTINCT split_part(substr(url, 9), '/', 1) AS name FROM pages"
    " WHERE starts_with(url, 'https://') AND length(url) > 8",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The trailing slashes are trimmed, so one slash is left in front of the host.
    urls = _urls(spark, sf_dir).select(F.regexp_replace("path", "://", ":/").alias("path"))
    return list_children(urls, "https:/")


def _urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_parquet(spark, table_file(sf_dir, "pages")).select(F.col("url").alias("path"))


@catalog.add(
    "blob_manifest",
    "WITH lines AS (SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS rn,"
    "  strlen(concat_ws(',', c_custkey, c_name, c_mktsegment)) + 1 AS size FROM customer)"
    " SELECT CASE WHEN max(max(rn)) OVER () < 400 THEN 'raw/customer.csv'"
    "  ELSE printf('raw/customer_%03d.csv', rn // 400) END AS target,"
    " CAST(sum(size) + 30 AS BIGINT) AS length FROM lines GROUP BY rn // 400",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "customer")
    folder = output_dir(spark, "blobs")
    export(
        spark,
        f"{folder}/customer.csv",
        "csv",
        query="SELECT c_custkey, c_name, c_mktsegment FROM customer",
        max_rows_per_file=400,
        order_by=["c_custkey"],
    )
    table = ingest_blobs(spark, f"{folder}/*.csv", "raw/", f"{folder}/contents")
    return table.select("target", F.octet_length("content").cast("long").alias("length"))


@catalog.add(
    "blob_extract_one",
    "SELECT 'first.txt' AS name, text FROM documents WHERE doc_id = (SELECT min(doc_id) FROM documents)"
    " UNION ALL SELECT concat(doc_id, '.txt'), text FROM documents WHERE doc_id = (SELECT max(doc_id) FROM documents)",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single files: one to a path, one into a directory, where it keeps its name."""
    folder = output_dir(spark, "one")
    documents = scan_parquet(spark, table_file(sf_dir, "documents"))
    contents = documents.select(
        F.concat(F.lit("raw/"), "doc_id", F.lit(".txt")).alias("target"), F.encode("text", "UTF-8").alias("content")
    )
    first, last = documents.agg(F.min("doc_id"), F.max("doc_id")).first()
    extract_blob(contents, f"raw/{first}.txt", f"{folder}/first.txt")
    extract_blob(contents, f"raw/{last}.txt", folder)
    return scan_blobs(spark, folder).select(
        F.substring_index("path", "/", -1).alias("name"), F.decode("content", "UTF-8").alias("text")
    )


@catalog.add("blob_extract", "SELECT doc_id, text FROM documents")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = output_dir(spark, "extract")
    documents = scan_parquet(spark, table_file(sf_dir, "documents"))
    contents = documents.select(
        F.concat("lang", F.lit("/"), "doc_id", F.lit(".txt")).alias("target"),
        F.encode("text", "UTF-8").alias("content"),
    )
    extract_blobs(contents, folder)
    written = scan_blobs(spark, folder)
    return written.select(
        F.regexp_extract("path", r"/(\d+)\.txt$", 1).cast("long").alias("doc_id"),
        F.decode("content", "UTF-8").alias("text"),
    )


def _filled_columns(schema: T.StructType, rows: DataFrame) -> DataFrame:
    """The schema, with how many values of each column were read under it."""
    counts = rows.agg(*[F.count(f"`{name}`").alias(name) for name in schema.names])
    values = counts.unpivot([], list(schema.names), "name", "filled")
    described = schema_frame(rows.sparkSession, schema).select("ordinal", "name", "type")
    return described.join(F.broadcast(values), "name").select("ordinal", "name", "type", "filled")


def _filled_oracle(table: str, columns: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT {ordinal} AS ordinal, '{name}' AS name, '{kind}' AS type,"
        f" count({name}) AS filled FROM {table}"
        for ordinal, (name, kind) in enumerate(columns, start=1)
    )


_LINEITEM_TYPES = [
    ("l_orderkey", "BIGINT"), ("l_partkey", "BIGINT"), ("l_suppkey", "BIGINT"),
    ("l_linenumber", "INT"), ("l_quantity", "DOUBLE"), ("l_extendedprice", "DOUBLE"),
    ("l_discount", "DOUBLE"), ("l_tax", "DOUBLE"), ("l_returnflag", "STRING"),
    ("l_linestatus", "STRING"), ("l_shipdate", "TIMESTAMP_NTZ"),
]
_EVENT_TYPES = [
    ("event_id", "BIGINT"), ("ts", "TIMESTAMP_NTZ"), ("user_id", "BIGINT"),
    ("event_type", "STRING"), ("value", "DOUBLE"), ("props", "STRING"),
]


@catalog.add("infer_parquet_schema", _filled_oracle("lineitem", _LINEITEM_TYPES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = table_file(sf_dir, "lineitem")
    return _filled_columns(infer_schema(spark, path), scan_parquet(spark, path))


@catalog.add("infer_csv_schema", _filled_oracle("events", _EVENT_TYPES))
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _csv_copy(spark, sf_dir, "events")
    schema = infer_schema(spark, path)
    return _filled_columns(schema, scan_csv(spark, path, schema=schema))


@catalog.add(
    "dry_run_ddl",
    "SELECT 'CREATE TABLE `sales`.`orders` (`o_orderkey` BIGINT, `o_custkey` BIGINT,"
    " `o_orderstatus` STRING, `o_totalprice` DOUBLE, `o_orderdate` TIMESTAMP_NTZ,"
    " `o_orderpriority` STRING) USING parquet' AS ddl, count(*) AS columns"
    " FROM (DESCRIBE SELECT * FROM orders)",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _csv_copy(spark, sf_dir, "orders")
    columns, ddl = dry_run(spark, path, "sales.orders")
    return columns.agg(F.lit(ddl).alias("ddl"), F.count(F.lit(1)).alias("columns"))


@catalog.add(
    "reserved_word_column",
    'SELECT event_id AS "Order", ts AS "timestamp", event_type AS "Group By" FROM events',
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, name = output_dir(spark, "reserved"), table_name("reserved")
    rows = scan_parquet(spark, table_file(sf_dir, "events")).select(
        F.col("event_id").alias("Order"),
        F.col("ts").alias("timestamp"),
        F.col("event_type").alias("Group By"),
    )
    rows.write.parquet(f"{folder}/events.parquet")
    load(spark, f"{folder}/events.parquet", name, location=f"{folder}/table")
    return spark.table(name)


@catalog.add("load_autocreate", "SELECT * FROM orders")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _csv_copy(spark, sf_dir, "orders")
    name = table_name("autocreate")
    load(spark, path, name, location=f"{output_dir(spark, name)}/table")
    return spark.table(name)


@catalog.add(
    "load_append_twice",
    "SELECT p_partkey, p_name, p_size FROM part"
    " UNION ALL SELECT p_partkey, p_name, p_size FROM part",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet, then CSV with other letter case, into a table that already exists."""
    folder, name = output_dir(spark, "append"), table_name("append")
    rows = scan_parquet(spark, table_file(sf_dir, "part")).select("p_partkey", "p_name", "p_size")
    rows.write.parquet(f"{folder}/part.parquet")
    renamed = rows.toDF("P_PARTKEY", "P_NAME", "P_SIZE").select("P_SIZE", "P_NAME", "P_PARTKEY")
    renamed.write.options(**CsvDialect().write_options()).csv(f"{folder}/part.csv")
    spark.sql(create_table_ddl(rows.schema, name, f"{folder}/table"))
    load(spark, f"{folder}/part.parquet", name)
    load(spark, f"{folder}/part.csv", name)
    return spark.table(name)


@catalog.add("load_row_count", "SELECT count(*) AS imported FROM documents")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _csv_copy(spark, sf_dir, "documents")
    name = table_name("counted")
    imported = load(spark, path, name, location=f"{output_dir(spark, name)}/table")
    return spark.createDataFrame([(imported,)], "imported long")
