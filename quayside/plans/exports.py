"""Queries over the export sinks and file splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quayside.operators.export import PARQUET_CODECS, export, export_json
from quayside.plans.common import Catalog, file_table, output_dir, table_file, use_tables
from quayside.sources.dialect import CsvDialect
from quayside.sources.listing import scan_blobs
from quayside.sources.scan import scan_csv, scan_parquet, zero_rows

catalog = Catalog()

_FILTER_QUERY = (
    "SELECT o_orderkey, o_custkey, o_totalprice, o_orderpriority FROM orders"
    " WHERE o_totalprice > 250000 AND o_orderstatus IN ('F', 'O')"
)
# Only letters, so that a line's bytes are plain to count; lengths vary widely.
_LETTERS_QUERY = (
    "SELECT doc_id, lang, concat('x', regexp_replace(text, '[^A-Za-z]', '')) AS letters"
    " FROM documents"
)


@catalog.add("export_csv", "SELECT * FROM lineitem")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{output_dir(spark, 'csv')}/lineitem.csv"
    table = file_table(sf_dir, "lineitem")
    export(spark, path, "csv", table=table)
    return scan_csv(spark, path, schema=spark.table(table).schema)


@catalog.add("export_parquet", "SELECT * FROM lineitem")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{output_dir(spark, 'parquet')}/lineitem.parquet"
    export(spark, path, "parquet", table=file_table(sf_dir, "lineitem"))
    return scan_parquet(spark, path)


@catalog.add("export_nested_parquet", "SELECT vec_id, embedding, label FROM embeddings")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = output_dir(spark, "nested")
    export(
        spark,
        f"{folder}/embeddings.parquet",
        "parquet",
        table=file_table(sf_dir, "embeddings"),
        max_rows_per_file=150,
    )
    return scan_parquet(spark, f"{folder}/embeddings*.parquet")


@catalog.add("export_query_filter", _FILTER_QUERY)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "orders")
    path = f"{output_dir(spark, 'query')}/orders.csv"
    export(spark, path, "csv", query=_FILTER_QUERY)
    return scan_csv(spark, path)


@catalog.add("export_query_filter_parquet", _FILTER_QUERY)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "orders")
    path = f"{output_dir(spark, 'query')}/orders.parquet"
    export(spark, path, "parquet", query=_FILTER_QUERY)
    return scan_parquet(spark, path)


@catalog.add(
    "export_codecs",
    " UNION ALL ".join(
        f"SELECT '{codec}' AS codec, count(*) AS rows, sum(p_partkey)::BIGINT AS keys FROM part"
        for codec in PARQUET_CODECS
    ),
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = output_dir(spark, "codecs")
    for codec in PARQUET_CODECS:
        path = f"{folder}/{codec}.parquet"
        export(spark, path, "parquet", table=file_table(sf_dir, "part"), compression=codec)
    written = scan_parquet(spark, f"{folder}/*.parquet")
    codec = F.regexp_extract(F.col("_metadata.file_path"), r"/(\w+)\.parquet/", 1).alias("codec")
    return written.groupBy(codec).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("p_partkey").alias("keys")
    )


@catalog.add("export_csv_no_header", "SELECT * FROM supplier")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, dialect = f"{output_dir(spark, 'bare')}/supplier.csv", CsvDialect(header=False)
    table = file_table(sf_dir, "supplier")
    export(spark, path, "csv", table=table, dialect=dialect)
    return scan_csv(spark, path, dialect, spark.table(table).schema)


@catalog.add(
    "export_null_token",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,"
    " coalesce(nullif(o_orderstatus, 'F'), 'N/A') AS status FROM orders",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "orders")
    path = f"{output_dir(spark, 'nulls')}/orders.csv"
    query = "SELECT o_orderkey, nullif(o_orderstatus, 'F') AS status FROM orders"
    export(spark, path, "csv", query=query, dialect=CsvDialect(null_value="N/A"))
    return spark.read.csv(path, header=True)


def _named(stem: str, extension: str, file_id: str) -> str:
    """SQL for a part's file name: the plain name when there is only one part."""
    return (
        f"CASE WHEN max(max({file_id})) OVER () = 0 THEN '{stem}.{extension}'"
        f" ELSE printf('{stem}_%03d.{extension}', {file_id}) END"
    )


@catalog.add(
    "split_rows_manifest",
    "WITH numbered AS (SELECT o_orderkey, o_custkey,"
    "  (row_number() OVER (ORDER BY o_orderkey) - 1) // 4000 AS f FROM orders)"
    f" SELECT {_named('orders', 'parquet', 'f')} AS file_name, count(*) AS rows,"
    " min(o_orderkey) AS first_key, max(o_orderkey) AS last_key,"
    " CAST(sum(o_custkey) AS BIGINT) AS customers FROM numbered GROUP BY f",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = output_dir(spark, "rows")
    export(
        spark,
        f"{folder}/orders.parquet",
        "parquet",
        table=file_table(sf_dir, "orders"),
        max_rows_per_file=4000,
        order_by=["o_orderkey"],
    )
    written = scan_parquet(spark, f"{folder}/orders*.parquet", lineage="file_name")
    return written.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("o_orderkey").alias("first_key"),
        F.max("o_orderkey").alias("last_key"),
        F.sum("o_custkey").alias("customers"),
    )


@catalog.add(
    "split_rows_stored_order",
    "WITH total AS (SELECT count(*) AS n FROM lineitem)"
    " SELECT CASE WHEN n <= 7000 THEN 'lineitem.parquet'"
    "  ELSE printf('lineitem_%03d.parquet', i) END AS file_name,"
    " least(7000, n - i * 7000) AS rows FROM total, range((n + 6999) // 7000) AS t(i)",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = output_dir(spark, "stored")
    export(
        spark,
        f"{folder}/lineitem.parquet",
        "parquet",
        table=file_table(sf_dir, "lineitem"),
        max_rows_per_file=7000,
    )
    written = scan_parquet(spark, f"{folder}/lineitem*.parquet", lineage="file_name")
    return written.groupBy("file_name").agg(F.count(F.lit(1)).alias("rows"))


@catalog.add("split_rows_content", "SELECT * FROM lineitem")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = output_dir(spark, "content")
    export(
        spark,
        f"{folder}/lineitem.parquet",
        "parquet",
        query=f"SELECT * FROM {file_table(sf_dir, 'lineitem')}",
        max_rows_per_file=7000,
        order_by=["l_returnflag"],
    )
    return scan_parquet(spark, f"{folder}/lineitem*.parquet")


def _chained(rows: str, key: str, header: int, limit: int, per_file: int) -> str:
    """SQL that goes through rows (``key``, ``size``) one by one: a full file ends before the next row, whose file counts anew."""
    full = f"held >= {limit} OR taken >= {per_file}"
    return (
        f"WITH RECURSIVE lines AS (SELECT *, row_number() OVER (ORDER BY {key}) AS i FROM ({rows})),"
        f" walk AS (SELECT i, {key}, size, {header} + size AS held, 1::BIGINT AS taken, 0::BIGINT AS f FROM lines WHERE i = 1"
        f" UNION ALL SELECT l.i, l.{key}, l.size, CASE WHEN {full} THEN {header} ELSE held END + l.size,"
        f" CASE WHEN {full} THEN 0 ELSE taken END + 1, CASE WHEN {full} THEN f + 1 ELSE f END"
        f" FROM walk w JOIN lines l ON l.i = w.i + 1)"
    )


@catalog.add(
    "split_bytes_manifest",
    _chained(
        "SELECT o_orderkey, strlen(concat_ws(',', o_orderkey, o_custkey, o_orderstatus, o_orderpriority)) + 1"
        " AS size FROM orders",
        "o_orderkey", 51, 100_000, 1 << 60,
    )
    + f" SELECT {_named('orders', 'csv', 'f')} AS file_name,"
    " CAST(sum(size) + 51 AS BIGINT) AS bytes FROM walk GROUP BY f",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "orders")
    folder = output_dir(spark, "bytes")
    export(
        spark,
        f"{folder}/orders.csv",
        "csv",
        query="SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders",
        max_file_size="100KB",
        order_by=["o_orderkey"],
    )
    return scan_blobs(spark, f"{folder}/*.csv").select(
        F.substring_index("path", "/", -1).alias("file_name"), F.col("length").alias("bytes")
    )


@catalog.add(
    "split_both_manifest",
    _chained(
        "SELECT doc_id, 1 + strlen(concat_ws(',', doc_id, lang,"
        " concat('x', regexp_replace(text, '[^A-Za-z]', '', 'g')))) AS size FROM documents",
        "doc_id", 20, 50_000, 30,
    )
    + f" SELECT {_named('letters', 'csv', 'f')} AS file_name, count(*) AS rows,"
    " min(doc_id) AS first_doc, max(doc_id) AS last_doc,"
    " CAST(sum(size) + 20 AS BIGINT) AS bytes FROM walk GROUP BY f",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    use_tables(spark, sf_dir, "documents")
    folder = output_dir(spark, "both")
    export(
        spark,
        f"{folder}/letters.csv",
        "csv",
        query=_LETTERS_QUERY,
        max_rows_per_file=30,
        max_file_size="50KB",
        order_by=["doc_id"],
    )
    schema = spark.sql(_LETTERS_QUERY).schema
    written = scan_csv(spark, f"{folder}/*.csv", schema=schema)
    return (
        written.select("*", "_metadata.file_name", "_metadata.file_size")
        .groupBy("file_name")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("doc_id").alias("first_doc"),
            F.max("doc_id").alias("last_doc"),
            F.max("file_size").alias("bytes"),
        )
    )


@catalog.add("split_csv_reread", "SELECT * FROM events")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, table = output_dir(spark, "reread"), file_table(sf_dir, "events")
    export(spark, f"{folder}/events.csv", "csv", table=table, max_rows_per_file=900)
    return scan_csv(spark, f"{folder}/events*.csv", schema=spark.table(table).schema)


@catalog.add("split_csv_multiline", "SELECT * FROM documents")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, table = output_dir(spark, "multiline"), file_table(sf_dir, "documents")
    export(spark, f"{folder}/documents.csv", "csv", table=table, max_file_size="200KB")
    return scan_csv(spark, f"{folder}/documents*.csv", schema=spark.table(table).schema)


@catalog.add("split_parquet_bytes", "SELECT * FROM conversations")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, table = output_dir(spark, "sized"), file_table(sf_dir, "conversations")
    export(spark, f"{folder}/talk.parquet", "parquet", table=table, max_file_size="50KB")
    return scan_parquet(spark, f"{folder}/talk*.parquet")


@catalog.add("split_parquet_limit", "SELECT count(*) AS rows, true AS within, true AS in_order FROM documents")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No file is over the limit, although the sizes of texts vary widely; the files follow each other in order."""
    folder, table = output_dir(spark, "limit"), file_table(sf_dir, "documents")
    result = export(
        spark, f"{folder}/d.parquet", "parquet", table=table, max_file_size="150KB", order_by=["doc_id"], compression="zstd"
    )
    per_file = scan_parquet(spark, f"{folder}/d*.parquet", lineage="file_name").groupBy("file_name").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")
    )
    above = F.lag("high").over(Window.orderBy("file_id"))
    found = result.manifest(spark).join(per_file, "file_name").select("n", "rows", "bytes", "low", above.alias("above"))
    return found.agg(
        F.sum("n").alias("rows"),
        (F.max("bytes") <= 150_000).alias("within"),
        F.every((F.col("n") == F.col("rows")) & (F.coalesce("above", F.lit(-1)) < F.col("low"))).alias("in_order"),
    )


@catalog.add("split_upper_bound", "SELECT count(*) AS rows, true AS within FROM lineitem")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = output_dir(spark, "bounded")
    export(
        spark,
        f"{folder}/lineitem.parquet",
        "parquet",
        table=file_table(sf_dir, "lineitem"),
        max_rows_per_file=7000,
        exact=False,
    )
    written = scan_parquet(spark, f"{folder}/lineitem*.parquet", lineage="file_name")
    per_file = written.groupBy("file_name").agg(F.count(F.lit(1)).alias("n"))
    return per_file.agg(
        F.sum("n").alias("rows"), (F.max("n") <= 7000).alias("within")
    )


@catalog.add(
    "export_summary",
    "SELECT count(*) AS total_rows, CAST(ceil(count(*) / 2500.0) AS BIGINT) AS num_files"
    " FROM customer",
)
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{output_dir(spark, 'summary')}/customer.csv"
    table = file_table(sf_dir, "customer")
    result = export(spark, path, "csv", table=table, max_rows_per_file=2500)
    return result.manifest(spark).agg(
        F.sum("rows").alias("total_rows"),
        F.count(F.lit(1)).alias("num_files"),
    )


@catalog.add("export_empty", "SELECT * FROM orders WHERE o_totalprice < 0")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{output_dir(spark, 'empty')}/orders.parquet"
    query = f"SELECT * FROM {file_table(sf_dir, 'orders')} WHERE o_totalprice < 0"
    export(spark, path, "parquet", query=query, max_rows_per_file=10)
    return scan_parquet(spark, path)


@catalog.add("zero_row_schema", "SELECT * FROM lineitem WHERE FALSE")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zero_rows(scan_parquet(spark, table_file(sf_dir, "lineitem")))


@catalog.add("export_json", "SELECT * FROM events")
def _(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = scan_parquet(spark, table_file(sf_dir, "events"))
    path = f"{output_dir(spark, 'json')}/events.json"
    export_json(events, path)
    return spark.read.schema(events.schema).json(path)
