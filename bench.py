"""Time the headline operators and print one JSON line.

Environment: BENCH_SF_DIR (tables, default /root/testdata/sf0.1) and BENCH_CPUS.
Each operator runs once unmeasured and then BENCH_RUNS times; the best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from quayside.functions.sqltext import classify, split_statements
from quayside.operators.dml import merge
from quayside.operators.export import PARQUET_CODECS, export
from quayside.operators.load import load
from quayside.plans.common import file_table, output_dir, table_file, table_name, use_tables
from quayside.plans.passthrough import catalog as passthrough
from quayside.plans.scripts import LOG
from quayside.sources.scan import scan_csv


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def benchmarks(spark: SparkSession, sf_dir: str) -> dict:
    """Operator name to a callable that does the whole work once."""
    lineitem, orders = file_table(sf_dir, "lineitem"), file_table(sf_dir, "orders")
    documents = file_table(sf_dir, "documents")
    shared = output_dir(spark, "bench")
    export(spark, f"{shared}/lineitem.csv", "csv", table=lineitem)
    export(spark, f"{shared}/orders.csv", "csv", table=orders)
    schema = spark.read.parquet(table_file(sf_dir, "lineitem")).schema

    def out(name: str) -> str:
        return f"{output_dir(spark, 'bench')}/{name}"

    def loaded() -> str:
        name = table_name("bench")
        load(spark, f"{shared}/orders.csv", name, location=out("table"))
        return name

    def merged() -> None:
        changes = spark.table(orders).where("o_orderpriority = '5-LOW' AND o_orderstatus = 'F'")
        merge(spark, target, changes, ["o_orderkey"], update={"o_custkey": "s.o_custkey + 1"})

    def log() -> None:
        use_tables(spark, sf_dir, "orders", "pages")
        statement = F.explode(split_statements(F.col("script"))).alias("statement")
        kinds = spark.sql(LOG).select(statement).select(classify(F.col("statement")).alias("k"))
        consume(kinds.groupBy("k").count())

    target = loaded()
    named = {
        "scan_csv": lambda: consume(scan_csv(spark, f"{shared}/lineitem.csv", schema=schema)),
        "scan_csv_inferred": lambda: consume(scan_csv(spark, f"{shared}/lineitem.csv")),
        "export_csv": lambda: export(spark, out("l.csv"), "csv", table=lineitem),
        **{
            f"export_parquet_{codec}": lambda codec=codec: export(
                spark, out("l.parquet"), "parquet", table=lineitem, compression=codec
            )
            for codec in PARQUET_CODECS
        },
        "split_rows_exact": lambda: export(
            spark, out("l.parquet"), "parquet", table=lineitem, max_rows_per_file=50_000
        ),
        "split_rows_upper_bound": lambda: export(
            spark, out("l.parquet"), "parquet", table=lineitem, max_rows_per_file=50_000, exact=False
        ),
        "split_rows_ordered": lambda: export(
            spark, out("l.parquet"), "parquet", table=lineitem, max_rows_per_file=50_000,
            order_by=["l_shipdate"],
        ),
        "export_csv_orders": lambda: export(spark, out("o.csv"), "csv", table=orders),
        "split_bytes_csv": lambda: export(
            spark, out("o.csv"), "csv", table=orders, max_file_size="1MB"
        ),
        "split_both_csv": lambda: export(
            spark, out("o.csv"), "csv", table=orders, max_file_size="1MB", max_rows_per_file=10_000
        ),
        "split_bytes_parquet": lambda: export(
            spark, out("d.parquet"), "parquet", table=documents, max_file_size="1MB"
        ),
        "load_autocreate": loaded,
        "dml_merge": merged,
        "log_split_classify": log,
    }
    for key in ("sql_filter", "pt_join_inner", "pt_group_by", "pt_window", "pt_order_top_k"):
        named[key] = lambda key=key: consume(passthrough.queries[key](spark, sf_dir))
    return named


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    spark = session(os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8)))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times = {}
    named = benchmarks(spark, sf_dir)
    for name in sys.argv[1:] or named:
        run, best = named[name], float("inf")
        run()
        for _ in range(runs):
            start = time.perf_counter()
            run()
            best = min(best, time.perf_counter() - start)
        times[name] = round(best, 3)
    report = {
        "metric": "total_operator_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": sf_dir.rpartition("sf")[2],
    }
    spark.stop()
    print(json.dumps(report), flush=True)


if __name__ == "__main__":
    main()
