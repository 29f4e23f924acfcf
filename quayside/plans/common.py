"""Shared pieces of the registered queries."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quayside.storage import HadoopFiles, scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


class Catalog:
    """Queries by key, with the reference SQL of those that SQL can express."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, key: str, oracle: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            if key in self.queries:
                raise ValueError(f"query registered twice: {key}")
            self.queries[key] = query
            if oracle is not None:
                self.oracles[key] = oracle
            return query

        return register

    def add_sql(self, key: str, sql: str, *tables: str) -> None:
        """A query whose text runs unchanged on both engines."""

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            use_tables(spark, sf_dir, *tables)
            return spark.sql(sql)

        self.add(key, sql)(run)


def table_file(sf_dir: str, name: str) -> str:
    return f"{sf_dir}/{name}.parquet"


def file_table(sf_dir: str, name: str) -> str:
    """The table as Spark names a Parquet file in SQL."""
    return f"parquet.`{table_file(sf_dir, name)}`"


def use_tables(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        spark.read.parquet(table_file(sf_dir, name)).createOrReplaceTempView(name)


def output_dir(spark: SparkSession, label: str) -> str:
    """A new directory for the files of one query."""
    directory = scratch_dir(spark, label)
    HadoopFiles(spark).make_dirs(directory)
    return directory


def table_name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex[:12]}"
