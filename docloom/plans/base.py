"""Registration of queries with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable:
    """Registers a function (t) -> DataFrame under its name; t(name) reads a table."""

    def register(build: Callable) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"))

        QUERIES[build.__name__] = run
        if sql:
            ORACLE[build.__name__] = sql
        return build

    return register
