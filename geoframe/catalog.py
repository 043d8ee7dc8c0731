"""Register of queries and of the SQL that states their results."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Registers a function of (spark, sf_dir) under a name, with DuckDB SQL for its rows where SQL can express them."""

    def add(function: Callable[[SparkSession, str], DataFrame]) -> Callable:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
