"""Registry of queries over the test tables: a Spark callable and, where possible, its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chartmill.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``function(read, spark)``, where ``read(table)`` gives a test table."""

    def register(function):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return function(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"), spark)

        run.__name__ = name
        run.__doc__ = function.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register
