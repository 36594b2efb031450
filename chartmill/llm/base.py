"""Registry of the queries of this subpackage, and what several operators need."""

from __future__ import annotations

import ctypes
import functools
import inspect
import os
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from chartmill.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]
# Rows a task hands to Python at a time.  Texts can be long, and a batch is held several times over.
BATCH_ROWS = 1000

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL twin where SQL can express it."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def shielded(*reads: str, adds: tuple[str, ...] = ()) -> Callable:
    """Decorate an operator on ``docs`` so that columns it does not read may be called anything.

    ``reads`` and ``adds`` name the parameters that hold the names of columns it reads and adds, or such
    columns themselves.  All other columns are out of the way under names no operator uses while it
    runs; one that is called like an added column is replaced by that.
    """

    def wrap(operator: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        signature = inspect.signature(operator)

        @functools.wraps(operator)
        def run(*args, **options) -> DataFrame:
            bound = signature.bind(*args, **options)
            bound.apply_defaults()
            first = next(iter(signature.parameters))
            docs = bound.arguments[first]

            def columns(parameters: tuple[str, ...]) -> set[str]:
                values = [bound.arguments[p] if p in signature.parameters else p for p in parameters]
                return {name for v in values for name in ([v] if isinstance(v, str) else v or ())}

            others = [c for c in docs.columns if c not in columns(reads)]
            replaced = [c for c in others if c in columns(adds)]
            mark = "other"
            while any(c.startswith(mark) for c in docs.columns):
                mark += "_"
            away = {c: f"{mark}{i}" for i, c in enumerate(others) if c not in replaced}
            bound.arguments[first] = docs.drop(*replaced).withColumnsRenamed(away)
            return operator(*bound.args, **bound.kwargs).withColumnsRenamed({new: old for old, new in away.items()})

        return run

    return wrap


def give_back() -> None:
    """Hand freed memory back to the system at the end of a task: its Python worker lives on beside others."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared scratch folder and read it back.

    What follows starts from files that outlive any executor, and is not computed twice.
    """
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
