"""Registered queries and the SQL that has to give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a ``(load) -> DataFrame`` function under its own name.

    ``load(table)`` scans one of the given parquet tables.
    """
    def add(fn):
        key = name or fn.__name__

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(lambda table: spark.read.parquet(f"{sf_dir}/{table}.parquet"))

        run.__name__ = key
        run.__doc__ = fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            SQL[key] = sql
        return fn

    return add
