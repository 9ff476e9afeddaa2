"""A bundle: several named tables in one folder, one dataset per table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .delimited import read_csv, write_csv


def write_bundle(tables: Mapping[str, DataFrame], folder: str, fmt: str = "csv", null: str = "NA",
                 only: Sequence[str] | None = None, mode: str = "errorifexists") -> list[str]:
    """Write the tables (or ``only`` some of them); returns the names written."""
    names = [n for n in tables if only is None or n in only]
    for name in names:
        target = f"{folder}/{name}"
        if fmt == "csv":
            write_csv(tables[name], target, null, mode)
        else:
            tables[name].write.mode(mode).format(fmt).save(target)
    return names


def read_bundle(spark: SparkSession, folder: str, name: str, fmt: str = "csv",
                schema: str | T.StructType | None = None, null: str = "NA") -> DataFrame:
    """One table of a bundle; in CSV the ``null`` token and blank are null."""
    path = f"{folder}/{name}"
    if fmt == "csv":
        return read_csv(spark, path, schema, ("", null))
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.format(fmt).load(path)
