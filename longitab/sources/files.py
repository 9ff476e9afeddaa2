"""Instrument files: inventory of names, and contents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.recode import _c
from ..functions.text import split_item


def list_files(spark: SparkSession, path: str, name_pattern: str = r".txt",
               exclude_dirs: str | None = None) -> DataFrame:
    """Files below ``path`` whose name matches; contents are not read."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select(F.col("path").alias("file"))
    )
    return inventory(found, "file", name_pattern, exclude_dirs)


def inventory(paths: DataFrame, col: str, name_pattern: str, exclude_dirs: str | None = None) -> DataFrame:
    """Add ``dir``; keep base names that match and folders that do not."""
    df = paths.withColumn("dir", F.regexp_extract(col, r"(?s)^(.*)/[^/]*$", 1))
    df = df.filter(F.regexp_extract(col, r"(?s)([^/]*)$", 1).rlike(name_pattern))
    return df.filter(~F.col("dir").rlike(exclude_dirs)) if exclude_dirs else df


def read_whole(spark: SparkSession, path: str) -> DataFrame:
    """(file, text), one row per file."""
    return (
        spark.read.option("recursiveFileLookup", True).text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    )


def lines(text: Column | str) -> Column:
    return F.split(_c(text), r"\r\n|\n|\r")


def first_line(text: Column | str) -> Column:
    return F.get(lines(text), F.lit(0))


def with_names(df: DataFrame, text: str = "text", sep: str = ", ") -> DataFrame:
    """``name`` is the first line, cut into ``surname`` and ``firstname``."""
    df = df.withColumn("name", first_line(text))
    return df.withColumns({"surname": split_item("name", sep, 1), "firstname": split_item("name", sep, 2)})


def extremes(df: DataFrame, text: str = "text", field: str = "N.M", skip: int = 5,
             high: str = "quad", low: str = "hs") -> DataFrame:
    """Largest value and absolute smallest value of one field of a text table.

    The text has ``skip`` lines, then a white-space separated header, then
    rows.  A file without that header field, or with something else than
    numbers in it, is dropped; a missing number makes both results null.  The
    columns other than ``text`` identify the file.

    All of it is one projection: a file's lines are folded where its row is, so
    nothing is exploded or shuffled.
    """
    rest = [c for c in df.columns if c != text]
    first = F.lit(int(skip) + 1)

    def numbers(table: Column, at: Column) -> Column:
        raw = F.transform(F.slice(table, F.lit(2), F.size(table)), lambda s: F.nullif(F.get(_fields(s), at - 1), F.lit("NA")))
        return _let(raw, lambda r: F.struct(
            at.alias("at"), F.size(r).alias("n"), F.size(F.array_compact(r)).alias("known"),
            F.array_compact(F.transform(r, lambda v: v.try_cast("double"))).alias("num")))

    def folded(table: Column) -> Column:
        header = F.transform(_fields(F.get(table, F.lit(0))), lambda h: F.regexp_replace(h, r"[^\w.]", "."))
        return _let(F.array_position(header, field).cast("int"), lambda at: numbers(table, at))

    table = _let(lines(text), lambda all_: F.filter(F.slice(all_, first, F.size(all_)), lambda s: F.trim(s) != ""))
    # a filter on a row number stays above it; below, it would fold all lines once more
    found = df.select(*rest, _let(table, folded).alias("__found"), F.monotonically_increasing_id().alias("__row"))
    n, known, num = (F.col(f"__found.{c}") for c in ("n", "known", "num"))
    return found.filter((F.col("__row") >= 0) & (F.col("__found.at") > 0) & (known == F.size(num))).select(
        *rest,
        F.when(n == 0, F.lit(float("-inf"))).when(known == n, F.array_max(num)).alias(high),
        F.when(n == 0, F.lit(float("inf"))).when(known == n, F.abs(F.array_min(num))).alias(low))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, wherever it stands."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _fields(line: Column) -> Column:
    return F.split(F.trim(F.replace(line, F.lit("\t"), F.lit(" "))), " +")
