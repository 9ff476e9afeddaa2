"""CSV scans and sinks with explicit null rules."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .records import largest_file, read_records

#: A file above this is read by several tasks, also where quoted fields hold line breaks.
SPLIT_BYTES = 128 << 20
OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}


def _schema(spark: SparkSession, path: str, schema: str | T.StructType | None, multiline: bool) -> T.StructType:
    if isinstance(schema, T.StructType):
        return schema
    if schema is not None:
        return T.StructType.fromDDL(schema)
    # No schema given: the header's names, everything text.
    return spark.read.csv(path, header=True, multiLine=multiline).schema


def _raw(spark: SparkSession, path: str, wanted: T.StructType, multiline: bool, split_bytes: int,
         by_name: bool = False) -> tuple[DataFrame, Column]:
    """All fields as text, and the expression of the row order within a file, or over all files by name."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in wanted])
    if not by_name and (not multiline or largest_file(spark, path) <= split_bytes):
        raw = spark.read.schema(as_text).csv(
            path, header=True, enforceSchema=False, multiLine=multiline, quote='"', escape='"', encoding="UTF-8")
        return raw, F.monotonically_increasing_id()
    names = _schema(spark, path, None, True).names
    if [n.lower() for n in names] != [f.name.lower() for f in wanted]:
        raise ValueError(f"the header has {names}, the schema {wanted.names}")
    ddl = ", ".join(f"`{f.name.replace('`', '``')}` STRING" for f in wanted)
    records = read_records(spark, path, by_name).where("number > 0")
    number = F.col("number") + F.col("before") if by_name else F.col("number")
    parsed = records.select(number.alias("number"), F.from_csv("record", F.lit(ddl), OPTIONS).alias("fields"))
    return parsed.select("fields.*", F.col("number").alias("__number")), F.col("__number") - 1


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
             nulls: Sequence[str] = ("",), multiline: bool = True, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """CSV with a header; a field equal to one of ``nulls`` is null, quoted or not.

    All fields are read as text, matched with ``nulls``, then cast, so that a
    null token in a number column is a null and not a bad row.  A field that
    does not parse as its type becomes null; ``read_checked`` reports those.

    Quoted fields may hold line breaks.  Files of up to ``split_bytes`` are one
    task each, larger ones are cut (see ``records``).  ``multiline=False`` cuts
    any file; it is right only where no field holds a line break.
    """
    wanted = _schema(spark, path, schema, multiline)
    raw, _ = _raw(spark, path, wanted, multiline, split_bytes)
    return raw.select(*[_typed(f, nulls) for f in wanted])


class Checked(NamedTuple):
    """What a checked read gives: the table, each field that did not parse, and their number by column."""
    table: DataFrame
    rejects: DataFrame
    counts: dict[str, int]


def read_checked(spark: SparkSession, path: str, schema: str | T.StructType, nulls: Sequence[str] = ("",),
                 multiline: bool = True, split_bytes: int = SPLIT_BYTES, order: Column | None = None,
                 by_name: bool = False) -> Checked:
    """``read_export`` that also tells what did not parse.

    The files are read once, as text, and staged.  ``table`` has ``seq`` and the
    typed columns; ``rejects`` has ``(seq, column, text)`` of each field that is
    no null token and not of its column's type; ``counts`` is their number by
    column, observed while the texts are staged.
    """
    wanted = _schema(spark, path, schema, multiline)
    raw, number = _raw(spark, path, wanted, multiline, split_bytes, by_name)
    texts = raw.select(*[F.col(_name(f)).alias(f"__text_{k}") for k, f in enumerate(wanted)],
                       _number(spark, path, order, number, by_name).alias("__number"))
    typed = {f.name: (f, F.col(f"__text_{k}")) for k, f in enumerate(wanted) if not isinstance(f.dataType, T.StringType)}
    bad = {name: F.coalesce(~t.isin(*nulls), F.lit(False)) & _typed(f, nulls, t).isNull() for name, (f, t) in typed.items()}
    seen = Observation()
    # observed while the texts are staged, which happens once
    texts = stage(texts.observe(seen, *[F.count_if(b).alias(name) for name, b in bad.items()]) if bad else texts)
    checked = texts.select("*", *[_typed(f, nulls, F.col(f"__text_{k}")) for k, f in enumerate(wanted)]).withColumn(
        "seq", F.col("__number") if order is None else order.cast("bigint"))
    fields = [F.when(b, F.struct(F.lit(name).alias("column"), typed[name][1].alias("text"))) for name, b in bad.items()]
    found = F.array_compact(F.array(*fields)) if fields else F.array().cast("array<struct<column:string,text:string>>")
    rejects = checked.select("seq", F.explode(found).alias("field")).select("seq", "field.column", "field.text")
    return Checked(checked.select("seq", *[F.col(_name(f)) for f in wanted]), rejects, seen.get if bad else {})


def _name(field: T.StructField) -> str:
    return "`" + field.name.replace("`", "``") + "`"


def _number(spark: SparkSession, path: str, order: Column | None, number: Column, by_name: bool) -> Column:
    """The row order within the file, or the files by name, if that is the order asked for."""
    if order is None and not by_name and len(files := spark.read.format("binaryFile").load(path).inputFiles()) > 1:
        raise ValueError(f"{len(files)} files have no common row order: pass order=")
    return number.cast("bigint")


def _typed(field: T.StructField, nulls: Sequence[str], text: Column | None = None) -> Column:
    text = F.col(_name(field)) if text is None else text
    value = F.when(~text.isin(*nulls), text)
    if not isinstance(field.dataType, T.StringType):
        value = value.try_cast(field.dataType)
    return value.alias(field.name)


def read_export(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
                order: Column | None = None, multiline: bool = True, split_bytes: int = SPLIT_BYTES,
                by_name: bool = False) -> DataFrame:
    """The sparse long export: only blank is null, and ``seq`` holds the row order.

    Spark keeps no order between files, so an export in several files needs
    ``order``, an integer expression unique per row, or ``by_name``: the files,
    each with its header, are parts that follow each other by name.  Within one
    file, or these, the row number comes from the scan, however many tasks read
    it; parts by name are always cut, whatever ``split_bytes``.
    """
    wanted = _schema(spark, path, schema, multiline)
    raw, number = _raw(spark, path, wanted, multiline, split_bytes, by_name)
    df = raw.select(*[_typed(f, ("",)) for f in wanted], _number(spark, path, order, number, by_name).alias("seq"))
    return df if order is None else df.withColumn("seq", order.cast("bigint"))


def read_table(spark: SparkSession, path: str, schema: str | T.StructType | None = None,
               multiline: bool = True) -> DataFrame:
    """CSV where blank and ``NA`` both are null."""
    return read_csv(spark, path, schema, ("", "NA"), multiline)


def write_csv(df: DataFrame, path: str, null: str = "NA", mode: str = "errorifexists") -> None:
    """CSV with a header and ISO dates; ``null`` is written for missing values."""
    stamp = "yyyy-MM-dd HH:mm:ss"
    df.write.mode(mode).option("timestampNTZFormat", stamp).csv(
        path, header=True, nullValue=null, emptyValue="", quote='"', escape='"',
        dateFormat="yyyy-MM-dd", timestampFormat=stamp, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )
