"""Records of CSV files whose quoted fields hold line breaks, read in parallel.

A file is cut into splits at line ends, wherever a quoted field stands.  Whether
a line begins a record depends on the number of quotes before it, which is known
once each split has counted its own: even, and it begins one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage

QUOTE = '"'


def _bare(line: Column) -> Column:
    """Without the carriage return at its end."""
    return F.regexp_replace(line, "\r\\z", "")


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, split, at, line)``: the split's first byte, and the order of its lines."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def read_records(spark: SparkSession, path: str, by_name: bool = False) -> DataFrame:
    """``(file, number, record)`` of each record, the header being number 0; staged.

    ``by_name`` adds ``before``, how many records but headers the files hold
    whose names come first.

    Quotes are doubled inside quoted fields, so they count as two.  The lines
    are shuffled once, by split; a split's quotes and records are summed, and
    the sums of a file's splits, one row each, say where each split stands.
    Only records of several lines are shuffled again.  A record may end in a
    carriage return and a line feed; then such a break inside its fields becomes
    a line feed, as Spark's own reader has it.  Other breaks stay as they are.
    Empty records have no number and are left out.
    """
    quotes = F.length("line") - F.length(F.replace("line", F.lit(QUOTE), F.lit("")))
    split = W.partitionBy("file", "split")
    so_far = split.orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    odd = F.coalesce(F.sum(quotes).over(so_far), F.lit(0)) % 2
    lines = stage(_lines(spark, path).select("file", "split", "at", "line", (quotes % 2).alias("q"), odd.alias("odd")))
    # what a split adds, for either state it may begin in: an empty line is a record's only if inside a quoted field
    full = _bare(F.col("line")) != ""
    starts = {state: F.count_if((F.col("odd") == state) & full) for state in (0, 1)}
    splits = lines.groupBy("file", "split").agg((F.sum("q") % 2).alias("turn"), *[n.alias(f"n{s}") for s, n in starts.items()])
    before = W.partitionBy("file").orderBy("split").rowsBetween(W.unboundedPreceding, -1)
    states = splits.withColumn("state", F.coalesce(F.sum("turn").over(before), F.lit(0)) % 2)
    mine = F.when(F.col("state") == 0, F.col("n0")).otherwise(F.col("n1"))
    states = states.withColumn("mine", mine).withColumn("first", F.coalesce(F.sum("mine").over(before), F.lit(0)))
    if by_name:  # one row per file
        states = stage(states)
        held = states.groupBy("file").agg(F.greatest(F.sum("mine") - 1, F.lit(0)).alias("held"))
        earlier = held.select("file", (F.sum("held").over(W.orderBy("file")) - F.col("held")).alias("before"))
    states = states.select("file", "split", "state", "first")

    begins = (F.col("odd") == F.col("state")) & full
    number = F.col("first") + F.sum(begins.cast("int")).over(split.orderBy("at").rowsBetween(W.unboundedPreceding, W.currentRow)) - 1
    inside = F.col("odd") != F.col("state")
    numbered = lines.join(states, ["file", "split"]).select(
        "file", "split", "at", "line", number.alias("number"), inside.alias("inside"), ((F.col("q") == 0) & ~inside).alias("whole"), full.alias("full"))
    numbered = stage(numbered.where("full or inside"))
    whole = numbered.where("whole").select("file", "number", "line")
    parts = numbered.where("not whole").groupBy("file", "number").agg(F.array_sort(F.collect_list(F.struct("split", "at", "line"))).alias("lines"))
    wide = F.element_at("lines", -1)["line"].endswith("\r")  # such ends are line breaks, inside a field too
    texts = F.transform("lines", lambda x: F.when(wide, _bare(x["line"])).otherwise(x["line"]))
    joined = parts.select("file", "number", F.array_join(texts, "\n").alias("line"))
    records = whole.unionByName(joined).select("file", "number", _bare(F.col("line")).alias("record"))
    return records.join(earlier, "file") if by_name else records


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file; contents are not read."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0
