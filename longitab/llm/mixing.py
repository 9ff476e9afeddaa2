"""Mixing sources to target weights by histograms of hash thresholds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from longitab.session import stage, unstage

#: Hex digits of the document's 48-bit hash that each histogram level reads.
DIGITS = 3
LEVELS = 4
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def ranked(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 in code point order, null last, without one task for all:
    sources are dealt by range, and each range starts after the rows before it."""
    dealt = stage(
        sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("_part", F.spark_partition_id()))
    parts = dealt.groupBy("_part").count()
    starts = parts.select("_part", (F.sum("count").over(Window.orderBy("_part")) - F.col("count")).alias("_start"))
    within = Window.partitionBy("_part").orderBy(F.col("source").asc_nulls_last())
    return (
        dealt.join(starts, "_part")
        .withColumn("rank", F.row_number().over(within) - 1 + F.col("_start"))
        .drop("_part", "_start")
    )


def targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), most: float = 3.0) -> DataFrame:
    """``(source, source_size)`` to ``(source, source_size, target)``.

    The sources share the sum of all sizes by weight (the weights repeat over
    the sources in code point order, null last).  A target stops at ``most``
    times its source's size; the excess is shared again by weight until no
    target is above.  Each round reads two sums; a source once capped stays so.
    Sources of size 0 get 0.
    """
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = stage(ranked(sizes).select("source", "source_size", weight.alias("weight")))
    cap = F.col("source_size") * F.lit(float(most))
    total = table.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    while True:
        capped = F.col("weight") * level >= cap
        free = table.agg(
            F.sum(F.when(capped, cap).otherwise(0.0)).alias("held"),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        after = (total - free["held"]) / free["weight"] if free["weight"] else level
        if after <= level:
            return table.select("source", "source_size", F.least(cap, F.col("weight") * level).alias("target"))
        level = after


def _hash(docs: DataFrame, id_col: str, text_col: str, seed: str) -> Column:
    text = F.md5(F.coalesce(docs[text_col], F.lit("")).cast("binary"))
    name = F.concat_ws("|", F.lit(seed), F.coalesce(docs[id_col].cast("string"), F.lit("")), text)
    return F.substring(F.md5(name.cast("binary")), 1, DIGITS * LEVELS)


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def thresholds(rows: DataFrame, weights: Sequence[float], most: float) -> DataFrame:
    """``(source, size, hash)`` to one row per source: ``source_size``,
    ``target``, whole ``passes``, and the hashes of the last, partial pass: all
    ``below`` one and the one ``at`` the boundary, if any."""
    # The first histogram also gives the sources' sizes.
    first = stage(rows.groupBy("source", F.substring("hash", 1, DIGITS).alias("bucket")).agg(F.sum("size").alias("words")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    goal = stage(
        targets(first.groupBy("source").agg(F.sum("words").alias("source_size")), weights, most).withColumn("passes", passes))
    rest = F.col("target") - F.col("passes") * F.col("source_size")
    cut = goal.select(F.col("source").alias("s"), rest.alias("missing"))
    bins = first
    for level in range(1, LEVELS + 1):
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        left = F.col("missing") - F.col("upto") + F.col("words")
        edge = F.struct("bucket", left.alias("missing"), "words")  # the first bucket that passes what is missing
        cut = stage(
            bins.withColumn("upto", upto).join(cut.select("s", "missing"), _same("source", "s"))
            .where(F.col("upto") > F.col("missing")).groupBy(F.col("source").alias("s")).agg(F.min(edge).alias("edge"))
            .select("s", "edge.*"))
        if level < LEVELS:
            inside = _same("source", "s") & (F.substring("hash", 1, DIGITS * level) == F.col("bucket"))
            bins = rows.join(cut.select("s", "bucket"), inside).groupBy(
                "source", F.substring("hash", 1, DIGITS * (level + 1)).alias("bucket")).agg(F.sum("size").alias("words"))
    # One hash is left at the boundary: it is taken if that brings the sum nearer.
    at = F.when(F.col("missing") * 2 >= F.col("words"), F.col("bucket"))
    out = stage(goal.join(cut.select("s", F.col("bucket").alias("below"), at.alias("at")), _same("source", "s"), "left").drop("s"))
    unstage(first, goal, cut)
    return out


def _copies(has_words: Column) -> Column:
    extra = ((F.col("hash") < F.col("below")) | F.col("hash").eqNullSafe(F.col("at"))) & has_words
    return F.col("passes") + F.coalesce(extra, F.lit(False)).cast("long")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    most: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
) -> DataFrame:
    """How often to take each document so that the sources meet their targets.

    Returns ``(<id>, source, size, source_size, target, copies, taken)``, one
    row per input row.  A source whose target is q whole passes and a rest
    takes all its documents q times, and once more those whose hash lies below
    a threshold.  Budgets are nested: what a smaller mix takes, a larger takes.

    The threshold comes from histograms: words by source and 12 bits of hash,
    of which only the boundary bucket is split by the next 12 bits, and so on
    for 4 levels.  No document is sorted.

    Null texts and texts without words have size 0, change no sum and are taken
    once for each whole pass, so never more than ``most`` times.  A null
    source is a source of its own.  Rows alike in id and text share one hash
    and so one decision.  Other columns are ignored.  No rows give no rows.
    """
    rows = stage(docs.select(
        docs[id_col].alias("id"), docs[source_col].alias("source"), word_count(docs[text_col]).alias("size"),
        _hash(docs, id_col, text_col, seed).alias("hash")))
    goal = thresholds(rows, weights, most).withColumnRenamed("source", "s")
    return rows.join(goal, _same("source", "s")).withColumn("copies", _copies(F.col("size") > 0)).select(
        F.col("id").alias(id_col), "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(
    docs: DataFrame,
    weights: Sequence[float] = (1, 2, 3),
    most: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
) -> DataFrame:
    """The documents with their own columns, each repeated as ``mix`` says; see there."""
    keyed = docs.select(
        F.struct("*").alias("row"), docs[source_col].alias("source"), _hash(docs, id_col, text_col, seed).alias("hash"),
        F.coalesce(docs[text_col].rlike(WORD), F.lit(False)).alias("has_words"))
    rows = stage(docs.select(
        docs[source_col].alias("source"), word_count(docs[text_col]).alias("size"), _hash(docs, id_col, text_col, seed).alias("hash")))
    goal = thresholds(rows, weights, most).withColumnRenamed("source", "s")
    unstage(rows)
    taken = keyed.join(goal, _same("source", "s")).withColumn("copies", _copies(F.col("has_words"))).where("copies > 0")
    return taken.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")
