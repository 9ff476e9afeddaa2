"""Row filters and sorts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.recode import rank_of
from .joins import semi_join


def drop_all_missing(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop the rows where every one of ``cols`` is null."""
    return df.filter(reduce(or_, [F.col(c).isNotNull() for c in cols]))


def groups_of_size(df: DataFrame, by: Sequence[str], size: int, order: str) -> DataFrame:
    """Keep the rows of groups that have exactly ``size`` rows.

    A group is cut to ``size + 1`` rows first, which is all it takes to know
    that it is too big.  Spark applies that limit before the shuffle as well,
    so a group that holds a third of the table costs ``size + 1`` rows per
    map task.  It does so up to a size set by
    ``spark.sql.optimizer.windowGroupLimitThreshold``; beyond that, the groups
    are counted (combined before the shuffle) and the rows looked up.
    """
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if size >= limit:
        sizes = df.groupBy(*by).agg(F.count("*").alias("__n")).filter(F.col("__n") == size)
        return semi_join(df, sizes, by, null_safe=True)
    group = W.partitionBy(*by)
    few = (
        df.withColumn("__rn", F.row_number().over(group.orderBy(order)))
        .filter(F.col("__rn") <= size + 1)
    )
    sized = few.withColumn("__n", F.count("*").over(group))
    return sized.filter(F.col("__n") == size).drop("__rn", "__n")


def first_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first whole row of each group; nulls sort last.

    ``order`` has to end in something unique within the group.  The
    ``row_number() = 1`` form lets Spark keep one row per group and map task
    before it shuffles, so hot groups stay cheap.
    """
    keys = [F.asc_nulls_last(o) if isinstance(o, str) else o for o in order]
    top = F.row_number().over(W.partitionBy(*by).orderBy(*keys))
    return df.withColumn("__rn", top).filter(F.col("__rn") == 1).drop("__rn")


def distinct_first(df: DataFrame, by: Sequence[str], key: str, order: Sequence[str]) -> DataFrame:
    """Distinct ``key`` within each group, keeping the earliest whole row."""
    return first_per_group(df, [*by, key], order)


def sort_by_level(df: DataFrame, first: Sequence[str], label: str, levels: Sequence[str],
                  order: str) -> DataFrame:
    """Global sort by keys, then by the rank of a label, then by row order.

    The row order as last key also lets the range partitioner cut through a
    key that holds a large share of the rows.
    """
    keys = [F.asc_nulls_last(c) for c in first]
    return df.orderBy(*keys, rank_of(label, levels).asc_nulls_last(), F.asc_nulls_last(order))
