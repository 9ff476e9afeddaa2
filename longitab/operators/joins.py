"""Joins.

None of them hints a broadcast.  Spark broadcasts a side when its size is
under ``spark.sql.autoBroadcastJoinThreshold``, checks again at run time (AQE),
and otherwise shuffles; AQE then splits partitions that a hot key has made
too large, which it can do on the row-preserving side of left, semi and anti
joins.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _null_safe(x: DataFrame, y: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``y`` with its keys renamed, and the condition under which null meets null."""
    y = y.withColumnsRenamed({k: f"__right_{k}" for k in keys})
    return y, reduce(and_, [F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys])


def left_join(x: DataFrame, y: DataFrame, on: str | Sequence[str], null_safe: bool = False,
              unique: bool = False) -> DataFrame:
    """Left join; a key repeated on the right multiplies rows.

    ``unique`` makes that an error at run time instead.
    """
    keys = _keys(on)
    if unique:
        y = assert_unique(y, keys)
    if not null_safe:
        return x.join(y, keys, "left")
    y, cond = _null_safe(x, y, keys)
    return x.join(y, cond, "left").drop(*[f"__right_{k}" for k in keys])


def full_join(x: DataFrame, y: DataFrame, on: str | Sequence[str], null_safe: bool = False) -> DataFrame:
    """Full join with the key columns coalesced.

    Spark cannot split a hot key of a full join: collapse or aggregate both
    sides to the key first, as the plans here do, or use ``full_join_split``.
    """
    keys = _keys(on)
    if not null_safe:
        return x.join(y, keys, "full")
    rest_x = [c for c in x.columns if c not in keys]
    rest_y = [c for c in y.columns if c not in keys]
    y, cond = _null_safe(x, y, keys)
    both = x.withColumn("__hit", F.lit(True)).join(y, cond, "full")
    merged = [
        F.when(F.col("__hit").isNull(), F.col(f"__right_{k}")).otherwise(F.col(k)).alias(k)
        for k in keys
    ]
    return both.select(*merged, *rest_x, *rest_y)


def full_join_split(x: DataFrame, y: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Full join as left join plus the unmatched right rows, for skewed keys.

    It shuffles both sides twice, but AQE can split a hot key in either half.
    """
    keys = _keys(on)
    lonely = y.join(x.select(*keys), keys, "left_anti")
    return x.join(y, keys, "left").unionByName(lonely, allowMissingColumns=True)


def semi_join(x: DataFrame, y: DataFrame, on: str | Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``x`` whose key occurs in ``y``."""
    return _filter_join(x, y, on, null_safe, "left_semi")


def anti_join(x: DataFrame, y: DataFrame, on: str | Sequence[str], null_safe: bool = False) -> DataFrame:
    """Rows of ``x`` whose key does not occur in ``y``."""
    return _filter_join(x, y, on, null_safe, "left_anti")


def _filter_join(x, y, on, null_safe, how):
    keys = _keys(on)
    y = y.select(*keys)
    if not null_safe:
        return x.join(y, keys, how)
    y, cond = _null_safe(x, y, keys)
    return x.join(y, cond, how)


def join_suffixed(x: DataFrame, y: DataFrame, on: str | Sequence[str],
                  suffixes: tuple[str, str] = (".x", ".y"), how: str = "left") -> DataFrame:
    """Join where columns other than the keys that clash get a suffix per side."""
    keys = _keys(on)
    clash = [c for c in x.columns if c in y.columns and c not in keys]
    x = x.withColumnsRenamed({c: c + suffixes[0] for c in clash})
    y = y.withColumnsRenamed({c: c + suffixes[1] for c in clash})
    return x.join(y, keys, how)


def enrich(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str | None = None) -> DataFrame:
    """Attach the columns of a lookup table by value, never by row position."""
    lookup = lookup.withColumnRenamed(lookup_key or key, key)
    return left_join(df, lookup, key)


def attach_from(df: DataFrame, by: str, when: Column,
                derive: dict[str, Column]) -> DataFrame:
    """Derive values on the rows that meet ``when``; give them to every row of the id."""
    source = df.filter(when).select(by, *[e.alias(n) for n, e in derive.items()])
    return left_join(df, source, by)


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same rows, but the job fails if a key occurs twice."""
    rest = [c for c in df.columns if c not in keys]
    one = df.groupBy(*keys).agg(
        F.count("*").alias("__n"),
        *([F.any_value(F.struct(*rest)).alias("__row")] if rest else []),
    )
    checked = F.when(F.col("__n") > 1, F.raise_error(F.lit(f"duplicate key in {list(keys)}")))
    return one.filter(checked.isNull()).select(*keys, *(["__row.*"] if rest else []))
