"""First-non-null collapse of several rows into one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_value(col: str, order: str) -> Column:
    """Aggregate: the first non-null value by row order, null if there is none.

    ``min_by`` skips rows whose ordering value is null.  Unlike ``first`` it
    does not depend on how rows reach the task, and it combines before the
    shuffle, so a hot group sends one row per map task.
    """
    return F.min_by(col, F.when(F.col(col).isNotNull(), F.col(order)))


def coalesce_by_column(df: DataFrame, by: Sequence[str], order: str,
                       cols: Sequence[str] | None = None) -> DataFrame:
    """One row per group; each column its first non-null value by ``order``."""
    names = cols if cols is not None else [c for c in df.columns if c not in (*by, order)]
    return df.groupBy(*by).agg(*[first_value(c, order).alias(c) for c in names])
