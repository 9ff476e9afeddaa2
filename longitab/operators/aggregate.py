"""Aggregates with the null rules of the study scripts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recode import _c


def strict_sum(col: Column | str) -> Column:
    """Sum that is null as soon as one value is."""
    return F.when(F.count(_c(col)) == F.count("*"), F.sum(_c(col)))


def strict_max(col: Column | str) -> Column:
    return F.when(F.count(_c(col)) == F.count("*"), F.max(_c(col)))


def strict_abs_min(col: Column | str) -> Column:
    """Absolute value of the minimum; null as soon as one value is."""
    return F.when(F.count(_c(col)) == F.count("*"), F.abs(F.min(_c(col))))


def percent_of(n: Column, expected: float, digits: int = 2) -> Column:
    """Share of the expected number, in percent, rounded half to even."""
    return F.bround(n * F.lit(100.0) / F.lit(float(expected)), digits)


def frequency(df: DataFrame, col: str, by: Sequence[str] = (), name: str = "f",
              sort: bool = False) -> DataFrame:
    """Rows per value of ``col`` (null is a value too), within groups if given.

    Sorted: most frequent first, ties by label, null last.
    """
    counts = df.groupBy(*by, F.col(col).alias(name)).agg(F.count("*").alias("n"))
    if not sort:
        return counts
    return counts.orderBy(F.desc("n"), F.asc_nulls_last(name), *by)


def with_total_row(df: DataFrame, label: str, numbers: Sequence[str], total: str = "Total",
                   by: Sequence[str] = ()) -> DataFrame:
    """Append the column sums under a label, per table when several are stacked.

    ``row_order`` is 0 for the rows and 1 for the total; a row whose label is
    null stays a row.
    """
    sums = df.groupingSets([[*by, label], [*by]], *by, label).agg(
        *[F.sum(c).alias(c) for c in numbers], F.grouping(label).cast("int").alias("row_order")
    )
    named = F.when(F.col("row_order") == 1, F.lit(total)).otherwise(F.col(label))
    return sums.select(*by, named.alias(label), *numbers, "row_order")
