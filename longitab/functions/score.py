"""Horizontal arithmetic over item columns of one row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .recode import _c


def row_sum(cols: Sequence[Column | str]) -> Column:
    """Sum across columns; null if any of them is null."""
    return reduce(add, [_c(c) for c in cols])


def row_mean(cols: Sequence[Column | str], skip_null: bool = False) -> Column:
    """Mean across columns; null if any is null, unless nulls are skipped."""
    if not skip_null:
        return row_sum(cols) / F.lit(float(len(cols)))
    total = row_sum([F.coalesce(_c(c).cast("double"), F.lit(0.0)) for c in cols])
    n = row_sum([_c(c).isNotNull().cast("int") for c in cols])
    return F.when(n > 0, total / n)


def subscale(cols: Sequence[Column | str], top: float = 4, skip_null: bool = False) -> Column:
    """0-100 score, 100 best, from items that run 0 (best) to ``top``."""
    return F.lit(100.0) - row_mean(cols, skip_null) * 100.0 / F.lit(float(top))


def reverse(col: Column | str, top: float = 4) -> Column:
    return F.abs(_c(col) - F.lit(top))


def either_or(a: Column | str, b: Column | str) -> Column:
    """The one side that is present; null when both or neither are."""
    return F.when(_c(a).isNull(), _c(b)).when(_c(b).isNull(), _c(a))


def any_true(conditions: Sequence[Column]) -> Column:
    """1 if any condition holds, else 0; an unknown condition does not hold."""
    return F.when(reduce(or_, conditions), 1).otherwise(0)


def truncate(col: Column | str) -> Column:
    """Drop the fraction, towards zero."""
    c = _c(col)
    return F.when(c < 0, F.ceil(c)).otherwise(F.floor(c))


def nan_to_null(col: Column | str) -> Column:
    return F.when(~F.isnan(_c(col)), _c(col))
