"""Incidence tables: counts per token, timepoint and arm, with totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import tokens, trim_all
from .aggregate import with_total_row
from .reshape import cell, cells

#: Column for what happened outside the grid.
REST = "elsewhere"


def participants_with(df: DataFrame, by: Sequence[str], id_col: str, col: str | None = None) -> DataFrame:
    """Distinct participants per group, among the rows where ``col`` has a value."""
    rows = df.filter(F.col(col).isNotNull()) if col else df
    return rows.groupBy(*by).agg(F.count_distinct(id_col).alias("n"))


def incidence(df: DataFrame, cols: Sequence[str], id_col: str = "id", timepoint: str = "timepoint",
              arm: str = "group", timepoints: Sequence = (), arms: Sequence = (),
              trim: bool = True, drop_empty: bool = True, rest: str | None = REST) -> DataFrame:
    """One table per list column, stacked under ``section``.

    Rows: each token with its count per timepoint and arm, a ``Total`` row of
    column sums, and a ``Total n`` row of distinct participants with at least
    one token.  Columns: ``f``, one ``<timepoint>_<arm>`` per cell of the full
    grid (0 where nothing happened), ``rest`` for events at other timepoints or
    in other arms, a null one included, and ``row_order`` 0, 1, 2.  With
    ``rest=None`` events outside the grid are left out.  A column without any
    event keeps its two total rows.

    All sections go through one aggregation, and the totals are rolled up from
    its result.
    """
    grid = cells(timepoints, arms)
    inside = F.coalesce(F.col(timepoint).isin(*timepoints) & F.col(arm).isin(*arms), F.lit(False))
    at = cell([F.col(timepoint), F.col(arm).cast("string")])
    if rest is None:
        df = df.filter(inside)
    else:
        grid = [*grid, rest]
        at = F.when(inside, at).otherwise(F.lit(rest))
    lists = df.select(
        F.col(id_col).alias("id"),
        at.alias("cell"),
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("section"), _list(c, trim, drop_empty).alias("parts")) for c in cols
        ])).alias("s"),
    ).select("id", "cell", "s.section", "s.parts").filter(F.size("parts") > 0)

    def by_cell(counter):
        return [F.coalesce(F.sum(F.when(F.col("cell") == g, F.col(counter))), F.lit(0)).alias(g) for g in grid]

    per_token = (
        lists.select("section", "cell", F.explode("parts").alias("f"))
        .groupBy("section", "f", "cell").agg(F.count("*").alias("n"))
        .groupBy("section", "f").agg(*by_cell("n"))
    )
    body = with_total_row(per_token, "f", grid, by=["section"])
    people = (
        lists.groupBy("section", "cell").agg(F.count_distinct("id").alias("n"))
        .groupBy("section").agg(*by_cell("n"))
        .select("section", F.lit("Total n").alias("f"), *grid, F.lit(2).alias("row_order"))
    )
    both = body.unionByName(people).unionByName(_zero_totals(df, cols, grid))
    return both.groupBy("section", "f", "row_order").agg(*[F.sum(g).alias(g) for g in grid]).select(
        "section", "f", *grid, "row_order")


def _zero_totals(df, cols, grid):
    """The total rows of each section, so that one without events has them too."""
    rows = [F.struct(F.lit(c).alias("section"), F.lit(f).alias("f"), F.lit(k).alias("row_order"))
            for c in cols for f, k in (("Total", 1), ("Total n", 2))]
    return df.sparkSession.range(1).select(F.explode(F.array(*rows)).alias("t")).select(
        "t.*", *[F.lit(0).cast("long").alias(g) for g in grid])


def _list(col, trim, drop_empty):
    parts = tokens(col)
    if trim:
        parts = F.transform(parts, trim_all)
    if drop_empty:
        parts = F.filter(parts, lambda t: t != "")
    return parts
