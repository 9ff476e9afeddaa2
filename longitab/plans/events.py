"""Adverse-event incidence report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..operators.joins import left_join
from ..operators.report import REST, incidence


def participants(main: DataFrame, below: int = 3000) -> DataFrame:
    """(id, group) of the baseline rows, test records left out."""
    return main.filter((F.col("id") < below) & (F.col("timepoint") == "m0")).select("id", "group")


def incidence_report(people: DataFrame, events: DataFrame, cols: Sequence[str] = tuple(V.EVENT_COLUMNS),
                     timepoints: Sequence[str] = tuple(V.EVENT_TIMEPOINTS),
                     arms: Sequence = tuple(V.EVENT_ARMS), trim: bool = True,
                     drop_empty: bool = True, rest: str | None = REST) -> DataFrame:
    """All incidence tables at once, under ``section``; see ``incidence``."""
    joined = left_join(people, events, "id")
    return incidence(joined, cols, timepoints=timepoints, arms=arms, trim=trim, drop_empty=drop_empty, rest=rest)


def incidence_table(report: DataFrame, section: str) -> DataFrame:
    """One finished table, in display order."""
    return report.filter(F.col("section") == section).orderBy("row_order", "f").drop("section", "row_order")
