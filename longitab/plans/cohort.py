"""Consent cohort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import semi_join


def consented(df: DataFrame, by: str = "record_id", tick: str = "consent_tick") -> DataFrame:
    """Ids with consent on any row.

    Carrying the tick forward first would add no id to this set, so no window
    is needed.
    """
    return df.filter(F.col(tick) == 1).select(by).distinct()


def keep_consented(df: DataFrame, by: str = "record_id", tick: str = "consent_tick") -> DataFrame:
    return semi_join(df, consented(df, by, tick), by)
