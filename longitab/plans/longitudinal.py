"""Scores, dates and participant-level fills on the (id, timepoint) table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.dates import days_between, parse_date, parse_timestamp, weeks_between, years_fractional
from ..functions.score import reverse, row_mean, subscale
from ..operators import schema as S
from ..operators.fill import fill
from .timepoints import timepoint_rank


def fill_participant(df: DataFrame, by: str = "id", cols=tuple(V.PARTICIPANT_COLUMNS)) -> DataFrame:
    """Give each id's rows its participant-level values, in timepoint order.

    There is one row per (id, timepoint), so a group has at most as many rows
    as there are timepoints and needs no cutting up.
    """
    ranked = df.withColumn("__rank", timepoint_rank())
    return fill(ranked, S.present(df, cols), [by], "__rank", "downup", rows_per_block=None).drop("__rank")


def merge_dates(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "completed": F.coalesce("completed_base", "completed_proms", "completed_eq5d"),
        "aclr_satisfaction": F.coalesce("aclr_satisfaction2", "aclr_satisfaction1"),
        "bl_surgicaldelay": days_between(parse_date("bl_rupturedate"), parse_date("bl_aclrdate")),
    }).drop("aclr_satisfaction1", "aclr_satisfaction2")


def swap_instrument(df: DataFrame) -> DataFrame:
    """The patellofemoral set takes over the knee-score names."""
    df = df.drop(*S.starting(df, "koos"))
    return S.rename(df, {c: "koos" + c[5:] for c in S.starting(df, "pfoos")})


def score(df: DataFrame, skip_null: bool = False) -> DataFrame:
    """Flip the knee items, then subscale totals, their mean, and item means.

    A missing item makes its total missing unless ``skip_null``.
    """
    items = [c for c in S.starting(df, "koos") if c not in V.KOOS_FORWARD]
    df = S.across(df, items, reverse)
    totals = {}
    for name, pattern in V.SUBSCALES.items():
        cols = S.matching(df, pattern)
        if cols:
            totals[name] = subscale(cols, 4, skip_null)
    df = df.withColumns(totals)
    more = {}
    if all(t in totals for t in V.KOOS4):
        more["koos_4_total"] = row_mean(V.KOOS4, skip_null)
    aclqol = S.matching(df, V.ACLQOL_ITEMS)
    if aclqol:
        more["aclqol_total"] = row_mean(aclqol, skip_null)
    df = df.withColumns(more)
    df = S.across(df, S.present(df, V.EQ5D_SHIFTED), lambda c: c + 1)
    return S.rename(df, {o: n for o, n in V.EQ5D_NAMES.items() if o in df.columns})


def time_from_start(df: DataFrame) -> DataFrame:
    """Weeks from the first session if known, else from baseline, to completion."""
    df = df.withColumn("completed", parse_timestamp("completed").cast("date"))
    start = F.coalesce(parse_date("firstphysiosession_date"), F.col("baseline_date"))
    weeks = (
        F.when(F.col("timepoint") == "mpre", None)
        .when(F.col("timepoint") == "m0", 0.0)
        .otherwise(weeks_between(start, "completed"))
    )
    return df.withColumn("timepoint_actual", weeks)


def longitudinal(df: DataFrame, by: str = "id", skip_null: bool = False) -> DataFrame:
    """From assembled timepoints to the scored table."""
    df = fill_participant(merge_dates(df), by)
    df = df.drop("completed_base", "completed_proms", "completed_eq5d", "completed_lab",
                 "redcap_event_name", "redcap_survey_identifier")
    df = score(swap_instrument(df), skip_null)
    if "bl_pass" in df.columns:
        df = df.withColumn("pass", F.coalesce("bl_pass", "pass")).drop("bl_pass")
    return time_from_start(df)


def years_since_surgery(df: DataFrame, by: str = "id") -> DataFrame:
    """Add ``yearssinceaclr``, worked out on the baseline row, to every row of the id.

    An id has one row per timepoint, so the window is small; a join back would
    run everything before it twice.
    """
    years = years_fractional(parse_date("bl_aclrdate"), "baseline_date")
    at_base = F.max(F.when(F.col("timepoint") == "m0", years)).over(W.partitionBy(by))
    return df.withColumn("yearssinceaclr", at_base)
