"""Fortnightly and monthly monitoring."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.dates import parse_date
from ..functions.recode import recode
from ..functions.score import either_or, row_sum
from ..functions.text import extract_first
from ..operators import schema as S

KEEP = r"week|month"
REJECT = r"^4_month|^12_month"
# The week-16 form sits in the section before the four-month visit.  With the
# longer pattern, as first written, its event name never matched and the form
# counted as month 4.
WEEK_16 = "pre4_month_questio"
WEEK_16_AS_WRITTEN = "pre4_month_question"


def monitoring_label(event: str, week_16: str = WEEK_16) -> Column:
    """``w<k>`` or ``m<k>`` by the first one or two digits of the event name."""
    k = extract_first(event, r"\d{1,2}")
    name = F.col(event)
    return (
        F.when(name.contains("week"), F.concat(F.lit("w"), k))
        .when(name.contains(week_16), "w16")
        .when(name.contains("month"), F.concat(F.lit("m"), k))
    )


def merge_checkbox_arms(df: DataFrame, prefix: str, arms=V.ARMS, names=tuple(V.PROFESSIONS)) -> DataFrame:
    """Add the arms' checkbox families up, one column per box; null if either is.

    Where the export holds one arm's box only, that one counts.
    """
    merged = {}
    for k, name in enumerate(names, start=1):
        boxes = [b for arm in arms if (b := f"{prefix}_whichotherprof_{arm}___{k}") in df.columns]
        if boxes:
            merged[f"{prefix}_otherprof_{name}"] = row_sum(boxes)
    return df.withColumns(merged)


def monitoring(df: DataFrame, by: str = "id", event: str = "redcap_event_name",
               week_16: str = WEEK_16) -> DataFrame:
    """One row per (id, week or month) with labelled sports and merged arms."""
    fm = S.pick(df, [by, event, *S.starting(df, "fn_"), *S.starting(df, "mth_")])
    fm = fm.filter(F.col(event).rlike(KEEP) & ~F.col(event).rlike(REJECT))
    fm = fm.withColumns({
        "timepoint": monitoring_label(event, week_16),
        "completed": F.coalesce(parse_date("fn_completed"), parse_date("mth_completed")),
    }).drop("fn_completed", "mth_completed", event)
    fm = S.across(fm, S.matching(fm, r"sport\_type\_\d"), lambda c: recode(c, V.SPORT))
    for prefix in ("fn", "mth"):
        fm = merge_checkbox_arms(fm, prefix)
        other = f"{prefix}_whichotherprof_other"
        if other in fm.columns:
            fm = fm.withColumn(f"{prefix}_otherprof_otherdetail", F.col(other))
        counts = [c for arm in V.ARMS if (c := f"{prefix}_otherprofsessions_{arm}") in fm.columns]
        if counts:
            fm = fm.withColumn(f"{prefix}_otherprof_sessions", either_or(*counts) if len(counts) > 1 else F.col(counts[0]))
    fm = S.drop_matching(fm, "whichotherprof|otherprofsessions")
    return S.pick(fm, [by, "timepoint", "completed", *S.starting(fm, "fn_"), *S.starting(fm, "mth_")])
