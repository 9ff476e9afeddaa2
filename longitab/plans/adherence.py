"""Adherence: what participants reported against what assessors recorded."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.score import nan_to_null, row_sum
from ..functions.text import paste
from ..operators import schema as S
from ..operators.aggregate import percent_of, strict_sum
from ..operators.joins import full_join

SUMS = {
    "sum_physioattendance_super": "fn_physioattendance_super",
    "sum_strengthattendance_super": "fn_strengthsessions_super",
    "sum_strengthattendance_control": "fn_strengthsessionsfreq_control",
}
HALF_MEANS = {
    "mean_physioattendance_super": "fn_physioattendance_super",
    "mean_strengthattendance_super": "fn_strengthsessions_super",
    "mean_strengthattendance_control": "fn_strengthsessionsfreq_control",
}
MEANS = {"mean_sessionlength": "fn_sessionlength", "mean_rpe": "fn_rpe"}
ORDER = [
    "id", "responses", "perc_complete", *SUMS, "mean_physioattendance_super", "m4_physio_mean",
    "mean_strengthattendance_super", "mean_strengthattendance_control", "m4_strength_mean",
    "mean_sessionlength", "m4_mean_sessionlength", "mean_rpe", "m4_mean_rpe",
]


def zero_dose(df: DataFrame, sessions: str = "fn_strengthsessions_control",
              frequency: str = "fn_strengthsessionsfreq_control") -> DataFrame:
    """No sessions means a frequency of zero, whatever was entered."""
    return df.withColumn(frequency, F.when(F.col(sessions) == 0, 0.0).otherwise(F.col(frequency)))


def reported(weekly: DataFrame, expected: int = V.EXPECTED_RESPONSES, count_answers: bool = False) -> DataFrame:
    """Per-id summary of the fortnightly answers, numbers to two decimals.

    The exercise percentages count rows, as the response percentage does;
    ``count_answers`` counts the rows with an answer instead.
    """
    def share(c):
        return percent_of(F.count(c) if count_answers else F.count("*"), expected)

    return zero_dose(weekly).groupBy("id").agg(
        F.count("*").alias("responses"),
        percent_of(F.count("*"), expected).alias("perc_complete"),
        *[F.bround(strict_sum(c).cast("double"), 2).alias(n) for n, c in SUMS.items()],
        *[F.bround(nan_to_null(F.avg(c)) / 2, 2).alias(n) for n, c in HALF_MEANS.items()],
        *[F.bround(nan_to_null(F.avg(c)), 2).alias(n) for n, c in MEANS.items()],
        *[share(f"fn_exercises_{e}").alias(f"{e}_perc") for e in V.EXERCISES],
    )


def assessed(visits: DataFrame, id_prefix: str = "") -> DataFrame:
    """Assessor-recorded values at the four-month visit; null-propagating sums."""
    return visits.filter(F.col("timepoint") == "m4").select(
        paste(F.lit(id_prefix), "id", sep="").alias("id"),
        row_sum(["m4_strength_physio1to1", "m4_strength_physiogroup"]).alias("m4_physio_mean"),
        row_sum(["m4_strength_home", "m4_strength_gym"]).alias("m4_strength_mean"),
        F.col("m4_sessionlength").alias("m4_mean_sessionlength"),
        F.col("m4_rpe").alias("m4_mean_rpe"),
    )


def adherence(weekly: DataFrame, visits: DataFrame, id_prefix: str = "",
              expected: int = V.EXPECTED_RESPONSES, count_answers: bool = False) -> DataFrame:
    """Both sources side by side; an id of either source has a row.

    Both sides hold one row per id when they are joined.
    """
    both = full_join(reported(weekly, expected, count_answers), assessed(visits, id_prefix), "id")
    return S.reorder(both, ORDER)


def strength_pairs(summary: DataFrame) -> DataFrame:
    """Reported (rounded up) and assessed strength sessions per id."""
    said = F.coalesce("mean_strengthattendance_super", "mean_strengthattendance_control")
    return summary.select("id", F.ceil(said).alias("reported"), F.col("m4_strength_mean").alias("assessed"))
