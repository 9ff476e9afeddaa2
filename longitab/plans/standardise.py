"""From export columns to working columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.recode import null_if, other_text, recode
from ..functions.text import paste
from ..operators import schema as S
from ..operators.fill import ROWS_PER_BLOCK, fill

DEMOGRAPHIC_FILLS = {"dob": "down", "gender": "updown"}


def rename_columns(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Dictionary names first, then the fixed ones; both must exist in the frame."""
    df = S.rename_from(df, dictionary)
    return S.rename(df, {o: n for o, n in V.EXPORT_NAMES.items() if o in df.columns})


def recode_demographics(df: DataFrame) -> DataFrame:
    """Codes to labels in one projection; only for the columns there are."""
    plain = {
        "group": V.GROUP, "gender": V.GENDER, "bl_dominantleg": V.RIGHT_LEFT,
        "bl_aclrside": V.LEFT_RIGHT, "bl_aclrside_demographic": V.LEFT_RIGHT,
        "dominanthand": V.HAND,
    }
    new = {c: recode(c, m) for c, m in plain.items() if c in df.columns}
    if "completed_lab" in df.columns:
        new["completed_lab"] = null_if("completed_lab", V.NOT_COMPLETED)
    if "sex" in df.columns:
        label = recode("sex", V.SEX)
        if "sex_other" in df.columns:
            label = F.when(F.col("sex") == V.SEX_OTHER, F.col("sex_other").cast("string")).otherwise(label)
        new["sex"] = label
    if "bl_birthcountry" in df.columns:
        label = recode("bl_birthcountry", V.BIRTH_COUNTRY)
        if "bl_birthcountrytext" in df.columns:
            label = F.when(F.col("bl_birthcountry") == V.BIRTH_COUNTRY_OTHER,
                           F.col("bl_birthcountrytext")).otherwise(label)
        new["bl_birthcountry"] = label
    return df.withColumns(new)


def drop_admin(df: DataFrame, dictionary: DataFrame) -> DataFrame:
    df = S.drop_matching(df, r"timestamp|complete$|sex_other|bl_birthcountrytext")
    return S.drop_from(df, dictionary)


def standardise(df: DataFrame, dictionary: DataFrame, by: str = "id", order: str = "seq",
                rows_per_block: int | None = ROWS_PER_BLOCK) -> DataFrame:
    """Rename, recode, drop administrative columns, fill demographics."""
    out = drop_admin(recode_demographics(rename_columns(df, dictionary)), dictionary)
    ways = {c: w for c, w in DEMOGRAPHIC_FILLS.items() if c in out.columns}
    return fill(out, ways, [by], order, rows_per_block=rows_per_block)


# -- graft -----------------------------------------------------------------

def graft_candidates(df: DataFrame, null_text: str | None = None) -> DataFrame:
    """Labels for both graft sources, and ``aclrgraft`` from the surgeon's report.

    A contralateral graft of unknown kind stays null; ``null_text="NA"`` gives
    the text that pasting a missing value makes.
    """
    df = df.withColumns({
        "sx_graft": recode("sx_graft", V.GRAFT_REPORTED),
        "bl_grafttype": recode("bl_grafttype", V.GRAFT_RECALLED),
    })
    df = df.withColumn("sx_graft", other_text("sx_graft", "sx_graft_other"))
    return df.withColumn("aclrgraft", F.when(
        F.col("sx_graftside") == V.GRAFT_CONTRALATERAL,
        paste(F.lit("Contralateral"), "sx_graft", null_text=null_text),
    ).otherwise(F.col("sx_graft")))


def settle(first: str, second: str, same: dict) -> Column:
    """Filled first choice, normalised, else the filled second choice."""
    return F.coalesce(recode(first, same, keep_unmatched=True), F.col(second))


# Filling the report, falling back to recall where the whole id has none, and
# filling again equals filling both at once and taking the first that exists:
# after a two-way fill a column is null either nowhere or everywhere in the id.
GRAFT_FILLS = {"aclrgraft": "downup", "bl_grafttype": "downup"}


def resolve_graft(df: DataFrame, by: str = "id", order: str = "seq", null_text: str | None = None,
                  rows_per_block: int | None = ROWS_PER_BLOCK) -> DataFrame:
    """One graft type per id, reported before recalled."""
    filled = fill(graft_candidates(df, null_text), GRAFT_FILLS, [by], order,
                  rows_per_block=rows_per_block)
    return finish_graft(filled)


def finish_graft(df: DataFrame) -> DataFrame:
    df = df.withColumn("aclrgraft", settle("aclrgraft", "bl_grafttype", V.GRAFT_SAME))
    return df.drop(*V.GRAFT_INPUTS)
