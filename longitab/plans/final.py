"""The finished longitudinal table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.dates import parse_date
from ..functions.text import extract_first
from ..operators import schema as S
from ..operators.joins import enrich, left_join
from ..operators.rows import drop_all_missing
from .longitudinal import years_since_surgery
from .sides import side_relative, surgery_counts
from .timepoints import timepoint_rank


def postcodes(df: DataFrame, addresses: DataFrame, by: str = "id", key: str = "address_res",
              full: str = "address") -> DataFrame:
    """(id, postcode) by looking each address up in a table of full addresses.

    The postcode is the four digits after a state's three letters.
    """
    given = df.select(by, key).filter(F.col(key).isNotNull())
    return enrich(given, addresses, key).select(
        by, extract_first(full, r"(?<=\w{3}\s)\d{4}").alias("postcode"))


def final_table(df: DataFrame, postcode: DataFrame | None = None, surgery: DataFrame | None = None,
                by: str = "id", blinded: bool = True) -> DataFrame:
    """Join the derived values, order the columns, sort, blind, drop empty rows."""
    out = years_since_surgery(df, by)
    out = surgery_counts(side_relative(out, keep=("l_aclr_no", "r_aclr_no")))
    if postcode is not None:
        out = left_join(out, postcode.select(by, "postcode"), by)
    if surgery is not None:
        out = left_join(out, surgery.select(by, "concomitant_inj"), by)
    out = out.drop(*V.INJURY_INPUTS)
    out = S.rename(out, {"bl_dominantleg": "dominantleg", "bl_aclrside": "aclrside"}, strict=False)
    if "bl_aclrside_demographic" in out.columns:
        out = out.withColumn("aclrside", F.coalesce("aclrside", "bl_aclrside_demographic")).drop("bl_aclrside_demographic")
    out = S.blind(out, V.REVEALING, V.REVEALING_PARTS, blinded, "group", V.ARM_LABELS)
    out = drop_all_missing(out, S.present(out, ["completed", "koos_s1"]))
    out = S.across(out, S.present(out, ["mridate", "dob"]), parse_date)
    out = out.drop(*S.starting(out, *V.LATER_PREFIXES))
    return order_columns(out).orderBy(F.asc_nulls_last(by), timepoint_rank().asc_nulls_last())


def order_columns(df: DataFrame) -> DataFrame:
    block = S.between(df, *V.FRONT_BASELINE) if all(c in df.columns for c in V.FRONT_BASELINE) else []
    return S.reorder(df, [*V.FRONT, *block, *V.FRONT_NEXT], V.FRONT_PREFIXES)
