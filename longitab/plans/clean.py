"""The whole cleaning run, from export to five finished tables."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from .. import vocab as V
from ..operators import schema as S
from ..operators.fill import ROWS_PER_BLOCK, fill
from ..operators.joins import semi_join
from ..session import stage
from . import standardise as st
from .cohort import consented
from .final import final_table, postcodes
from .longitudinal import longitudinal
from .monitoring import monitoring
from .surgery import surgical_details
from .timepoints import study_timepoints

EVENT = "redcap_event_name"
TABLES = ["database", "fortnightly", "surgical", "adverse_events", "mri"]


def clean_study(export: DataFrame, dictionary: DataFrame, history: DataFrame, surgery_counts: DataFrame,
                addresses: DataFrame, adverse_events: DataFrame, mri: DataFrame,
                flagged_ids: Iterable = (), blinded: bool = True, keep_unmatched: bool = False,
                skip_null: bool = False, rows_per_block: int | None = ROWS_PER_BLOCK) -> dict[str, DataFrame]:
    """Clean an export into the tables of ``TABLES``.

    The standardised export is staged once, as several branches each read a
    few of its columns; so are the cohort's ids and the columns that are
    filled row by row.  The cohort is selected where rows are narrow or
    already collapsed, never by joining the wide export.
    """
    df = st.rename_columns(export, dictionary)
    df = st.drop_admin(st.recode_demographics(df), dictionary)
    ways = {c: w for c, w in st.DEMOGRAPHIC_FILLS.items() if c in df.columns}
    graft = {"sx_graft", "sx_graft_other", "sx_graftside", "bl_grafttype"} <= set(df.columns)
    if graft:
        df = st.graft_candidates(df)
        ways |= st.GRAFT_FILLS
    df = stage(df)
    # From the export as it came: the dictionary may rename or drop the tick.
    key = "record_id" if "record_id" in export.columns else "id"
    cohort = stage(consented(export, key).toDF("id"))

    narrow = semi_join(df.select("id", EVENT, "seq", *ways), cohort, "id")
    filled = fill(narrow, ways, ["id"], "seq", rows_per_block=rows_per_block)
    filled = stage(st.finish_graft(filled) if graft else filled)

    postcode = postcodes(df, addresses) if "address_res" in df.columns else None
    monitored = semi_join(monitoring(df), cohort, "id")
    surgical = surgical_details(df, flagged_ids=flagged_ids)

    trunk = df.drop("address_res", *ways, *S.starting(df, "fn_", "mth_", "sx_"), *V.GRAFT_INPUTS, *V.HISTORY_INPUTS)
    rows = study_timepoints(trunk, [history, surgery_counts], filled=filled, cohort=cohort,
                            keep_unmatched=keep_unmatched)
    database = final_table(longitudinal(rows, skip_null=skip_null), postcode, surgical, blinded=blinded)
    return dict(zip(TABLES, [database, monitored, semi_join(surgical, cohort, "id"), adverse_events, mri]))
