"""Surgical details and the concomitant-injury flag."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.recode import other_text, override, rank_of, recode
from ..functions.score import any_true
from ..operators import schema as S

GRADED = ("sx_patellacartilage", "sx_femoralcartilage_lat")
INTERVENTIONS = ["sx_cartilage_int", "sx_meniscus_med", "sx_meniscus_lat"]


def surgical_details(df: DataFrame, by: str = "id", flagged_ids: Iterable = ()) -> DataFrame:
    """Rows with a surgery record, labelled, with ``concomitant_inj``.

    ``flagged_ids`` are ids known to have a concomitant injury from notes.
    The graft column arrives labelled and keeps those labels.
    """
    sx = S.pick(df, [by, *S.starting(df, "sx_")]).filter(F.col("sx_name").isNotNull())
    coded = {
        "sx_primary": V.PRIMARY, "sx_side": V.LEFT_RIGHT, "sx_graftside": V.GRAFT_SIDE,
        "sx_meniscus_med": V.MENISCUS, "sx_meniscus_lat": V.MENISCUS,
        "sx_cartilage_int": V.CARTILAGE_INT,
    }
    graded = S.between(sx, *GRADED)
    sx = sx.withColumns({
        **{c: recode(c, m) for c, m in coded.items() if c in sx.columns},
        **{c: recode(c, V.CARTILAGE_GRADE) for c in graded},
    })
    sx = sx.withColumns({c: other_text(c, f"{c}_other") for c in INTERVENTIONS if f"{c}_other" in sx.columns})
    sx = sx.drop("sx_graft_other", *[f"{c}_other" for c in INTERVENTIONS])
    grades = list(V.CARTILAGE_GRADE.values())
    flag = any_true(
        [rank_of(c, grades) > grades.index("Grade 0") + 1 for c in graded]
        + [F.col(c) != V.NONE_REPORTED for c in INTERVENTIONS]
    )
    sx = sx.withColumn("concomitant_inj", flag)
    ids = list(flagged_ids)
    return sx.withColumn("concomitant_inj", override("concomitant_inj", by, ids, 1)) if ids else sx
