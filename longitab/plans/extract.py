"""Self-service extract: timepoints, variable groups, blinding, shape."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.text import plain_text
from ..operators import schema as S
from ..sources.bundle import write_bundle

NULL_TOKENS = {"na": "NA", "blank": ""}


def extract(df: DataFrame, catalogue: DataFrame, timepoints: Sequence[str], groups: Sequence[str] = (),
            blinded: bool = True, shape: str = "long", always: Sequence[str] = tuple(V.EXTRACT_ALWAYS),
            ids: Sequence[str] = tuple(V.EXTRACT_IDS)) -> DataFrame:
    """Requested rows and columns of the longitudinal table."""
    rows = df.filter(F.col("timepoint").isin(*timepoints))
    cols = S.select_catalogued(rows, catalogue, groups, always)
    out = S.blind(cols, V.REVEALING, V.REVEALING_PARTS, blinded, "group", V.ARM_LABELS)
    return widen(out, timepoints, S.present(out, ids)) if shape == "wide" else out


def widen(df: DataFrame, timepoints: Sequence[str], ids: Sequence[str], by: str = "timepoint") -> DataFrame:
    """One row per participant, columns ``<timepoint>_<variable>`` as text.

    The table has one row per participant and timepoint (of several, the least
    counts).  Each timepoint's
    variables travel as one struct, so the aggregate has as many expressions
    as timepoints, however many variables there are; no lengthening, one
    shuffle.
    """
    kinds = dict(df.dtypes)
    rest = [c for c in df.columns if c not in (*ids, by)]
    packed = df.select(*ids, by, F.struct(*[plain_text(S._q(c), kinds[c]).alias(c) for c in rest]).alias("__v"))
    wide = packed.groupBy(*ids).agg(*[
        F.min(F.when(F.col(by) == t, F.col("__v"))).alias(f"__{t}") for t in timepoints
    ])
    return wide.select(*ids, *[F.col(f"__{t}")[c].alias(f"{t}_{c}") for t in timepoints for c in rest])


def unknown_names(df: DataFrame, catalogue: DataFrame, groups: Sequence[str]) -> list[str]:
    """Catalogued names the table does not have."""
    return S.unknown(df, S.catalogue_names(catalogue, groups))


def write_extract(main: DataFrame, monitoring: DataFrame, surgery: DataFrame, folder: str,
                  groups: Sequence[str] = (), extra: Sequence[str] = (), missing: str = "na") -> list[str]:
    """Write what was asked for: the main table if any variable group was."""
    tables = {"data": main, "fortnightly": monitoring, "surgical": surgery}
    asked = (["data"] if groups else []) + (["fortnightly"] if "fn" in extra else []) + (
        ["surgical"] if "sx" in extra else [])
    return write_bundle(tables, folder, null=NULL_TOKENS[missing], only=asked)
