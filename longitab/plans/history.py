"""Free-text histories: frequencies and per-participant profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.text import normalise_list, replace_first, trim_all
from ..operators.aggregate import frequency
from ..operators.joins import left_join
from ..operators.reshape import explode_first, key_values
from ..operators.rows import distinct_first


def history_tokens(df: DataFrame, col: str, keep: Sequence[str] = ("id",), n: int | None = None,
                   notes: bool = False, closing: bool = False) -> DataFrame:
    """(keep..., pos, token): the entries of a free-text list, trimmed; with ``n`` only the first ones.

    ``notes`` and ``closing`` also clean bracketed notes and a last separator.
    """
    text = df.select(*keep, normalise_list(col, notes, closing).alias("token"))
    entries = explode_first(text, "token", n, pos="pos")
    return entries.withColumn("token", trim_all("token"))


def token_frequency(tokens: DataFrame, name: str = "f") -> DataFrame:
    return frequency(tokens, "token", name=name, sort=True)


def body_region_tokens(tokens: DataFrame, by: str = "id", order: Sequence[str] = ("pos",),
                       regions: str = V.BODY_REGIONS, side: str = V.LATERALITY) -> DataFrame:
    """Entries about a body region, first side word cut, distinct per id."""
    hits = tokens.filter(F.col("token").rlike(regions))
    named = hits.withColumn("token", trim_all(replace_first("token", side, "")))
    return distinct_first(named, [by], "token", order)


def surgery_profile(spine: DataFrame, tokens: DataFrame, by: str = "id",
                    names: Sequence[str] | None = None, any_surgery: str = V.ANY_SURGERY,
                    graft: str = V.GRAFT_SURGERY, as_map: bool = False) -> DataFrame:
    """Per id: number of surgeries, by side, and one column per graft surgery.

    An id without any has nulls, not zeros.  The graft columns are read from
    the data unless given, and are refused beyond what can be columns;
    ``as_map`` counts every graft surgery the data hold in one map column
    ``grafts`` instead, in the order of their names.
    """
    known = tokens.filter(F.col("token").rlike(any_surgery) | F.col("token").rlike(graft))
    if as_map:
        names = []
    elif names is None:
        names = key_values(known.filter(F.col("token").rlike(graft)), "token")
    counted = F.col("token").rlike(any_surgery)
    per_id = known.groupBy(by).agg(
        F.nullif(F.count_if(counted), F.lit(0)).alias("n_surgery"),
        F.when(F.count_if(counted) > 0, F.count_if(counted & F.col("token").contains("index"))).alias("n_indexsurgery"),
        F.when(F.count_if(counted) > 0, F.count_if(counted & F.col("token").contains("contra"))).alias("n_contrasurgery"),
        *[F.nullif(F.count_if(F.col("token") == n), F.lit(0)).alias(n) for n in names],
    )
    if as_map:
        grafts = known.filter(F.col("token").rlike(graft)).groupBy(by, "token").agg(F.count("*").alias("n"))
        pairs = F.array_sort(F.collect_list(F.struct("token", "n")))
        per_id = left_join(per_id, grafts.groupBy(by).agg(F.map_from_entries(pairs).alias("grafts")), by)
    return left_join(spine.select(by), per_id, by)


def patients_per_token(tokens: DataFrame, by: str = "id", name: str = "f") -> DataFrame:
    """How many ids mention each entry, most frequent first."""
    return frequency(tokens.select(by, "token").distinct(), "token", name=name, sort=True)
