"""Linking addresses to area indexes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import paste
from ..operators.joins import join_suffixed, left_join
from ..operators.schema import lower_names
from ..operators.spatial import assign_areas


def area_codes(addresses: DataFrame, areas: DataFrame, prefix: str, codes: Sequence[str],
               by: str = "id", x: str = "lon", y: str = "lat") -> DataFrame:
    """Area codes of each address, finest first; names lower case, that code numeric."""
    fine = codes[0]
    hits = assign_areas(addresses, areas, by, x, y, fine, keep=codes[1:])
    hits = lower_names(hits.select(paste(F.lit(prefix), by, sep="").alias("id"), *codes))
    return hits.withColumn(fine.lower(), F.col(fine.lower()).try_cast("bigint"))


def link_indexes(located: DataFrame, national: DataFrame, state: DataFrame, code: str,
                 lookup_code: str = "sa1") -> DataFrame:
    """Join two lookups; value columns of the same name get ``.x`` and ``.y``."""
    first = left_join(located, national.withColumnRenamed(lookup_code, code), code)
    return join_suffixed(first, state.withColumnRenamed(lookup_code, code), code)
