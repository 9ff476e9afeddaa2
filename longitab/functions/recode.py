"""Value recoding: label maps, ranked labels, sentinels and overrides."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def recode(col: Column | str, mapping: Mapping, keep_unmatched: bool = False) -> Column:
    """Look ``col`` up in a literal map.

    An unlisted value becomes null, or stays as it is with ``keep_unmatched``
    (only sensible when keys and labels have one type).  With number keys a
    text that is no number is an unlisted value.
    """
    value = _c(col)
    if all(isinstance(k, (int, float)) and not isinstance(k, bool) for k in mapping):
        mapping, value = {float(k): v for k, v in mapping.items()}, value.try_cast("double")
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    hit = table[value]
    return F.coalesce(hit, _c(col)) if keep_unmatched else hit


def other_text(col: Column | str, text: Column | str, label: str = "Other") -> Column:
    """Where the coded answer is ``label``, take the free text instead."""
    return F.when(_c(col) == label, _c(text)).otherwise(_c(col))


def null_if(col: Column | str, *sentinels: str) -> Column:
    return F.when(~_c(col).isin(*sentinels), _c(col))


def rank_of(col: Column | str, levels: Sequence[str]) -> Column:
    """1-based position of a label in an ordered list; null if not listed."""
    return recode(col, {level: i for i, level in enumerate(levels, start=1)})


def only_levels(col: Column | str, levels: Sequence[str]) -> Column:
    """A label outside the ordered list becomes null."""
    return F.when(_c(col).isin(*levels), _c(col))


def override(col: Column | str, key: Column | str, keys: Iterable, value) -> Column:
    """Set ``value`` on the rows whose key is in a caller-supplied list."""
    return F.when(_c(key).isin(*keys), F.lit(value)).otherwise(_c(col))
