"""Operators that work on column names.

Name rules ignore case.  Dictionaries and catalogues are schema-sized: they
are read back to the driver through ``pairs_of``, which refuses larger ones.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recode import recode

MAX_SCHEMA_ROWS = 20_000


# -- finding names ---------------------------------------------------------

def starting(df: DataFrame, *prefixes: str) -> list[str]:
    low = tuple(p.lower() for p in prefixes)
    return [c for c in df.columns if c.lower().startswith(low)]


def matching(df: DataFrame, pattern: str) -> list[str]:
    rx = re.compile(pattern, re.IGNORECASE)
    return [c for c in df.columns if rx.search(c)]


def containing(df: DataFrame, part: str) -> list[str]:
    return [c for c in df.columns if part.lower() in c.lower()]


def between(df: DataFrame, first: str, last: str) -> list[str]:
    """The columns from ``first`` to ``last`` by position, both included."""
    i, j = df.columns.index(first), df.columns.index(last)
    return df.columns[i : j + 1] if i <= j else df.columns[j : i + 1][::-1]


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of ``names`` that exist, each once, in the order given."""
    have = set(df.columns)
    return [n for n in dict.fromkeys(names) if n in have]


def unknown(df: DataFrame, names: Iterable[str]) -> list[str]:
    """Those of ``names`` that do not exist: a catalogue goes stale."""
    have = set(df.columns)
    return [n for n in dict.fromkeys(names) if n not in have]


def pairs_of(table: DataFrame, key: str, value: str) -> list[tuple]:
    """Read a schema-sized two-column table; fail rather than read a big one."""
    rows = table.select(key, value).limit(MAX_SCHEMA_ROWS + 1).collect()
    if len(rows) > MAX_SCHEMA_ROWS:
        raise ValueError(f"a dictionary of more than {MAX_SCHEMA_ROWS} rows is not schema-sized")
    return [(r[0], r[1]) for r in rows]


# -- projecting ------------------------------------------------------------

def pick(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[F.col(_q(n)) for n in names])


def drop_matching(df: DataFrame, pattern: str) -> DataFrame:
    return df.drop(*matching(df, pattern))


def rename(df: DataFrame, names: Mapping[str, str], strict: bool = True) -> DataFrame:
    """Rename old -> new.  Unknown old names and clashing new names fail."""
    missing = unknown(df, names)
    if missing and strict:
        raise ValueError(f"cannot rename absent columns: {missing}")
    result = [names.get(c, c) for c in df.columns]
    twice = sorted({c for c in result if result.count(c) > 1})
    if twice:
        raise ValueError(f"renaming makes duplicate columns: {twice}")
    return df.toDF(*result)


def rename_from(df: DataFrame, dictionary: DataFrame, old: str = "varname",
                new: str = "newname", strict: bool = True) -> DataFrame:
    return rename(df, dict(pairs_of(dictionary, old, new)), strict)


def rename_matching(df: DataFrame, pattern: str, new: str) -> DataFrame:
    """Replace the first match of ``pattern`` in every column name."""
    return rename(df, {c: re.sub(pattern, new, c, count=1) for c in df.columns})


def lower_names(df: DataFrame) -> DataFrame:
    return rename(df, {c: c.lower() for c in df.columns})


def drop_from(df: DataFrame, dictionary: DataFrame, name: str = "newname",
              flag: str = "remove", value: str = "remove") -> DataFrame:
    """Drop the columns a dictionary flags; absent names are tolerated."""
    flagged = dictionary.filter(F.col(flag) == value)
    return df.drop(*[n for n, _ in pairs_of(flagged, name, flag)])


def catalogue_names(catalogue: DataFrame, groups: Sequence[str],
                    name: str = "varname", group: str = "namegroup") -> list[str]:
    """Variable names of the requested groups, in catalogue order, each once."""
    wanted = set(groups)
    rows = pairs_of(catalogue, name, group)
    return list(dict.fromkeys(n for n, g in rows if g in wanted))


def select_catalogued(df: DataFrame, catalogue: DataFrame, groups: Sequence[str],
                      always: Sequence[str] = ()) -> DataFrame:
    return pick(df, present(df, [*always, *catalogue_names(catalogue, groups)]))


def reorder(df: DataFrame, first: Sequence[str] = (), prefixes: Sequence[str] = ()) -> DataFrame:
    """Named columns, then one prefix after the other, then the rest."""
    front = list(first) + [c for p in prefixes for c in starting(df, p)]
    return pick(df, present(df, front + df.columns))


def across(df: DataFrame, cols: Iterable[str], fn: Callable[[Column], Column]) -> DataFrame:
    """Apply one expression to many columns in one projection."""
    return df.withColumns({c: fn(F.col(_q(c))) for c in cols})


def null_everywhere(df: DataFrame, cols: Sequence[str] | None = None) -> list[str]:
    """Names of columns that hold no value at all: one aggregate, one row back."""
    names = list(cols or df.columns)
    counts = df.agg(*[F.count(F.col(_q(c))).alias(str(i)) for i, c in enumerate(names)]).first()
    return [c for i, c in enumerate(names) if counts[i] == 0]


def drop_null_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    return df.drop(*null_everywhere(df, cols))


def blind(df: DataFrame, revealing: Sequence[str], parts: Sequence[str] = (),
          blinded: bool = True, arm: str = "group", labels: Mapping | None = None) -> DataFrame:
    """Drop what reveals the allocation, or else put the arm's name in place.

    ``revealing`` are names, ``parts`` are fragments of names.  A blinded
    frame keeps the arm column in its coded form.
    """
    if blinded:
        hidden = present(df, revealing) + [c for p in parts for c in containing(df, p)]
        return df.drop(*hidden)
    return df.withColumn(arm, recode(F.col(arm), labels))


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
