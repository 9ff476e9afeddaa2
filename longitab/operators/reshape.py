"""Wide <-> long, token arrays, unions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import plain_text, tokens, trim_all
from .schema import _q

MAX_PIVOT_COLUMNS = 2_000


def longer(df: DataFrame, ids: Sequence[str], var: str = "var", value: str = "val",
           drop_null: bool = False) -> DataFrame:
    """All columns but ``ids`` to (name, value as text) rows."""
    kinds = dict(df.dtypes)
    rest = [c for c in df.columns if c not in ids]
    texts = df.select(*ids, *[plain_text(F.col(_q(c)), kinds[c]).alias(c) for c in rest])
    long = texts.unpivot([F.col(i) for i in ids], [F.col(_q(c)) for c in rest], var, value)
    return long.filter(F.col(value).isNotNull()) if drop_null else long


def longer_split(df: DataFrame, ids: Sequence[str], pattern: str, names: Sequence[str],
                 value: str = "value") -> DataFrame:
    """As ``longer``, with the name cut into key columns by the groups of a pattern."""
    long = longer(df, ids, "__name", value)
    parts = [F.regexp_extract("__name", pattern, i).alias(n) for i, n in enumerate(names, start=1)]
    return long.select(*ids, *parts, value)


def wider(df: DataFrame, ids: Sequence[str], key: str, value: str, values: Sequence | None = None,
          order: str | None = None, fill: int | None = None) -> DataFrame:
    """(key, value) rows to one column per key.

    Give the list of key values; without it they are read from the data, up
    to a limit that keeps the result schema-sized.  ``order`` decides which
    row counts should a cell occur twice; without it the least value does.
    """
    if values is None:
        values = key_values(df, key)
    pick = (lambda v: F.min_by(value, F.when(F.col(key) == v, F.col(order)))) if order else (
        lambda v: F.min(F.when(F.col(key) == v, F.col(value))))
    wide = df.groupBy(*ids).agg(*[pick(F.lit(v)).alias(str(v)) for v in values])
    return wide.na.fill(fill, [str(v) for v in values]) if fill is not None else wide


def key_values(df: DataFrame, key: str, limit: int = MAX_PIVOT_COLUMNS) -> list:
    """Distinct keys for a pivot, sorted; fails if they cannot be columns."""
    rows = df.select(key).filter(F.col(key).isNotNull()).distinct().limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"column {key} has more than {limit} values, too many to be columns")
    return sorted(r[0] for r in rows)


def cell(parts: Sequence[Column | str], sep: str = "_") -> Column:
    """One pivot key out of several."""
    return F.concat_ws(sep, *parts)


def cells(*levels: Sequence, sep: str = "_") -> list[str]:
    """All combinations of several lists of levels, in order."""
    names = [""]
    for i, level in enumerate(levels):
        names = [n + (sep if i else "") + str(v) for n in names for v in level]
    return names


def explode_list(df: DataFrame, col: str, sep: str = ";", trim: bool = False,
                 drop_empty: bool = False) -> DataFrame:
    """One row per token; a null text stays one null row, empty tokens stay."""
    parts = tokens(col, sep)
    if trim:
        parts = F.transform(parts, trim_all)
    if drop_empty:
        parts = F.filter(parts, lambda t: t != "")
    return df.withColumn(col, F.explode_outer(parts))


def split_columns(df: DataFrame, col: str, into: Sequence[str], sep: str = ";") -> DataFrame:
    """Fixed number of columns: missing parts are null, further parts dropped."""
    parts = tokens(col, sep)
    return df.withColumns({n: F.get(parts, F.lit(i)) for i, n in enumerate(into)}).drop(col)


def explode_first(df: DataFrame, col: str, n: int | None, sep: str = ";", pos: str | None = None) -> DataFrame:
    """The first ``n`` tokens as rows, or all of them; a null text gives no row."""
    parts = tokens(col, sep) if n is None else F.slice(tokens(col, sep), 1, n)
    rest = [c for c in df.columns if c != col]
    exploded = df.select(*rest, F.posexplode(parts).alias(pos or "__pos", col))
    return exploded if pos else exploded.drop("__pos")


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Stack by name; absent columns are null, types are aligned first.

    A column that is text in one frame becomes text in all of them, numbers
    without an exponent.  A date beside a timestamp becomes a timestamp at
    midnight; decimals keep their digits beside whole numbers and each other.
    """
    kinds: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema:
            kinds[f.name] = _wider(kinds.get(f.name), f.dataType)
    out = None
    for df in frames:
        cast = df.select(*[_as(f, kinds[f.name]).alias(f.name) for f in df.schema])
        out = cast if out is None else out.unionByName(cast, allowMissingColumns=True)
    return out


def _as(field: T.StructField, kind: T.DataType) -> Column:
    col = F.col(_q(field.name))
    if isinstance(kind, T.StringType) and not isinstance(field.dataType, T.StringType):
        return plain_text(col, field.dataType.simpleString())
    return col.cast(kind)


def _decimal(kind: T.DataType) -> T.DecimalType | None:
    """A decimal type that holds all values of a decimal or whole type."""
    digits = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(digits[type(kind)], 0) if type(kind) in digits else None


def _wider(a: T.DataType | None, b: T.DataType) -> T.DataType:
    if a is None or a == b or isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
        if isinstance(a, whole) and isinstance(b, whole):
            return T.LongType()
        x, y = _decimal(a), _decimal(b)
        if x and y:
            scale = max(x.scale, y.scale)
            whole_digits = max(x.precision - x.scale, y.precision - y.scale)
            if whole_digits + scale <= 38:
                return T.DecimalType(whole_digits + scale, scale)
        return T.DoubleType()
    for stamp in (T.TimestampType, T.TimestampNTZType):
        if {type(a), type(b)} == {T.DateType, stamp}:
            return stamp()
    return T.StringType()
