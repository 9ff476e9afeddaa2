"""Left/right measures to affected/contralateral ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import plain_text
from ..operators import schema as S


def side_relative(df: DataFrame, side: str = "bl_aclrside", keep: Sequence[str] = (), as_text: bool = True,
                  left: str = "Left", right: str = "Right") -> DataFrame:
    """Replace ``l_*``/``r_*`` by ``a_*`` (affected) and ``c_*`` (contralateral).

    Which side is affected is known within the row, so this is a projection:
    no lengthening, no pivot, no join back.  A row without a known side has
    nulls.  Values become text, as they do when measures of mixed types share
    one column; ``as_text=False`` keeps the types.  ``keep`` names sided
    columns that are left alone.
    """
    kinds = dict(df.dtypes)
    sided = [c for c in S.starting(df, "l_", "r_") if c not in keep]
    lefts = {c[2:]: c for c in sided if c.lower().startswith("l_")}
    rights = {c[2:]: c for c in sided if c.lower().startswith("r_")}

    def value(c):
        return F.lit(None) if c is None else F.col(S._q(c))

    def text(c):
        return value(c) if c is None else plain_text(S._q(c), kinds[c])

    at, new = F.col(side), {}
    for var in dict.fromkeys([*lefts, *rights]):
        l, r = lefts.get(var), rights.get(var)
        types = {kinds[c] for c in (l, r) if c is not None}
        # measures of one type are made text after the choice: once a column, not once a side
        late = as_text and len(types) == 1
        one, other = (text(l), text(r)) if as_text and not late else (value(l), value(r))
        for name, first, second in ((f"a_{var}", one, other), (f"c_{var}", other, one)):
            chosen = F.when(at == left, first).when(at == right, second)
            new[name] = plain_text(chosen, *types) if late else chosen
    rest = [F.col(S._q(c)) for c in df.columns if c not in sided]
    return df.select(*rest, *[e.alias(n) for n, e in new.items()])


def surgery_counts(df: DataFrame, side: str = "bl_aclrside") -> DataFrame:
    """Name the per-knee surgery counts; they are known only where the side is."""
    known = F.col(side).isNotNull()
    return df.withColumns({
        "left_aclr_no": F.when(known, F.col("l_aclr_no")),
        "right_aclr_no": F.when(known, F.col("r_aclr_no")),
    }).drop("l_aclr_no", "r_aclr_no")
