"""Order-aware fills within groups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage, unstage

DIRECTIONS = ("down", "up", "downup", "updown")
TWO_WAY = ("downup", "updown")
ROWS_PER_BLOCK = 1 << 20
#: Blocks whose ends one window reads; more are carried across in a tree.
FAN = 1024
#: Where ``monotonically_increasing_id`` keeps the partition.
PART = 1 << 33


def fill(df: DataFrame, cols: Sequence[str] | Mapping[str, str], by: Sequence[str], order: str,
         direction: str = "down", rows_per_block: int | None = ROWS_PER_BLOCK) -> DataFrame:
    """Fill nulls from the nearest earlier (down) or later (up) value of the group.

    ``downup`` takes the earlier value, else the later one; ``updown`` the
    other way round.  ``cols`` may map each column to its own direction, which
    fills them all in one pass.  ``order`` is an integer column, unique within
    a group; gaps in it do not matter.

    A window puts a whole group into one task.  The input is read once and
    staged; where a group has more than ``rows_per_block`` rows, it is dealt by
    ranges of (group, order) and cut into blocks of that many consecutive rows
    at most, counted, not estimated.  Of each block the first and the last
    value of each column are kept (combined before the shuffle).  What a block
    inherits is carried over those ends in a tree of windows of at most ``FAN``
    blocks, and travels to its block as one extra row in front of it.  Where no
    group is that large, a window per group does.

    Pass ``rows_per_block=None`` where groups are small by construction; then
    nothing is staged.
    """
    ways = dict(cols) if isinstance(cols, Mapping) else dict.fromkeys(cols, direction)
    if not set(ways.values()) <= set(DIRECTIONS):
        raise ValueError(f"a direction must be one of {DIRECTIONS}")
    if rows_per_block is None:
        return _fill_within(df, df.columns, ways, [*by], order)

    width = int(rows_per_block)
    base = stage(df)
    sizes = base.groupBy(*by).agg(F.count("*").alias("__n")).agg(F.max("__n"), F.sum("__n")).first()
    if (sizes[0] or 0) <= width:
        return _fill_within(base, df.columns, ways, [*by], order)
    place = [*[F.asc_nulls_first(k) for k in by], F.asc_nulls_first(order)]
    dealt = stage(
        base.repartitionByRange(-(-sizes[1] // width), *place).sortWithinPartitions(*place)
        .withColumn("__at", F.monotonically_increasing_id()))
    unstage(base)
    # ranges come from a sample: one with more rows than a block holds is cut by its rows' numbers
    inner = F.floor(F.col("__at") % PART / width)
    per_part, parts = (1 + n for n in dealt.agg(F.max(inner), F.max(F.floor(F.col("__at") / PART))).first())
    rows = dealt.select(*df.columns, (F.floor(F.col("__at") / PART) * per_part + inner).alias("__block"))
    fronts = _inherited(rows, ways, by, order, parts * per_part)
    both = rows.withColumn("__front", F.lit(False)).unionByName(fronts, allowMissingColumns=True)
    return _fill_within(both, df.columns, ways, [*by, "__block"], order)


def _spare(col: str) -> str:
    return f"__spare_{col}"


def _fill_within(df, keep, ways, part, order):
    """Fill inside each partition; the inherited row, if any, comes first."""
    front = [F.col("__front").desc()] if "__front" in df.columns else []
    exprs = {}
    for c, way in ways.items():
        step = F.asc(order) if way.startswith("down") else F.desc(order)
        ordered = W.partitionBy(*part).orderBy(*front, step)
        so_far = ordered.rowsBetween(W.unboundedPreceding, W.currentRow)
        whole = ordered.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        tries = [F.last(c, ignorenulls=True).over(so_far)]
        if way in TWO_WAY:
            # Nothing on this side, so the nearest on the other is the first of all.
            tries.append(F.first(c, ignorenulls=True).over(whole))
            if front:
                tries.append(F.first(_spare(c), ignorenulls=True).over(whole))
        exprs[c] = F.coalesce(*tries)
    filled = df.withColumns(exprs)
    if front:
        filled = filled.filter(~F.col("__front"))
    return filled.select(*keep)


def _inherited(rows, ways, by, order, n_blocks):
    """One row per later (or earlier) block of a group with what it inherits."""
    ends = []
    for c in ways:
        at = F.when(F.col(c).isNotNull(), F.col(order))
        ends += [F.max_by(c, at).alias(f"__last_{c}"), F.min_by(c, at).alias(f"__first_{c}")]
    blocks = _carried(stage(rows.groupBy(*by, "__block").agg(*ends)), list(ways), by, n_blocks)
    values = {}
    for c, way in ways.items():
        down, up = F.col(f"__down_{c}"), F.col(f"__up_{c}")
        main, other = (down, up) if way.startswith("down") else (up, down)
        values[c] = main
        if way in TWO_WAY:
            values[_spare(c)] = other
    fronts = blocks.select(*by, "__block", *[v.alias(n) for n, v in values.items()])
    useful = reduce(or_, [F.col(n).isNotNull() for n in values])
    return fronts.filter(useful).withColumn("__front", F.lit(True))


def _carried(ends, cols, by, n):
    """For each end (group, number below ``n``) the last value before it and the first after it."""
    wide = n > FAN
    mine = ends.withColumn("__up", F.floor(F.col("__block") / FAN)) if wide else ends
    part = W.partitionBy(*by, *(["__up"] if wide else []))
    before = part.orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    after = part.orderBy(F.desc("__block")).rowsBetween(W.unboundedPreceding, -1)
    near = mine.select("*", *[F.last(f"__last_{c}", ignorenulls=True).over(before).alias(f"__down_{c}") for c in cols],
                       *[F.last(f"__first_{c}", ignorenulls=True).over(after).alias(f"__up_{c}") for c in cols])
    found = [f"__{way}_{c}" for c in cols for way in ("down", "up")]
    if not wide:
        return near.select(*by, "__block", *found)
    outer = []
    for c in cols:
        for end, pick in (("last", F.max_by), ("first", F.min_by)):
            value = F.col(f"__{end}_{c}")
            outer.append(pick(value, F.when(value.isNotNull(), F.col("__block"))).alias(f"__{end}_{c}"))
    above = _carried(stage(mine.groupBy(*by, F.col("__up").alias("__block")).agg(*outer)), cols, by, -(-n // FAN))
    above = above.select(F.col("__block").alias("__over"), *[F.col(k).alias(f"__of_{k}") for k in by],
                         *[F.col(f).alias(f"__far{f}") for f in found])
    same = [F.col(k).eqNullSafe(F.col(f"__of_{k}")) for k in by]
    return near.join(above, reduce(and_, [F.col("__up") == F.col("__over"), *same]), "left").select(
        *by, "__block", *[F.coalesce(f, f"__far{f}").alias(f) for f in found])
