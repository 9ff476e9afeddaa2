"""From collection events to one row per participant and timepoint."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import vocab as V
from ..functions.dates import parse_date, years_completed
from ..functions.recode import rank_of, recode
from ..operators import schema as S
from ..operators.collapse import coalesce_by_column
from ..operators.joins import semi_join

EXTRA = "_extra"
# What the baseline row gets of the pre-baseline row besides the block.
PREBASELINE_COPIES = {"completed_base": "completed_proms_mpre", "dob": "dob_pre"}
# Types a hash aggregate can hold.
FIXED_WIDTH = {"tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp", "timestamp_ntz"}


def tag_slots(df: DataFrame, event: str, events: Mapping[str, Sequence[str]],
              supplements: Mapping[str, Sequence[str]] = {}) -> DataFrame:
    """Add ``slot``: the timepoint, or ``<timepoint>_extra`` for a supplement.

    Rows of other events go.  The event list is a literal map, not a join.
    """
    table = {e: slot for slot, names in events.items() for e in names}
    table |= {e: slot + EXTRA for slot, names in supplements.items() for e in names}
    return df.filter(F.col(event).isin(*table)).withColumn("slot", recode(event, table))


def shared_columns(df: DataFrame, event: str, supplements: Mapping[str, Sequence[str]],
                   skip: Sequence[str], cohort: DataFrame | None = None,
                   by: str = "id") -> dict[str, list[str]]:
    """Per supplemented timepoint, the columns its supplement holds a value of.

    One aggregate over the supplement rows alone (the event filter reaches the
    scan), of the cohort if there is one; one row per supplement comes back.
    """
    slots = {e: slot for slot, names in supplements.items() for e in names}
    names = [c for c in df.columns if c not in skip]
    extra = df.filter(F.col(event).isin(*slots))
    if cohort is not None:
        extra = semi_join(extra, cohort, by)
    counts = (
        extra.groupBy(recode(event, slots).alias("__slot"))
        .agg(*[F.count(F.col(S._q(c))).alias(c) for c in names]).collect()
    )
    return {r["__slot"]: [c for c in names if r[c] > 0] for r in counts}


def merge_supplements(collapsed: DataFrame, by: str, shared: Mapping[str, Sequence[str]],
                      earliest: str | None, keep_unmatched: bool = False) -> DataFrame:
    """Fold each ``_extra`` row into its timepoint's main row.

    Shared columns come from whichever row was completed first (nulls last,
    ties to the main row); the others from the main row.  An id with only a
    supplement is dropped unless ``keep_unmatched``.  ``slot`` becomes
    ``timepoint``.

    (id, timepoint) has at most two rows here, so the window is small.
    """
    rows = collapsed.withColumns({
        "timepoint": F.regexp_replace("slot", EXTRA + "$", ""),
        "__extra": F.col("slot").endswith(EXTRA).cast("int"),
    }).drop("slot")
    pool = list(dict.fromkeys(c for cols in shared.values() for c in cols))
    first = [F.asc_nulls_last(earliest)] if earliest else []
    pair = W.partitionBy(by, "timepoint")
    if pool:
        winner = F.first(F.struct(*[F.col(S._q(c)) for c in pool])).over(pair.orderBy(*first, "__extra"))
        rows = rows.withColumn("__won", winner)
    rows = rows.withColumn("__alone", F.min("__extra").over(pair) == 1)
    stay = (F.col("__extra") == 0) | F.col("__alone") if keep_unmatched else F.col("__extra") == 0
    rows = rows.filter(stay)

    def settled(c):
        where = [t for t, cols in shared.items() if c in cols]
        return F.when(F.col("timepoint").isin(*where), F.col("__won")[c]).otherwise(F.col(S._q(c)))

    rest = [c for c in collapsed.columns if c not in (by, "slot")]
    return rows.select(by, "timepoint", *[
        settled(c).alias(c) if c in pool else F.col(S._q(c)) for c in rest
    ])


def assemble(df: DataFrame, by: str = "id", event: str = "redcap_event_name", order: str = "seq",
             events: Mapping[str, Sequence[str]] = V.EVENTS,
             supplements: Mapping[str, Sequence[str]] = V.SUPPLEMENTS,
             earliest: str | None = "completed_proms",
             shared: Mapping[str, Sequence[str]] | None = None,
             keep_unmatched: bool = False) -> DataFrame:
    """All timepoints in one collapse, supplements merged; unsorted.

    ``shared`` names the columns each supplement competes for; by default
    those are found in the data (one small job).
    """
    if shared is None:
        shared = shared_columns(df, event, supplements, (by, order)) if supplements else {}
    collapsed = coalesce_by_column(tag_slots(df, event, events, supplements), [by, "slot"], order)
    return merge_supplements(collapsed, by, shared, earliest, keep_unmatched)


# -- baseline --------------------------------------------------------------

def route_prebaseline(tagged: DataFrame, by: str, order: str, block: Sequence[str],
                      pre: str = "mpre", base: str = "m0") -> DataFrame:
    """Send the questionnaire block of pre-baseline rows to the baseline slot.

    A pre-baseline row becomes two: itself without the block, and a baseline
    row with nothing but the block, ``completed_proms_mpre`` and ``dob_pre``.
    The collapse that follows then does what a full join of the two collapsed
    timepoints would do.  Baseline rows give up their own, blank block.

    On pre-baseline rows the knee score counts as the patellofemoral one.
    """
    was_pre = F.col("slot") == pre
    split = tagged.withColumns({
        "__was_pre": was_pre,
        "slot": F.explode(F.when(was_pre, F.array(F.lit(pre), F.lit(base))).otherwise(F.array("slot"))),
    })
    moved = F.col("__was_pre") & (F.col("slot") == base)
    block = set(block)
    # The patellofemoral column each knee-score column stands in for.
    swap = {"pfoos" + c[4:]: c for c in S.starting(tagged, "koos")}
    out = []
    for c in tagged.columns:
        col = F.col(S._q(c))
        if c in (by, order, "slot"):
            out.append(col)
        elif c in block:
            out.append(F.when(moved | ~F.col("slot").isin(pre, base), col).alias(c))
        elif c.lower().startswith("pfoos"):
            pre_value = F.col(swap[c]) if c in swap else F.lit(None)
            out.append(F.when(moved, None).when(F.col("__was_pre"), pre_value).otherwise(col).alias(c))
        elif c.lower().startswith("koos"):
            out.append(F.when(~F.col("__was_pre"), col).alias(c))
        else:
            out.append(F.when(~moved, col).alias(c))
    for new, old in swap.items():
        if new not in tagged.columns:
            out.append(F.when(F.col("__was_pre") & ~moved, F.col(old)).alias(new))
    for old, new in PREBASELINE_COPIES.items():
        if old in tagged.columns:
            out.append(F.when(moved, F.col(old)).alias(new))
    return split.select(*out)


def one_per_id(side: DataFrame, by: str = "id", order: str = "seq") -> DataFrame:
    """One row per id: of each column the first value there is.

    Rows go by ``order``, if the table has it (it is not kept), else by their
    values, column by column, nulls first.  Rows without an id go.
    """
    rest = [c for c in side.columns if c not in (by, order)]
    place = F.struct(*[F.col(S._q(c)) for c in ([order] if order in side.columns else rest)])
    first = [F.min_by(F.col(S._q(c)), F.when(F.col(S._q(c)).isNotNull(), place)).alias(c) for c in rest]
    known = side.filter(F.col(by).isNotNull())
    return known.groupBy(by).agg(*first) if first else known.select(by).distinct()


def finish_baseline(df: DataFrame, by: str, side_tables: Sequence[DataFrame] = (), base: str = "m0",
                    slot: str = "slot", suffix: str = "_y") -> DataFrame:
    """Baseline rows: attach side tables, date, age; drop non-respondents.

    A side table counts with one row per id (see ``one_per_id``), so it never
    adds rows.  A column of it whose name the rows have already gets
    ``suffix``; the rows' own column stays as it is.
    ``baseline_date`` is taken before the completion date falls back on the
    pre-baseline one, so it stays null there; the age then uses the fall-back.
    """
    at_base = F.col(slot) == base
    for side in side_tables:
        side = one_per_id(side, by).withColumnsRenamed({c: c + suffix for c in side.columns if c in df.columns and c != by})
        side = side.withColumnRenamed(by, "__side_id")
        df = df.join(side, at_base & (F.col(by) == F.col("__side_id")), "left").drop("__side_id")
    df = df.withColumn("baseline_date", F.when(at_base, parse_date("completed_proms")))
    df = df.withColumns({
        "dob": F.when(at_base, F.coalesce("dob", "dob_pre")).otherwise(F.col("dob")),
        "completed_proms": F.when(at_base, F.coalesce("completed_proms", "completed_proms_mpre"))
        .otherwise(F.col("completed_proms")),
    })
    until = F.coalesce(F.col("baseline_date"), parse_date("completed_proms"))
    df = df.withColumn("age", F.when(at_base, years_completed(parse_date("dob"), until)))
    answered = F.col("completed_proms").isNotNull() & (F.col("completed_proms") != V.NOT_COMPLETED)
    return df.filter(~at_base | answered).drop("completed_proms_mpre", "dob_pre")


def study_timepoints(df: DataFrame, side_tables: Sequence[DataFrame] = (), by: str = "id",
                     event: str = "redcap_event_name", order: str = "seq",
                     block: Sequence[str] | None = None, filled: DataFrame | None = None,
                     cohort: DataFrame | None = None, keep_unmatched: bool = False) -> DataFrame:
    """The study's one row per (id, timepoint), baseline and supplements included.

    ``filled`` holds the few columns that were filled row by row, under the
    same id, event and order.  If it holds the rows of a ``cohort`` only, the
    result does too; pass the cohort's ids as well, so that supplements of
    others do not count.

    Numbers, texts and filled columns are collapsed apart and joined by (id,
    slot), by which all of them are partitioned already.  So numbers get by
    with a hash aggregate, where texts need a sort; each part reads its own
    columns; and nothing wide is shuffled before it has been collapsed.
    """
    if block is None:
        block = S.between(df, *V.PREBASELINE_BLOCK)
    keys = [by, event, order]
    parts = [df.select(*keys, *[F.col(S._q(c)) for c in names]) for names in _by_kind(df, keys) if names]
    if filled is not None:
        parts.append(filled.drop(*(set(df.columns) - set(keys))))
    shared: dict[str, list[str]] = {t: [] for t in V.SUPPLEMENTS}
    collapsed = None
    for part in parts:
        skip = (by, order, *S.starting(part, "koos"))
        for t, cols in shared_columns(part, event, V.SUPPLEMENTS, skip, cohort, by).items():
            shared[t] += [c for c in cols if c not in shared[t]]
        routed = route_prebaseline(tag_slots(part, event, V.EVENTS, V.SUPPLEMENTS), by, order, block)
        rows = coalesce_by_column(routed, [by, "slot"], order)
        collapsed = rows if collapsed is None else collapsed.join(rows.drop(event), [by, "slot"])
    # From here on an id has a handful of rows; with the id as partitioning
    # the joins and windows below need no further shuffle of this side.
    collapsed = finish_baseline(collapsed.repartition(by), by, side_tables)
    return merge_supplements(collapsed, by, shared, "completed_proms", keep_unmatched)


def _by_kind(df: DataFrame, keys: Sequence[str]) -> tuple[list[str], list[str]]:
    """Columns of variable and of fixed width; the swapped scores stay together."""
    wide, fixed = [], []
    for name, kind in df.dtypes:
        if name not in keys:
            together = name.lower().startswith(("koos", "pfoos"))
            (fixed if together or kind in FIXED_WIDTH else wide).append(name)
    return wide, fixed


def timepoint_rank(col: str = "timepoint"):
    return rank_of(col, V.TIMEPOINTS)
