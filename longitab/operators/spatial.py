"""Point-in-area assignment."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage
from .rows import first_per_group


#: Cells an area may have on average, coarse and fine.
CELLS = 4
#: Levels tried below one cell for all areas, and halvings of a coarse cell.
LEVELS, HALVINGS = 40, 12


def _is_parts(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.ArrayType)


def _edges(ring: Column) -> Column:
    n = F.size(ring)
    return F.transform(ring, lambda p, i: F.struct(
        p["x"].alias("ax"), p["y"].alias("ay"),
        F.get(ring, (i + 1) % n)["x"].alias("bx"), F.get(ring, (i + 1) % n)["y"].alias("by"),
    ))


def inside(x: Column, y: Column, ring: Column, parts: bool = False) -> Column:
    """Whether a point lies in a ring of ``struct<x,y>`` corners or on its edge.

    With ``parts`` it is an array of rings: outer ones, and holes in them, in
    any order.  A point is inside if a ray from it crosses all rings' edges an
    odd number of times, so it is outside in a hole and inside on its edge.
    """
    corners = F.flatten(F.transform(ring, _edges)) if parts else _edges(ring)

    def crosses(e: Column) -> Column:
        spans = (e["ay"] > y) != (e["by"] > y)
        at = e["ax"] + (y - e["ay"]) * (e["bx"] - e["ax"]) / F.nullif(e["by"] - e["ay"], F.lit(0.0))
        return spans & (x < at)

    def touches(e: Column) -> Column:
        cross = (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])
        return (
            (cross == 0)
            & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
            & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))
        )

    odd = F.size(F.filter(corners, crosses)) % 2 == 1
    return odd | F.exists(corners, touches)


def _span(lo: str, hi: str, step: float | Column, least: Column | None = None, most: Column | None = None) -> tuple[Column, Column]:
    """First and last cell between two coordinates, within a coarse cell's if given."""
    first, last = F.floor(F.col(lo) / step), F.floor(F.col(hi) / step)
    return (first, last) if least is None else (F.greatest(first, least), F.least(last, most))


def _n_cells(x: tuple[Column, Column], y: tuple[Column, Column]) -> Column:
    return (x[1] - x[0] + 1).cast("double") * (y[1] - y[0] + 1).cast("double")


def _coarse_step(boxed: DataFrame) -> float:
    """Size of the smallest cells of which the areas have ``CELLS`` each on average."""
    extent = boxed.agg(F.max(F.greatest(F.col("__x1") - F.col("__x0"), F.col("__y1") - F.col("__y0"))), F.count("*")).first()
    top = 2.0 ** math.ceil(math.log2(max(extent[0] or 1.0, 1e-9)))
    steps = [top / 2 ** k for k in range(LEVELS)]
    sums = boxed.agg(*[F.sum(_n_cells(_span("__x0", "__x1", s), _span("__y0", "__y1", s))) for s in steps]).first()
    fits = [s for s, n in zip(steps, sums) if n is not None and n <= CELLS * extent[1]]
    return min(fits, default=top)


def _fine(least: str, most: str, cell: str, step: float, halvings: int | Column) -> tuple[Column, Column]:
    """The cells of a halved coarse cell between two coordinates."""
    times = F.pow(F.lit(2.0), halvings if isinstance(halvings, Column) else F.lit(halvings))
    first = F.col(cell) * times.cast("long")
    return _span(least, most, F.lit(step) / times, first, first + times.cast("long") - 1)


def assign_areas(points: DataFrame, areas: DataFrame, key: str, x: str, y: str, code: str,
                 ring: str = "ring", keep: Sequence[str] = ()) -> DataFrame:
    """Give each point its area; points outside all areas are dropped.

    ``key`` need not be unique; of several areas the lowest ``code`` counts.
    ``ring`` holds corners, or an array of rings where areas have holes or
    several parts.

    Areas are covered by cells of two sizes.  Coarse cells are as small as they
    can be with ``CELLS`` an area on average; each is halved as often as keeps
    that average for the areas in it, so cells are small where areas are.  A
    point looks up its coarse cell, one row, and then its cell in that: it
    leaves the scan once, whatever the mix of sizes.  The exact test follows.
    """
    parts = _is_parts(areas.schema[ring].dataType)
    corners = F.flatten(F.col("__ring")) if parts else F.col("__ring")
    boxed = stage(areas.select(F.col(code), *keep, F.col(ring).alias("__ring")).select(
        "*",
        F.array_min(F.transform(corners, lambda p: p["x"])).alias("__x0"),
        F.array_max(F.transform(corners, lambda p: p["x"])).alias("__x1"),
        F.array_min(F.transform(corners, lambda p: p["y"])).alias("__y0"),
        F.array_max(F.transform(corners, lambda p: p["y"])).alias("__y1"),
    ).where("__x0 is not null and __y0 is not null"))
    step = _coarse_step(boxed)
    coarse = boxed.withColumn("__cx", F.explode(F.sequence(*_span("__x0", "__x1", step)))).withColumn(
        "__cy", F.explode(F.sequence(*_span("__y0", "__y1", step))))
    sums = {h: F.sum(_n_cells(_fine("__x0", "__x1", "__cx", step, h), _fine("__y0", "__y1", "__cy", step, h))) for h in range(1, HALVINGS + 1)}
    n = F.count("*")
    halved = F.greatest(F.lit(0), *[F.when(total <= CELLS * (n + CELLS), F.lit(h)).otherwise(F.lit(0)) for h, total in sums.items()])
    depths = stage(coarse.groupBy("__cx", "__cy").agg(halved.alias("__halved")))
    covered = coarse.join(depths, ["__cx", "__cy"])
    for axis in "xy":
        covered = covered.withColumn(f"__f{axis}", F.explode(F.sequence(*_fine(f"__{axis}0", f"__{axis}1", f"__c{axis}", step, F.col("__halved")))))
    covered = covered.drop("__cx", "__cy")

    located = (
        points.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .withColumn("__row", F.monotonically_increasing_id())  # keys may repeat
        .withColumn("__cx", F.floor(F.col(x) / step)).withColumn("__cy", F.floor(F.col(y) / step))
        .join(depths, ["__cx", "__cy"])
    )
    fine = F.lit(step) / F.pow(F.lit(2.0), "__halved")
    located = located.withColumn("__fx", F.floor(F.col(x) / fine)).withColumn("__fy", F.floor(F.col(y) / fine)).drop("__cx", "__cy")
    near = located.join(covered, ["__halved", "__fx", "__fy"])
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    in_box = px.between(F.col("__x0"), F.col("__x1")) & py.between(F.col("__y0"), F.col("__y1"))
    hits = near.filter(in_box & inside(px, py, F.col("__ring"), parts))
    return first_per_group(hits, [key, "__row"], [code]).select(*points.columns, code, *keep)
