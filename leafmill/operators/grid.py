"""Joins of boxes that share area, inside a page, by grids.

A box lies in the cells that it touches, on the level whose cells are the first as large as it is and on all coarser
ones: four cells a level at most. A pair meets on the level of its larger box, in the one cell that holds the upper left corner
of what they share, so each pair is made once, and a box meets only what is near it or large. Rows of a table of boxes have the
keys, l, t, r and b; a box without area (or with a null) meets nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Width of the finest cells in points, by how much a level is coarser than the one before, and levels.
FINEST, COARSER, LEVELS = 32, 4, 6
#: Beyond so many cells of the coarsest level from the origin everything is in the last one.
FARTHEST = 4


def _width(level: Column) -> Column:
    return F.lit(FINEST) * F.pow(F.lit(COARSER), level)


def _cell(at: Column, level: Column) -> Column:
    most = float(FARTHEST * FINEST * COARSER ** (LEVELS - 1))
    return F.floor(F.greatest(F.least(at, F.lit(most)), F.lit(-most)) / _width(level)).cast("int")


def level_of(size: Column) -> Column:
    """The first level whose cells are as wide as `size`; the last if none is."""
    found = F.lit(LEVELS - 1)
    for k in range(LEVELS - 2, -1, -1):
        found = F.when(size <= FINEST * COARSER**k, F.lit(k)).otherwise(found)
    return found


def placed(boxes: DataFrame, keys: list[str], name: str, finer: bool = True) -> DataFrame:
    """keys, level, cx, cy and the box as a struct `name` with its own level, for each cell; without `finer` on its own level alone."""
    own = level_of(F.greatest(F.col("r") - F.col("l"), F.col("b") - F.col("t")))
    rows = boxes.select(*keys, F.struct(*[F.col(c) for c in boxes.columns], own.alias("own")).alias(name))
    at = lambda c: F.col(f"{name}.{c}")
    rows = rows.select("*", F.explode(F.sequence(at("own"), F.lit(LEVELS - 1) if finer else at("own"))).alias("level"))
    rows = rows.select("*", F.explode(F.sequence(_cell(at("l"), F.col("level")), _cell(at("r"), F.col("level")))).alias("cx"))
    return rows.select("*", F.explode(F.sequence(_cell(at("t"), F.col("level")), _cell(at("b"), F.col("level")))).alias("cy"))


def _met(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """a and b joined by cell, in as many parts as the session's shuffles have: placed boxes take so little room in a shuffle that
    Spark would join all of them in one task, whose memory grows with the pairs."""
    cell = [*keys, "level", "cx", "cy"]
    parts = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return a.repartition(parts, *cell).join(b.repartition(parts, *cell), cell)


def sharing(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """keys, a and b (structs of the tables' columns): the pairs whose boxes share area."""
    solid = "r > l and b > t"
    met = _met(placed(a.where(solid), keys, "a"), placed(b.where(solid), keys, "b"), keys)
    corner = lambda c, cell: _cell(F.greatest(F.col(f"a.{c}"), F.col(f"b.{c}")), F.col("level")) == F.col(cell)
    once = (F.col("level") == F.greatest("a.own", "b.own")) & corner("l", "cx") & corner("t", "cy")
    shared = (F.col("a.l") < F.col("b.r")) & (F.col("b.l") < F.col("a.r")) & (F.col("a.t") < F.col("b.b")) & (F.col("b.t") < F.col("a.b"))
    return met.where(once & shared).select(*keys, "a", "b")


def holding(points: DataFrame, boxes: DataFrame, keys: list[str]) -> DataFrame:
    """keys, a and b: the points (x, y) and the boxes that hold them, edges included."""
    at = points.select(*keys, F.struct(*[F.col(c) for c in points.columns]).alias("a"), F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level"))
    at = at.select("*", _cell(F.col("a.x"), F.col("level")).alias("cx"), _cell(F.col("a.y"), F.col("level")).alias("cy"))
    met = _met(at, placed(boxes.where("r >= l and b >= t"), keys, "b", finer=False), keys)
    return met.where("b.l <= a.x and a.x <= b.r and b.t <= a.y and a.y <= b.b").select(*keys, "a", "b")
