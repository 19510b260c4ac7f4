"""Grid joins of boxes and points as equi-joins that Catalyst can shuffle, sort and re-plan.

A box has a level: the smallest at which a cell (cell * 2^level) is as wide as the box, so it meets at most four cells there. Two boxes
meet at the greater of their levels, in the one cell that holds the corner of their overlap, so no pair comes twice. Of each side
the boxes at their own level are joined with the other side's boxes that are smaller (or, on one side, as large), lifted to that level: small
boxes meet only where one of them has its level, so a huge box meets all that it must, and nothing else meets because of it. Boxes are only
lifted to levels that the other side has; these come from a scalar subquery of at most TOP_LEVEL + 1 numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOP_LEVEL = 24


def _sides(p: str) -> tuple[Column, ...]:
    return tuple(F.col(f"{p}{k}") for k in ("x0", "y0", "x1", "y1"))


def _level(p: str, cell: float) -> Column:
    x0, y0, x1, y1 = _sides(p)
    side = F.greatest(x1 - x0, y1 - y0, F.lit(cell))
    return F.least(F.ceil(F.log2(side / cell)).cast("int"), F.lit(TOP_LEVEL))


def _size(cell: float, level: Column) -> Column:
    return F.lit(cell) * F.pow(F.lit(2.0), level)


def _cells(df: DataFrame, p: str, cell: float, levels: Column) -> DataFrame:
    """df with a row for each of the levels (an array) and each cell it meets there: _g, _cx, _cy."""
    x0, y0, x1, y1 = _sides(p)
    at = df.withColumn("_g", F.explode(levels))
    span = lambda lo, hi: F.sequence(F.floor(lo / _size(cell, F.col("_g"))), F.floor(hi / _size(cell, F.col("_g"))))
    return at.withColumn("_cx", F.explode(span(x0, x1))).withColumn("_cy", F.explode(span(y0, y1)))


def _levels_of(df: DataFrame, p: str, cell: float) -> Column:
    return df.select(F.collect_set(_level(p, cell)).alias("levels")).scalar()


def box_join(left: DataFrame, right: DataFrame, lp: str, rp: str, cell: float) -> DataFrame:
    """All pairs whose closed boxes (columns {prefix}x0, y0, x1, y1) meet, each once; with the columns of both. Null boxes meet nothing."""
    (ax0, ay0, ax1, ay1), (bx0, by0, bx1, by1) = _sides(lp), _sides(rp)
    meets = (ax0 <= bx1) & (ax1 >= bx0) & (ay0 <= by1) & (ay1 >= by0)
    size = _size(cell, F.col("_g"))
    own = (F.col("_cx") == F.floor(F.greatest(ax0, bx0) / size)) & (F.col("_cy") == F.floor(F.greatest(ay0, by0) / size))

    def side(large: DataFrame, p: str, small: DataFrame, q: str, equal: bool) -> DataFrame:
        level = _level(q, cell)
        above = F.array_intersect(_levels_of(large, p, cell), F.sequence(level if equal else level + 1, F.lit(TOP_LEVEL + 1)))
        a, b = _cells(large, p, cell, F.array(_level(p, cell))), _cells(small, q, cell, above)
        return a.join(b, ["_g", "_cx", "_cy"]).filter(meets & own).select(*left.columns, *right.columns)

    return side(left, lp, right, rp, True).unionAll(side(right, rp, left, lp, False))


def point_join(points: DataFrame, boxes: DataFrame, x: str, y: str, bp: str, cell: float, reach: float = 0.0) -> DataFrame:
    """All pairs of a point and a box that, grown by ``reach``, holds it."""
    as_box = points.withColumns({"_px0": F.col(x), "_px1": F.col(x), "_py0": F.col(y), "_py1": F.col(y)})
    grown = boxes.withColumns({"_bx0": F.col(f"{bp}x0") - reach, "_bx1": F.col(f"{bp}x1") + reach, "_by0": F.col(f"{bp}y0") - reach, "_by1": F.col(f"{bp}y1") + reach})
    return box_join(as_box, grown, "_p", "_b", cell).drop("_px0", "_px1", "_py0", "_py1", "_bx0", "_bx1", "_by0", "_by1")
