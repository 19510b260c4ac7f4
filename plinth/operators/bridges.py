"""Crosswalks between building sources: footprints (an id, WKB and its box) with footprints, and points with footprints.

Candidates come from a grid join of boxes that stays in generated code; one Arrow function then measures each batch of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions import spatial
from plinth.operators.ranking import best_per
from plinth.operators.spatial_join import box_join, point_join

#: Cell of the grid, in the coordinates' unit: a few footprints wide. 0.001 degrees are about 100 m.
CELL = 0.001
SIDES = ["x0", "y0", "x1", "y1"]


def boxed(footprints: DataFrame, geometry: str = "geometry") -> DataFrame:
    """footprints with x0, y0, x1, y1: kept if there, else from the struct ``bbox``, else from the geometry."""
    if set(SIDES) <= set(footprints.columns):
        return footprints
    box, made = ("bbox", footprints) if "bbox" in footprints.columns else ("_box", footprints.withColumn("_box", spatial.st_extent(geometry)))
    return made.withColumns({s: F.col(f"{box}.{f}") for s, f in zip(SIDES, ("xmin", "ymin", "xmax", "ymax"), strict=True)}).drop("_box")


def _narrow(footprints: DataFrame, key: str, p: str) -> DataFrame:
    return boxed(footprints).select(*(F.col(c).alias(f"{p}{c}") for c in (key, "geometry", *SIDES)))


def iou_pairs(overture: DataFrame, fema: DataFrame, cell: float = CELL) -> DataFrame:
    """Every pair whose boxes meet: overture_id, fema_id, iou, and the second geometry."""
    pairs = box_join(_narrow(overture, "overture_id", "o_"), _narrow(fema, "fema_id", "f_"), "o_", "f_", cell)
    return pairs.select(F.col("o_overture_id").alias("overture_id"), F.col("f_fema_id").alias("fema_id"), spatial.st_iou("o_geometry", "f_geometry").alias("iou"), F.col("f_geometry").alias("fema_geometry"))


def fema_candidates(overture: DataFrame, fema: DataFrame, min_iou: float = 0.10, cell: float = CELL) -> DataFrame:
    pairs = iou_pairs(overture, fema, cell).filter(F.col("iou") >= min_iou)
    at = pairs.withColumn("at", spatial.st_centroid("fema_geometry"))
    return at.select("fema_id", "overture_id", "iou", spatial.point_text(F.col("at.x"), F.col("at.y")).alias("fema_centroid_wkt"))


def fema_bridge(overture: DataFrame, fema: DataFrame, min_iou: float = 0.10, cell: float = CELL) -> DataFrame:
    """Each second-source footprint's best match; a footprint may be the best match of many."""
    return best_per(fema_candidates(overture, fema, min_iou, cell), ["fema_id"], [F.desc_nulls_last("iou"), F.asc("overture_id")])


def nsi_candidates(points: DataFrame, footprints: DataFrame, reach: float, cell: float = CELL) -> DataFrame:
    """Pairs within reach with pass (1 inside, 2 inside the hull, 3 near) and metric (area, area, distance)."""
    pairs = point_join(points, _narrow(footprints, "overture_id", "o_"), "px", "py", "o_", cell, reach)
    tagged = pairs.withColumn("r", spatial.point_relation("px", "py", "o_geometry", reach)).filter(F.col("r").isNotNull())
    return tagged.select(*points.columns, "o_overture_id", F.col("r.pass").alias("pass"), F.col("r.metric").alias("metric"))


def _nsi_columns(*more) -> list:
    return ["nsi_id", *more, F.col("occtype").alias("nsi_occtype"), F.col("val_struct").alias("nsi_val_struct"), F.col("val_cont").alias("nsi_val_cont"), spatial.point_text(F.col("px"), F.col("py")).alias("nsi_point_wkt")]


def _method(step) -> F.Column:
    return F.when(step == 1, "point_in_polygon").when(step == 2, "convex_hull").otherwise("nearest_neighbor")


def nsi_bridge(points: DataFrame, footprints: DataFrame, reach: float, cell: float = CELL) -> DataFrame:
    """Each point's footprint: inside the smallest, else in the smallest hull, else the nearest within ``reach`` (in the coordinates' unit; see
    ``spatial.buffer_degrees``); one join and one window."""
    best = best_per(nsi_candidates(points, footprints, reach, cell), ["nsi_id"], [F.asc("pass"), F.asc_nulls_last("metric"), F.asc("o_overture_id")])
    return best.select(*_nsi_columns(F.col("o_overture_id").alias("overture_id")), _method(F.col("pass")).alias("match_method"))


def nsi_bridge_three_pass(points: DataFrame, footprints: DataFrame, reach: float, cell: float = CELL) -> DataFrame:
    """The same rows by three joins, each over what the ones before left."""
    found, left = None, points
    for step, radius in ((1, 0.0), (2, 0.0), (3, reach)):
        tagged = nsi_candidates(left, footprints, radius, cell).filter(F.col("pass") == step)
        best = best_per(tagged, ["nsi_id"], [F.asc_nulls_last("metric"), F.asc("o_overture_id")])
        rows = best.select(*_nsi_columns(F.col("o_overture_id").alias("overture_id")), _method(F.lit(step)).alias("match_method"))
        found = rows if found is None else found.unionByName(rows)
        left = left.join(rows.select("nsi_id"), "nsi_id", "left_anti")
    return found


def nsi_unmatched(points: DataFrame, bridge: DataFrame) -> DataFrame:
    return points.join(bridge.select("nsi_id"), "nsi_id", "left_anti").select(*_nsi_columns())


def nsi_fema_bridge(points: DataFrame, fema: DataFrame, cell: float = CELL) -> DataFrame:
    """The smallest second-source footprint that holds each point."""
    pairs = point_join(points, _narrow(fema, "fema_id", "f_"), "px", "py", "f_", cell)
    held = pairs.filter(spatial.st_within("px", "py", "f_geometry")).withColumn("metric", spatial.st_area("f_geometry"))
    best = best_per(held, ["nsi_id"], [F.asc_nulls_last("metric"), F.asc("f_fema_id")])
    return best.select(*_nsi_columns(F.col("f_fema_id").alias("fema_id")))


def nsi_review(unmatched: DataFrame, by_fema: DataFrame) -> DataFrame:
    """Unmatched points that the second source doesn't hold either; a null id matches nothing."""
    return unmatched.join(by_fema.select("nsi_id"), "nsi_id", "left_anti")
