"""Spatial functions on columns of WKB: Arrow functions that decode a batch once and measure all its rows together."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plinth.functions import geometry as g

METRES_PER_DEGREE = 111_320.0
WORLD = (-180.0, -90.0, 180.0, 90.0)
#: How much each kind of geometry (by its WKB code) is preferred.
RANKS = {1: 1, 2: 2, 3: 3, 6: 4}


DOUBLE, BOOLEAN, STRING, BINARY, LONG = T.DoubleType(), T.BooleanType(), T.StringType(), T.BinaryType(), T.LongType()


def _struct(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _doubles(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), mask=np.isnan(values))


def _numbers(column: pa.Array) -> np.ndarray:
    return column.cast(pa.float64()).fill_null(float("nan")).to_numpy()


def _known(flags: np.ndarray, *columns: pa.Array) -> pa.Array:
    """Flags, null where a column is null."""
    gone = np.zeros(len(flags), bool)
    for c in columns:
        gone |= c.is_null().to_numpy(zero_copy_only=False)
    return pa.array(flags, pa.bool_(), mask=gone)


@F.arrow_udf(DOUBLE)
def st_area(geometry: pa.Array) -> pa.Array:
    return _doubles(g.Shapes.from_wkb(geometry).area())


@F.arrow_udf(_struct(x=DOUBLE, y=DOUBLE))
def st_centroid(geometry: pa.Array) -> pa.Array:
    x, y = g.Shapes.from_wkb(geometry).centroid()
    return pa.StructArray.from_arrays([_doubles(x), _doubles(y)], names=["x", "y"], mask=pa.array(np.isnan(x)))


@F.arrow_udf(_struct(xmin=DOUBLE, ymin=DOUBLE, xmax=DOUBLE, ymax=DOUBLE))
def st_extent(geometry: pa.Array) -> pa.Array:
    box = g.Shapes.from_wkb(geometry).bounds()
    return pa.StructArray.from_arrays([_doubles(c) for c in box.T], names=["xmin", "ymin", "xmax", "ymax"], mask=pa.array(np.isnan(box[:, 0])))


@F.arrow_udf(DOUBLE)
def st_intersection_area(a: pa.Array, b: pa.Array) -> pa.Array:
    return _doubles(g.intersection_area(g.Shapes.from_wkb(a), g.Shapes.from_wkb(b)))


@F.arrow_udf(DOUBLE)
def st_union_area(a: pa.Array, b: pa.Array) -> pa.Array:
    s, t = g.Shapes.from_wkb(a), g.Shapes.from_wkb(b)
    return _doubles(s.area() + t.area() - g.intersection_area(s, t))


@F.arrow_udf(DOUBLE)
def st_iou(a: pa.Array, b: pa.Array) -> pa.Array:
    """Null where the united area is zero."""
    return _doubles(g.iou(g.Shapes.from_wkb(a), g.Shapes.from_wkb(b)))


@F.arrow_udf(BOOLEAN)
def st_intersects(a: pa.Array, b: pa.Array) -> pa.Array:
    return _known(g.intersects(g.Shapes.from_wkb(a), g.Shapes.from_wkb(b)), a, b)


@F.arrow_udf(BOOLEAN)
def st_within(x: pa.Array, y: pa.Array, geometry: pa.Array) -> pa.Array:
    return _known(g.within(_numbers(x), _numbers(y), g.Shapes.from_wkb(geometry)), x, y, geometry)


@F.arrow_udf(DOUBLE)
def st_distance(x: pa.Array, y: pa.Array, geometry: pa.Array) -> pa.Array:
    return _doubles(g.distance(_numbers(x), _numbers(y), g.Shapes.from_wkb(geometry)))


def st_dwithin(x: Column, y: Column, geometry: Column, reach: float) -> Column:
    return st_distance(x, y, geometry) <= reach


@F.arrow_udf(BINARY)
def st_convexhull(geometry: pa.Array) -> pa.Array:
    shapes = g.convex_hulls(g.Shapes.from_wkb(geometry))
    return pa.array([g.to_wkb(shapes.parts(k)) if shapes.kind[k] else None for k in range(len(shapes))], pa.binary())


@F.arrow_udf(BINARY)
def st_makevalid(geometry: pa.Array) -> pa.Array:
    """Polygons repaired (null if nothing is left); others as they are."""
    shapes, out = g.Shapes.from_wkb(geometry), []
    for k, raw in enumerate(geometry.to_pylist()):
        if shapes.kind[k] in (g.POLYGON, g.MULTIPOLYGON):
            parts = g.make_valid(shapes.parts(k))
            raw = g.to_wkb(parts) if parts else None
        out.append(raw if shapes.kind[k] else None)
    return pa.array(out, pa.binary())


@F.arrow_udf(BOOLEAN)
def st_isvalid(geometry: pa.Array) -> pa.Array:
    shapes = g.Shapes.from_wkb(geometry)
    return _known(np.array([k not in (g.POLYGON, g.MULTIPOLYGON) and k > 0 or k > 0 and g.is_valid(shapes.parts(i)) for i, k in enumerate(shapes.kind.tolist())], bool), geometry)


@F.arrow_udf(BOOLEAN)
def st_isempty(geometry: pa.Array) -> pa.Array:
    shapes = g.Shapes.from_wkb(geometry)
    return _known(np.diff(shapes.ring[shapes.first]) == 0, geometry)


@F.arrow_udf(STRING)
def st_astext(geometry: pa.Array) -> pa.Array:
    shapes = g.Shapes.from_wkb(geometry)
    return pa.array([g.to_wkt(shapes, k) if shapes.kind[k] else None for k in range(len(shapes))], pa.string())


@F.arrow_udf(BINARY)
def st_geomfromtext(text: pa.Array) -> pa.Array:
    return pa.array([g.from_wkt(t) if t else None for t in text.to_pylist()], pa.binary())


@F.arrow_udf(BINARY)
def st_polygon(ring: pa.Array) -> pa.Array:
    """A polygon from the x and y of a closed ring's vertices, in turn."""
    sizes = np.array([0 if n is None else n // 2 for n in ring.value_lengths().to_pylist()], np.int64)
    made = g.rings_wkb(np.concatenate([[0], np.cumsum(sizes)]), ring.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2))
    return pa.array([m if n else None for m, n in zip(made.to_pylist(), sizes.tolist(), strict=True)], pa.binary()) if (sizes == 0).any() else made


def st_makeenvelope(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    return st_polygon(F.array(*(c.cast("double") for c in (x0, y0, x1, y0, x1, y1, x0, y1, x0, y0))))


def st_transform(geometry: Column, source: int, target: int) -> Column:
    """Between degrees and web mercator; other pairs raise."""
    g.project(np.zeros(1), np.zeros(1), source, target)

    @F.arrow_udf(BINARY)
    def moved(column: pa.Array) -> pa.Array:
        shapes = g.Shapes.from_wkb(column)
        shapes.x, shapes.y = g.project(shapes.x, shapes.y, source, target)
        if (shapes.kind == g.POINT).all() and len(shapes.x) == len(shapes):
            return g.points_wkb(shapes.x, shapes.y)
        out = []
        for k, kind in enumerate(shapes.kind.tolist()):
            at = shapes.ring[shapes.first[k]]
            out.append(g.point_wkb(shapes.x[at], shapes.y[at]) if kind == g.POINT and shapes.first[k + 1] > shapes.first[k] else g.to_wkb(shapes.parts(k)) if kind in (g.POLYGON, g.MULTIPOLYGON) and shapes.first[k + 1] > shapes.first[k] else None)
        return pa.array(out, pa.binary())

    return moved(geometry)


def st_hilbert(geometry: Column, bounds: tuple[float, float, float, float] = WORLD) -> Column:
    """Place of the middle of the geometry's box on a Hilbert curve over the bounds; null geometries first."""

    @F.arrow_udf(LONG)
    def key(column: pa.Array) -> pa.Array:
        box = g.Shapes.from_wkb(column).bounds()
        made = g.hilbert((box[:, 0] + box[:, 2]) / 2, (box[:, 1] + box[:, 3]) / 2, bounds)
        return pa.array(made, pa.int64(), mask=np.isnan(box[:, 0]))

    return key(geometry)


def point_relation(x: Column, y: Column, geometry: Column, reach: float) -> Column:
    """struct<pass, metric>: 1 and the area if the point is inside, 2 and the area if it is inside the convex hull, 3 and the distance if that is
    at most ``reach``, else null. One decoding of the batch; hulls are made once for each different geometry that needs one."""

    @F.arrow_udf(T.StructType([T.StructField("pass", T.IntegerType()), T.StructField("metric", DOUBLE)]))
    def relate(x: pa.Array, y: pa.Array, column: pa.Array) -> pa.Array:
        px, py, shapes = _numbers(x), _numbers(y), g.Shapes.from_wkb(column)
        inside, area, box = g.within(px, py, shapes), shapes.area(), shapes.bounds()
        step = np.where(inside, 1, 0)
        with np.errstate(invalid="ignore"):
            maybe = np.flatnonzero(~inside & shapes.polygonal & (px > box[:, 0]) & (px < box[:, 2]) & (py > box[:, 1]) & (py < box[:, 3]))
        if len(maybe):
            codes = column.dictionary_encode().indices.to_numpy()
            _, one, which = np.unique(codes[maybe], return_index=True, return_inverse=True)
            hulls = g.convex_hulls(shapes.take(maybe[one])).take(which)
            step[maybe[g.within(px[maybe], py[maybe], hulls)]] = 2
        rest = np.flatnonzero(step == 0)
        far = g.distance(px[rest], py[rest], shapes.take(rest))
        metric = area.copy()
        metric[rest] = far
        with np.errstate(invalid="ignore"):
            step[rest[far <= reach]] = 3
        none = pa.array(step == 0)
        return pa.StructArray.from_arrays([pa.array(step, pa.int32()), _doubles(metric)], names=["pass", "metric"], mask=none)

    return relate(x, y, geometry)


def buffer_degrees(metres: float) -> float:
    return metres / METRES_PER_DEGREE


def geometry_rank(geometry: Column) -> Column:
    """By the kind in little- or big-endian WKB, without decoding: 1 of what has no rank."""
    little = F.conv(F.hex(F.substring(geometry, 2, 1)), 16, 10).cast("int")
    big = F.conv(F.hex(F.substring(geometry, 5, 1)), 16, 10).cast("int")
    kind = F.when(F.hex(F.substring(geometry, 1, 1)) == "01", little).otherwise(big)
    ranks = F.create_map(*(F.lit(v) for pair in RANKS.items() for v in pair))
    return F.coalesce(F.try_element_at(ranks, kind), F.lit(1))


def preferred(primary: Column, fallback: Column) -> Column:
    """The geometry of the higher rank; the primary one if they are equal."""
    return F.when(geometry_rank(fallback) > geometry_rank(primary), fallback).otherwise(primary)


def _plain(x: Column) -> Column:
    return F.regexp_replace(x.cast("string"), r"\.0$", "")


def point_text(x: Column, y: Column) -> Column:
    return F.concat(F.lit("POINT ("), _plain(x), F.lit(" "), _plain(y), F.lit(")"))
