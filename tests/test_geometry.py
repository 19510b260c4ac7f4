import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plinth.functions import geometry as g
from plinth.functions import spatial

C = [[np.array([[0, 0], [8, 0], [8, 6], [6, 6], [6, 2], [2, 2], [2, 6], [0, 6], [0, 0]], float)]]
HOLED = [[g.box(0, 0, 10, 10)[0][0], g.box(2, 2, 8, 8)[0][0]]]


def shapes(*parts):
    return g.Shapes.from_wkb(pa.array([None if p is None else p if isinstance(p, bytes) else g.to_wkb(p) for p in parts], pa.binary()))


def one(measure, a, b):
    return measure(shapes(a), shapes(b))[0]


def test_area_hull_centroid():
    s = shapes(C, HOLED, [*g.box(0, 0, 1, 1), *g.box(5, 5, 7, 7)], None, g.point_wkb(3, 4), b"nonsense")
    assert s.area()[:3].tolist() == [32, 64, 5] and np.isnan(s.area()[3:]).all()
    assert g.convex_hulls(shapes(C)).area()[0] == 48
    x, y = s.centroid()
    assert (x[1], y[1]) == pytest.approx((5, 5)) and (x[2], y[2]) == pytest.approx(((0.5 + 24) / 5, (0.5 + 24) / 5)) and (x[4], y[4]) == (3, 4) and np.isnan(x[3])
    far = shapes([[C[0][0] * 1e-5 + [-80.2, 25.7]]])
    assert far.centroid()[0][0] == pytest.approx(-80.2 + 1e-5 * shapes(C).centroid()[0][0], abs=1e-12)


def test_intersection_area():
    assert one(g.intersection_area, C, g.box(2, 2, 6, 6)) == 0
    assert one(g.intersection_area, C, g.box(1, 1, 7, 5)) == 24 - 12
    assert one(g.intersection_area, HOLED, g.box(5, 5, 20, 20)) == 25 - 9
    assert one(g.iou, g.box(0, 0, 2, 2), g.box(1, 0, 3, 2)) == pytest.approx(1 / 3)
    assert one(g.intersection_area, [*g.box(0, 0, 1, 1), *g.box(5, 5, 7, 7)], g.box(0.5, 0.5, 6, 6)) == 0.25 + 1
    assert np.isnan(one(g.intersection_area, None, C))


def test_intersection_area_of_any_polygons():
    """Against counting the points of a fine grid that lie in both."""
    r = random.Random(3)

    def star():
        n, cx, cy = r.randint(3, 9), r.uniform(2, 6), r.uniform(2, 6)
        at = sorted(r.uniform(0, 2 * math.pi) for _ in range(n))
        ring = [[cx + r.uniform(0.5, 4) * math.cos(t), cy + r.uniform(0.5, 4) * math.sin(t)] for t in at]
        return [[np.array([*ring, ring[0]])]]

    a, b = [star() for _ in range(12)], [star() for _ in range(12)]
    x, y = (v.ravel() for v in np.meshgrid(np.arange(-3, 11, 0.02) + 0.01, np.arange(-3, 11, 0.02) + 0.01))
    found = g.intersection_area(shapes(*a), shapes(*b))
    for k in range(12):
        inside = [g.within(x, y, shapes(p).take(np.zeros(len(x), np.int64))) for p in (a[k], b[k])]
        assert found[k] == pytest.approx((inside[0] & inside[1]).sum() * 0.0004, abs=0.15)
    assert (g.intersects(shapes(*a), shapes(*b)) == (found > 0)).all()


def test_predicates():
    at = lambda x, y, p: bool(g.within(np.array([x]), np.array([y]), shapes(p))[0])
    far = lambda x, y, p: float(g.distance(np.array([x]), np.array([y]), shapes(p))[0])
    assert at(1, 1, C) and not at(4, 4, C) and not at(0, 1, C) and not at(5, 5, HOLED) and not at(2, 5, HOLED)
    assert far(4, 4, C) == 2 and far(1, 1, C) == 0 and far(-3, -4, C) == 5 and far(0, 1, C) == 0
    assert one(g.intersects, g.box(0, 0, 1, 1), g.box(1, 1, 2, 2)) and one(g.intersects, g.box(0, 0, 9, 9), g.box(1, 1, 2, 2)) and one(g.intersects, g.box(1, 1, 2, 2), g.box(0, 0, 9, 9))
    assert not one(g.intersects, g.box(0, 0, 1, 1), g.box(2, 2, 3, 3)) and not one(g.intersects, HOLED, g.box(3, 3, 7, 7)) and not one(g.intersects, C, g.box(3, 3, 5, 5))
    assert one(g.intersects, g.box(3, 3, 4, 4), [*g.box(50, 50, 51, 51), *g.box(0, 0, 9, 9)])


def test_codecs():
    s = shapes(HOLED, [*HOLED, *C], C)
    assert s.kind.tolist() == [g.POLYGON, g.MULTIPOLYGON, g.POLYGON]
    assert all((a == b).all() for a, b in zip(s.parts(0)[0], HOLED[0], strict=True)) and len(s.parts(1)) == 2
    text = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 2, 1 1))"
    assert g.to_wkt(shapes(g.from_wkt(text)), 0) == text and shapes(g.from_wkt(text)).area()[0] == 15
    many = "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6.5 5, 6 6, 5 5)))"
    assert g.to_wkt(shapes(g.from_wkt(many)), 0) == many and g.from_wkt("LINESTRING (0 0, 1 1)") is None and g.from_wkt("") is None
    import struct

    z = struct.pack("<BII", 1, 1003, 1) + struct.pack("<I", 4) + np.array([[0, 0, 9], [2, 0, 9], [0, 2, 9], [0, 0, 9]], "<f8").tobytes()
    extended = struct.pack(">BIII", 0, 0x20000003, 4326, 1) + struct.pack(">I", 4) + np.array([[0, 0], [2, 0], [0, 2], [0, 0]], ">f8").tobytes()
    line = struct.pack("<BII", 1, 2, 2) + np.array([[0, 0], [1, 1]], "<f8").tobytes()
    s = shapes(z, extended, line, z[:20])
    assert s.area()[:2].tolist() == [2, 2] and np.isnan(s.area()[2:]).all() and s.kind.tolist()[2:] == [g.LINE, 0]
    assert not g.within(np.full(4, 0.5), np.full(4, 0.5), s)[2:].any()


def test_repair():
    made = g.make_valid([[np.array([[0, 0], [0, 2], [2, 2], [2, 2], [2, 0]], float)]])
    assert len(made) == 1 and shapes(made).area()[0] == 4 and g.is_valid(made)
    tie = [[np.array([[0, 0], [4, 2], [4, 0], [0, 2], [0, 0]], float)]]
    assert not g.is_valid(tie) and shapes(g.make_valid(tie)).area()[0] == 4 and len(g.make_valid(tie)) == 2 and g.is_valid(g.make_valid(tie))
    assert g.make_valid([[np.array([[0, 0], [1, 1], [0, 0]], float)]]) == []
    assert shapes(g.make_valid(HOLED)).area()[0] == 64


def test_hilbert_visits_neighbours():
    x, y = np.meshgrid(np.arange(8.0), np.arange(8.0))
    key = g.hilbert(x.ravel(), y.ravel(), (0, 0, 7, 7), 3)
    order = np.argsort(key)
    assert sorted(key) == list(range(64))
    assert (np.abs(np.diff(x.ravel()[order])) + np.abs(np.diff(y.ravel()[order])) == 1).all()


def test_projection():
    x, y = g.project(np.array([-80.2]), np.array([25.7]), 4326, 3857)
    assert (x[0], y[0]) == pytest.approx((math.radians(-80.2) * 6378137, math.asinh(math.tan(math.radians(25.7))) * 6378137), abs=1e-6)
    assert np.allclose(g.project(x, y, 3857, 4269), [[-80.2], [25.7]])
    with pytest.raises(ValueError):
        g.project(x, y, 4326, 32617)


def test_column_functions(spark):
    wkb = lambda p: bytearray(g.to_wkb(p))
    rows = [(wkb(C), wkb(g.box(1, 1, 7, 5)), 4.0, 4.0), (None, None, None, None), (bytearray(b"x"), wkb(C), 1.0, 1.0), (wkb(C), wkb(C), 9.0, 3.0), (wkb(C), wkb(C), 1.0, 1.0)]
    df = spark.createDataFrame(rows, "a binary, b binary, x double, y double")
    r = df.select(spatial.st_area("a").alias("area"), spatial.st_iou("a", "b").alias("iou"), spatial.st_intersects("a", "b").alias("meets"), spatial.st_within("x", "y", spatial.st_convexhull("a")).alias("hull"), spatial.st_distance("x", "y", "a").alias("far"), spatial.point_relation("x", "y", "a", 1.5).alias("r"), spatial.st_makevalid("a").alias("v"), spatial.st_isempty("a").alias("empty")).collect()
    assert (r[0].area, r[0].hull, r[0].far, r[0].meets) == (32.0, True, 2.0, True) and r[0].iou == pytest.approx(12 / 44)
    assert (r[1].area, r[1].iou, r[1].meets, r[1].r, r[1].v) == (None, None, None, None, None)
    assert r[2].area is None and r[2].meets is False and r[2].r is None and r[2].v is None
    assert [None if x.r is None else tuple(x.r) for x in r] == [(2, 32.0), None, None, (3, 1.0), (1, 32.0)]


def test_ranks(spark):
    many, point = bytearray(g.to_wkb([*C, *HOLED])), bytearray(g.point_wkb(1, 2))
    big = bytearray(__import__("struct").pack(">BI2d", 0, 1, 1, 2))
    df = spark.createDataFrame([(bytearray(g.to_wkb(C)), many), (bytearray(g.to_wkb(C)), point), (point, big), (None, point)], "a binary, b binary")
    made = df.select(spatial.geometry_rank(F.col("a")).alias("a"), spatial.geometry_rank(F.col("b")).alias("b"), spatial.preferred(F.col("a"), F.col("b")).alias("p")).collect()
    assert [(r.a, r.b) for r in made] == [(3, 4), (3, 1), (1, 1), (1, 1)] and made[0].p == many and made[2].p == point
