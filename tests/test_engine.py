import random

import duckdb
import pytest
from pyspark.sql import functions as F

from plinth.functions import geometry as g
from plinth.functions import scoring
from plinth.operators import bridges, gold, spatial_join
from plinth.operators.spatial_join import box_join
from plinth.plans import catalogue
from plinth.plans import fixture as fx
from plinth.sources import files, sinks

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("fema,code,kind,conf", [("Residential", "RES1", "Residential", 1.0), ("Commercial", "COM3", "Commercial", 1.0), ("Industrial", None, "Industrial", 0.8), (None, "COM1", "Commercial", 0.6), ("Commercial", "RES1", "Commercial", 0.3), (None, None, None, None), ("Government", "UNKNOWN", "Government", 0.8), (None, "UNKNOWN", None, None), ("Education", "EDU2", "Education", 1.0)])
def test_occupancy(spark, fema, code, kind, conf):
    df = spark.createDataFrame([(fema, code)], "f string, n string")
    assert tuple(df.select(scoring.general_occupancy(F.col("f"), F.col("n")), scoring.occupancy_confidence(F.col("f"), F.col("n"))).first()) == (kind, conf)


def test_codes(spark):
    codes = [("res1", "Residential"), ("Com4", "Commercial"), ("", None), ("XYZ99", None), (None, None), *((c, k) for k, cs in scoring.CODES.items() for c in cs)]
    df = spark.createDataFrame(codes, "c string, k string")
    assert df.filter(~scoring.occupancy_class(F.col("c")).eqNullSafe(F.col("k"))).count() == 0
    assert set(scoring.CODES) == set(scoring.CLASSES)


def test_confidence(spark):
    rows = [(True, True, 0.9, 1.0), (True, False, 0.0, 0.6), (False, True, 0.05, 0.3), (True, True, 0.80, 1.0), (True, True, 0.79, 0.6), (False, False, 0.0, 0.6)]
    df = spark.createDataFrame(rows, "o boolean, f boolean, i double, want double")
    assert df.filter(scoring.confidence(F.col("o"), F.col("f"), F.col("i")) != F.col("want")).count() == 0


@pytest.mark.parametrize("cell", [0.7, 3.0, 50.0])
def test_box_join_is_brute_force(spark, cell):
    r = random.Random(5)
    boxes = [(i, x := r.uniform(-20, 20), y := r.uniform(-20, 20), x + r.choice([0, 1, 4, 60]), y + r.choice([0, 2, 9])) for i in range(80)]
    a = spark.createDataFrame(boxes[:40], "a_id int, a_x0 double, a_y0 double, a_x1 double, a_y1 double")
    b = spark.createDataFrame(boxes[40:], "b_id int, b_x0 double, b_y0 double, b_x1 double, b_y1 double")
    want = sorted((p[0], q[0]) for p in boxes[:40] for q in boxes[40:] if p[1] <= q[3] and p[3] >= q[1] and p[2] <= q[4] and p[4] >= q[2])
    assert sorted(map(tuple, box_join(a, b, "a_", "b_", cell).select("a_id", "b_id").collect())) == want


def test_single_pass_is_three_pass(spark):
    o, n = fx.overture(spark, D), fx.points(spark, D)
    one, three = (f(n, o, fx.REACH, fx.CELL).persist() for f in (bridges.nsi_bridge, bridges.nsi_bridge_three_pass))
    assert one.exceptAll(three).count() == 0 and three.exceptAll(one).count() == 0


def test_resolve_is_collapsed_full_outer(spark):
    o, f = fx.overture(spark, D), fx.fema(spark, D)
    b = bridges.fema_bridge(o, f, cell=fx.CELL).persist()
    x, y = gold.resolve(o, b, f), gold.collapse(gold.full_outer(o, b, f))
    assert x.exceptAll(y.select(x.columns)).count() == 0 and x.count() == y.count() == 255


def test_one_huge_box_costs_little(spark):
    """A box as wide as the map among 40,000 a side, and no pair lost."""

    def side(p, extra):
        boxes = spark.range(40_000).selectExpr(f"id AS {p}id", f"id % 200 * 8.0D AS {p}x0", f"id div 200 * 8.0D AS {p}y0").withColumns({f"{p}x1": F.col(f"{p}x0") + 4, f"{p}y1": F.col(f"{p}y0") + 4})
        return boxes.unionByName(spark.createDataFrame([(-1, 0.0, 0.0, 1600.0, 1600.0)], f"{p}id long, {p}x0 double, {p}y0 double, {p}x1 double, {p}y1 double")) if extra else boxes

    def compared(extra):
        """Rows that meet in a cell: what the join's filters are given."""
        rows = 0
        for (large, p), (small, q), equal in (((side("a_", extra), "a_"), (side("b_", False), "b_"), True), ((side("b_", False), "b_"), (side("a_", extra), "a_"), False)):
            level = spatial_join._level(q, 8.0)
            above = F.array_intersect(spatial_join._levels_of(large, p, 8.0), F.sequence(level if equal else level + 1, F.lit(spatial_join.TOP_LEVEL + 1)))
            rows += spatial_join._cells(large, p, 8.0, F.array(spatial_join._level(p, 8.0))).join(spatial_join._cells(small, q, 8.0, above), ["_g", "_cx", "_cy"]).count()
        return rows

    assert box_join(side("a_", True), side("b_", False), "a_", "b_", 8.0).count() == 80_000
    # the huge box meets each of the others in the cell or two where they lie, and nothing else is compared because of it
    assert compared(True) <= compared(False) + 4 * 40_000


def test_ties_and_nulls(spark):
    """Equal areas go to the smaller id; null and empty geometries, points without a place and unmatched ids stay out."""
    def box(i, x0, y0, x1, y1):
        return (i, bytearray(g.to_wkb(g.box(x0, y0, x1, y1))))

    o = spark.createDataFrame([box("b", 0, 0, 2, 2), box("a", 0, 0, 2, 2), box("c", 5, 5, 6, 6), ("n", None), ("e", bytearray(bytes.fromhex("010300000000000000")))], "overture_id string, geometry binary")
    n = spark.createDataFrame([(1, 1.0, 1.0), (2, 6.5, 5.5), (3, 60.0, 1.0), (4, None, 1.0)], "nsi_id long, px double, py double").selectExpr("*", "'RES1' AS occtype", "1.0D AS val_struct", "2.0D AS val_cont")
    found = bridges.nsi_bridge(n, o, 1.0, 1.0)
    assert sorted((r.nsi_id, r.overture_id, r.match_method) for r in found.collect()) == [(1, "a", "point_in_polygon"), (2, "c", "nearest_neighbor")]
    assert sorted(r.nsi_id for r in bridges.nsi_unmatched(n, found).collect()) == [3, 4]
    f = o.withColumnRenamed("overture_id", "fema_id")
    assert sorted((r.fema_id, r.overture_id) for r in bridges.fema_bridge(o, f, cell=1.0).collect()) == [("a", "a"), ("b", "a"), ("c", "c")]


def test_invariants_of_gold(spark):
    o, f, n = fx.overture(spark, D), fx.fema(spark, D), fx.points(spark, D)
    b, nb = bridges.fema_bridge(o, f, cell=fx.CELL).persist(), bridges.nsi_bridge(n, o, fx.REACH, fx.CELL).persist()
    made = gold.produce(o, f, b, nb, bridges.nsi_fema_bridge(n, f, fx.CELL)).persist()
    assert made.count() == made.select("building_id").distinct().count() == o.count() + f.join(b, "fema_id", "left_anti").count()
    assert made.columns[-2:] == ["osm_id", "osm_type"] and {"names", "geometry"} <= set(made.columns)
    assert nb.count() + bridges.nsi_unmatched(n, nb).count() == n.count()
    assert b.filter("iou < 0.1 OR iou > 1").count() == 0


def test_values_of_no_points(spark):
    df = spark.createDataFrame([("a", 1, "RES1", None, None), ("a", 2, "RES2", None, 3.5), ("b", 3, None, 1e17, 0.1), (None, 4, "X", 1.0, 1.0)], "overture_id string, nsi_id long, nsi_occtype string, nsi_val_struct double, nsi_val_cont double")
    assert sorted(map(tuple, gold.primary_values(df, "overture_id").collect())) == [("a", 1, "RES1", 0.0, 3.5, 2), ("b", 3, None, 1e17, 0.1, 1)]


def test_confidence_summary(spark):
    df = spark.createDataFrame([(1.0,), (0.6,), (0.3,)], "conflation_confidence double")
    assert scoring.confidence_summary(df).first().asDict() == {"total": 3, "high": 1, "medium": 1, "low": 1, "pct_high": 33.3, "pct_medium": 33.3, "pct_low": 33.3}
    assert scoring.confidence_summary(df.limit(0)).first()["pct_high"] == 0.0


def test_pushed_to_the_reader(spark, tmp_path):
    o = spark.range(10).selectExpr("id", "named_struct('xmin', id * 1.0D, 'ymin', 0.0D, 'xmax', id + 0.5D, 'ymax', 1.0D) AS bbox", "id AS unused")
    sinks.write_parquet(o, str(tmp_path / "x"))
    read = files.parquet(spark, str(tmp_path / "x"), ["id"], (2.2, 0.0, 4.0, 1.0))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = read._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "LessThanOrEqual(bbox.xmin,4.0)" in plan and "unused" not in plan.split("ReadSchema")[1]
    assert sorted(r.id for r in read.collect()) == [2, 3, 4]


def test_every_query_has_sql():
    assert set(catalogue.QUERIES) == set(catalogue.SQL)


@pytest.mark.parametrize("name", ["gold_buildings", "fema_bridge_best", "nsi_review_points", "surrogate_id", "release_latest", "index_scrape", "spatial_intersects_join", "area_centroid", "make_valid", "geometry_rank_pick", "confidence_colours", "point_pick", "cell_partition_write", "vector_tiles"])
def test_against_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("part", "orders", "pages", "nation"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    found = catalogue.QUERIES[name](spark, D)
    cols = sorted(found.columns)
    key = lambda rows: sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=str)
    assert key(map(tuple, found.select(*cols).collect())) == key(con.execute(f"SELECT {', '.join(cols)} FROM ({catalogue.SQL[name]})").fetchall())
