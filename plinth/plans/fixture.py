"""A deterministic building fixture from the part and orders tables, as DataFrames and as the same SQL.

Footprints are rectangles, some of the first source's with a notch [x0+2, x0+6] x [y0+2, y1] open at the top; as DataFrames they are WKB
polygons with their boxes, and only the SQL knows the formulas of these shapes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions import spatial
from plinth.functions.scoring import CLASSES, CODES

ALL_CODES = [c for codes in CODES.values() for c in codes]
OCC = "CASE WHEN k % 11 = 0 THEN NULL ELSE element_at(array({}), CAST(k % 7 AS INT) + 1) END".format(", ".join(f"'{c}'" for c in CLASSES))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("k"), F.col("p_size").cast("int").alias("s"))
    return p.selectExpr("k", "(k % 50) * 16.0D AS gx", "(k div 50) * 16.0D AS gy", "CAST(4 + s % 5 AS DOUBLE) AS h")


#: Cell of the grid joins and how near a point must be: 2 units.
CELL, REACH = 16.0, spatial.buffer_degrees(222_640.0)
PLAIN = "array(x0, y0, x1, y0, x1, y1, x0, y1, x0, y0)"
NOTCHED = "array(x0, y0, x1, y0, x1, y1, x0 + 6, y1, x0 + 6, y0 + 2, x0 + 2, y0 + 2, x0 + 2, y1, x0, y1, x0, y0)"


def overture(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parts(spark, sf_dir)
    shared = ["CAST(h AS DOUBLE) AS height", "CAST(k % 5 AS INT) AS num_floors", "CASE WHEN k % 2 = 0 THEN 'house' END AS overture_class", "named_struct('primary', concat('Building ', k)) AS names", "array(named_struct('dataset', CASE WHEN k % 3 = 0 THEN 'OpenStreetMap' ELSE 'other' END, 'record_id', CAST(k AS STRING)), named_struct('dataset', 'survey', 'record_id', 'x')) AS sources"]
    a = p.selectExpr("concat('a', k) AS overture_id", "gx AS x0", "gy AS y0", "gx + 8 AS x1", "gy + h AS y1", "k % 4 = 1 AS notch", *shared)
    b = p.filter("k % 40 = 0").selectExpr("concat('campus', k) AS overture_id", "gx - 1 AS x0", "gy - 1 AS y0", "gx + 30 AS x1", "gy + 30 AS y1", "false AS notch", *shared)
    return a.unionByName(b).withColumn("geometry", spatial.st_polygon(F.expr(f"CASE WHEN notch THEN {NOTCHED} ELSE {PLAIN} END"))).drop("notch")


def fema(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parts(spark, sf_dir)
    b = p.filter("k % 10 <> 7").selectExpr("concat('b', k) AS fema_id", "gx + k % 8 AS x0", "gy + k % 3 AS y0", "gx + k % 8 + 8 AS x1", "gy + k % 3 + h AS y1", f"{OCC} AS occ_cls")
    c = p.filter("k % 10 = 7").selectExpr("concat('c', k) AS fema_id", "gx + 11 AS x0", "gy + 11 AS y0", "gx + 15 AS x1", "gy + 15 AS y1", f"{OCC} AS occ_cls")
    d = p.filter("k % 5 = 1").selectExpr("concat('d', k) AS fema_id", "gx AS x0", "gy AS y0", "gx + 3 AS x1", "gy + h AS y1", f"{OCC} AS occ_cls")
    return b.unionByName(c).unionByName(d).withColumn("geometry", spatial.st_polygon(F.expr(PLAIN)))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = ", ".join(f"'{c}'" for c in ALL_CODES)
    code = f"CASE WHEN o % 35 < 33 THEN element_at(array({codes}), CAST(o % 35 AS INT) + 1) WHEN o % 35 = 33 THEN 'UNKNOWN' END AS occtype"
    o = _table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("long").alias("o"), F.col("o_custkey").cast("long").alias("c"), F.col("o_totalprice").cast("double").alias("v"))
    return o.selectExpr("o AS nsi_id", "(c % 50) * 16 + (o * 37 % 64) / 4.0D + 0.125D AS px", "(c div 50) * 16 + (o * 101 % 64) / 4.0D + 0.125D AS py", code, "v AS val_struct", "CASE WHEN o % 13 = 0 THEN NULL ELSE v / 2 END AS val_cont")


_OCC_SQL = f"CASE WHEN k % 11 = 0 THEN NULL ELSE ([{', '.join(repr(c) for c in CLASSES)}])[(k % 7)::INT + 1] END"
_AREA = "((x1 - x0) * (y1 - y0) - CASE WHEN notch THEN (y1 - y0 - 2.0) * 4.0 ELSE 0.0 END)"
_TO = "sqrt(greatest({0} - px, 0.0, px - {2}) * greatest({0} - px, 0.0, px - {2}) + greatest({1} - py, 0.0, py - {3}) * greatest({1} - py, 0.0, py - {3}))"
_NEAR = f"CASE WHEN notch THEN least({_TO.format('x0', 'y0', 'x1', '(y0 + 2)')}, {_TO.format('x0', 'y0', '(x0 + 2)', 'y1')}, {_TO.format('(x0 + 6)', 'y0', 'x1', 'y1')}) ELSE {_TO.format('x0', 'y0', 'x1', 'y1')} END"
_XY = "regexp_replace(({})::VARCHAR, '\\.0$', '')"


def _ring(points: str) -> str:
    """SQL that writes a polygon of x and y expressions."""
    pairs = [" || ' ' || ".join(_XY.format(v.strip()) for v in p.split(" , ")) for p in points.split("; ")]
    return "'POLYGON ((' || " + " || ', ' || ".join(pairs) + " || '))'"


PLAIN_TEXT = _ring("x0 , y0; x1 , y0; x1 , y1; x0 , y1; x0 , y0")
NOTCHED_TEXT = _ring("x0 , y0; x1 , y0; x1 , y1; x0 + 6 , y1; x0 + 6 , y0 + 2; x0 + 2 , y0 + 2; x0 + 2 , y1; x0 , y1; x0 , y0")
_CODES_SQL = f"[{', '.join(repr(c) for c in ALL_CODES)}]"


def wkt(x: str, y: str) -> str:
    return f"'POINT (' || regexp_replace(({x})::VARCHAR, '\\.0$', '') || ' ' || regexp_replace(({y})::VARCHAR, '\\.0$', '') || ')'"


_CLASS_CASE = "CASE " + " ".join(f"WHEN upper({{0}}) IN ({', '.join(repr(c) for c in codes)}) THEN '{name}'" for name, codes in CODES.items()) + " END"


def class_sql(code: str) -> str:
    return _CLASS_CASE.format(code)


#: Common table expressions, each ending in a comma.
CTE = f"""WITH pk AS (SELECT p_partkey::BIGINT AS k, (p_partkey % 50) * 16.0::DOUBLE AS gx, (p_partkey // 50) * 16.0::DOUBLE AS gy, (4 + p_size % 5)::DOUBLE AS h FROM part),
ov0 AS (SELECT 'a' || k AS overture_id, k, gx AS x0, gy AS y0, gx + 8 AS x1, gy + h AS y1, k % 4 = 1 AS notch, h FROM pk
  UNION ALL SELECT 'campus' || k, k, gx - 1, gy - 1, gx + 30, gy + 30, false, h FROM pk WHERE k % 40 = 0),
ov AS (SELECT overture_id, k, x0, y0, x1, y1, notch, h AS height, (k % 5)::INT AS num_floors, CASE WHEN k % 2 = 0 THEN 'house' END AS overture_class, '{{"primary":"Building ' || k || '"}}' AS names, {_AREA} AS a, CASE WHEN notch THEN {NOTCHED_TEXT} ELSE {PLAIN_TEXT} END AS shape FROM ov0),
fe0 AS (SELECT 'b' || k AS fema_id, gx + k % 8 AS x0, gy + k % 3 AS y0, gx + k % 8 + 8 AS x1, gy + k % 3 + h AS y1, {_OCC_SQL} AS occ_cls FROM pk WHERE k % 10 <> 7
  UNION ALL SELECT 'c' || k, gx + 11, gy + 11, gx + 15, gy + 15, {_OCC_SQL} FROM pk WHERE k % 10 = 7
  UNION ALL SELECT 'd' || k, gx, gy, gx + 3, gy + h, {_OCC_SQL} FROM pk WHERE k % 5 = 1),
fe AS (SELECT *, {PLAIN_TEXT} AS shape FROM fe0),
ns AS (SELECT o_orderkey::BIGINT AS nsi_id, (o_custkey % 50) * 16 + (o_orderkey * 37 % 64) / 4.0::DOUBLE + 0.125::DOUBLE AS px, (o_custkey // 50) * 16 + (o_orderkey * 101 % 64) / 4.0::DOUBLE + 0.125::DOUBLE AS py,
  CASE WHEN o_orderkey % 35 < 33 THEN ({_CODES_SQL})[(o_orderkey % 35)::INT + 1] WHEN o_orderkey % 35 = 33 THEN 'UNKNOWN' END AS occtype, o_totalprice::DOUBLE AS val_struct, CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice::DOUBLE / 2 END AS val_cont FROM orders),
pr AS (SELECT overture_id, fema_id, o.a, (f.x1 - f.x0) * (f.y1 - f.y0) AS b,
  greatest(0.0, least(o.x1, f.x1) - greatest(o.x0, f.x0)) * greatest(0.0, least(o.y1, f.y1) - greatest(o.y0, f.y0))
  - CASE WHEN o.notch THEN greatest(0.0, least(o.x0 + 6, f.x1) - greatest(o.x0 + 2, f.x0)) * greatest(0.0, least(o.y1, f.y1) - greatest(o.y0 + 2, f.y0)) ELSE 0.0 END AS i,
  (f.x0 + f.x1) / 2 AS mx, (f.y0 + f.y1) / 2 AS my FROM ov o JOIN fe f ON o.x0 <= f.x1 AND o.x1 >= f.x0 AND o.y0 <= f.y1 AND o.y1 >= f.y0),
iou AS (SELECT *, i / nullif(a + b - i, 0.0) AS iou FROM pr),
fb AS (SELECT fema_id, overture_id, iou, {wkt('mx', 'my')} AS fema_centroid_wkt FROM (SELECT *, row_number() OVER (PARTITION BY fema_id ORDER BY iou DESC NULLS LAST, overture_id) AS r FROM iou WHERE iou >= CAST(0.1 AS DOUBLE)) WHERE r = 1),
nc AS (SELECT ns.*, overture_id, a, px > x0 AND px < x1 AND py > y0 AND py < y1 AS hull, notch AND px >= x0 + 2 AND px <= x0 + 6 AND py >= y0 + 2 AS gap, {_NEAR} AS near
  FROM ns JOIN ov ON px >= x0 - 2 AND px <= x1 + 2 AND py >= y0 - 2 AND py <= y1 + 2),
np AS (SELECT *, CASE WHEN hull AND NOT gap THEN 1 WHEN hull THEN 2 WHEN near <= 2.0 THEN 3 END AS pass FROM nc),
nb0 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY nsi_id ORDER BY pass, CASE WHEN pass = 3 THEN near ELSE a END NULLS LAST, overture_id) AS r FROM np WHERE pass IS NOT NULL) WHERE r = 1),
nb AS (SELECT nsi_id, overture_id, occtype AS nsi_occtype, val_struct AS nsi_val_struct, val_cont AS nsi_val_cont, {wkt('px', 'py')} AS nsi_point_wkt, CASE pass WHEN 1 THEN 'point_in_polygon' WHEN 2 THEN 'convex_hull' ELSE 'nearest_neighbor' END AS match_method FROM nb0),
nu AS (SELECT nsi_id, occtype AS nsi_occtype, val_struct AS nsi_val_struct, val_cont AS nsi_val_cont, {wkt('px', 'py')} AS nsi_point_wkt FROM ns ANTI JOIN nb USING (nsi_id)),
nf AS (SELECT nsi_id, occtype AS nsi_occtype, val_struct AS nsi_val_struct, val_cont AS nsi_val_cont, {wkt('px', 'py')} AS nsi_point_wkt, fema_id FROM (SELECT ns.*, fema_id, row_number() OVER (PARTITION BY nsi_id ORDER BY (x1 - x0) * (y1 - y0), fema_id) AS r
  FROM ns JOIN fe ON px > x0 AND px < x1 AND py > y0 AND py < y1) WHERE r = 1),
rs AS (SELECT coalesce(ov.overture_id, 'fema_only_' || fe.fema_id) AS building_id, ov.overture_id, fe.fema_id, fb.iou AS fema_iou, height, num_floors, overture_class, names, occ_cls AS fema_occ_cls,
  CASE WHEN ov.overture_id IS NOT NULL THEN 'overture' WHEN fe.fema_id IS NOT NULL THEN 'fema_only' END AS source FROM ov FULL JOIN fb ON ov.overture_id = fb.overture_id FULL JOIN fe ON fb.fema_id = fe.fema_id),
gc AS (SELECT * EXCLUDE (r) FROM (SELECT *, CASE WHEN overture_id IS NULL THEN 1 ELSE count(fema_id) OVER (PARTITION BY overture_id) END AS fema_match_count,
  CASE WHEN overture_id IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY overture_id ORDER BY fema_iou DESC NULLS LAST, fema_id) END AS r FROM rs) WHERE r = 1),
vo AS (SELECT overture_id, round(coalesce(sum(nsi_val_struct), 0.0), 3) AS nsi_val_struct, round(coalesce(sum(nsi_val_cont), 0.0), 3) AS nsi_val_cont, count(nsi_id) AS nsi_point_count, arg_min(nsi_id, (-nsi_val_struct, nsi_id)) AS nsi_id FROM nb GROUP BY overture_id),
vf AS (SELECT fema_id, round(coalesce(sum(nsi_val_struct), 0.0), 3) AS nsi_val_struct, round(coalesce(sum(nsi_val_cont), 0.0), 3) AS nsi_val_cont, count(nsi_id) AS nsi_point_count, arg_min(nsi_id, (-nsi_val_struct, nsi_id)) AS nsi_id FROM nf GROUP BY fema_id),
en AS (SELECT gc.*, coalesce(vo.nsi_id, vf.nsi_id) AS nsi_id, coalesce(vo.nsi_val_struct, vf.nsi_val_struct) AS nsi_val_struct, coalesce(vo.nsi_val_cont, vf.nsi_val_cont) AS nsi_val_cont, coalesce(vo.nsi_point_count, vf.nsi_point_count) AS nsi_point_count
  FROM gc LEFT JOIN vo ON gc.overture_id = vo.overture_id LEFT JOIN vf ON gc.source = 'fema_only' AND vo.nsi_id IS NULL AND gc.fema_id = vf.fema_id),
eo AS (SELECT en.*, occtype AS nsi_occtype, en.nsi_id IS NOT NULL AS has_nsi_match, {class_sql('occtype')} AS nsi_class FROM en LEFT JOIN ns USING (nsi_id)),
gb AS (SELECT building_id, eo.overture_id, eo.fema_id, fema_iou, eo.height, eo.num_floors, eo.overture_class, eo.names, fema_occ_cls, source, fema_match_count::BIGINT AS fema_match_count,
  CASE WHEN eo.overture_id IS NOT NULL THEN o.shape ELSE f.shape END AS geometry,
  NULL::VARCHAR AS osm_id, NULL::VARCHAR AS osm_type, nsi_id, nsi_occtype, nsi_val_struct, nsi_val_cont, nsi_point_count, has_nsi_match,
  CASE WHEN eo.overture_id IS NOT NULL AND eo.fema_id IS NOT NULL AND fema_iou >= CAST(0.8 AS DOUBLE) THEN 1.0::DOUBLE WHEN eo.overture_id IS NULL AND eo.fema_id IS NOT NULL THEN 0.3::DOUBLE ELSE 0.6::DOUBLE END AS conflation_confidence,
  coalesce(fema_occ_cls, nsi_class) AS general_occupancy,
  CASE WHEN fema_occ_cls IS NOT NULL AND nsi_class IS NOT NULL THEN CASE WHEN fema_occ_cls = nsi_class THEN 1.0::DOUBLE ELSE 0.3::DOUBLE END WHEN fema_occ_cls IS NOT NULL THEN 0.8::DOUBLE WHEN nsi_class IS NOT NULL THEN 0.6::DOUBLE END AS occupancy_confidence
  FROM eo LEFT JOIN ov o ON eo.overture_id = o.overture_id LEFT JOIN fe f ON eo.fema_id = f.fema_id)
"""
