"""Sources, sinks, flows and the command line on small files."""

import http.server
import json
import sqlite3
import struct
import threading
import zipfile

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from plinth import cli
from plinth.flows import steps
from plinth.functions import geometry as g
from plinth.operators import tiles, views
from plinth.plans import catalogue
from plinth.sources import config, discovery, files, sinks

AREA = [[145.0, 15.0], [145.02, 15.0], [145.02, 15.02], [145.0, 15.02], [145.0, 15.0]]
KINDS = "BUILD_ID string, OCC_CLS string, SQFEET double"


def square(k, side=0.0002):
    x, y = 145.0 + 0.001 * (k % 12) + 0.0003, 15.0 + 0.001 * (k // 12) + 0.0003
    return g.to_wkb(g.box(x, y, x + side, y + side)), x, y


def package(path, layer, columns, rows, geometry="geom", index=True):
    """A GeoPackage with a header before each geometry and, if asked, a spatial index."""
    con = sqlite3.connect(path)
    names = ", ".join(columns)
    con.execute(f"CREATE TABLE {layer} (fid INTEGER PRIMARY KEY, {names}, {geometry} BLOB)")
    header = b"GP\x00\x01" + struct.pack("<i", 4326)
    for k, row in enumerate(rows):
        con.execute(f"INSERT INTO {layer} VALUES ({', '.join('?' * (len(row) + 1))})", (k + 1, *row[:-1], header + row[-1] if row[-1] else None))
    if index:
        con.execute(f"CREATE VIRTUAL TABLE rtree_{layer}_{geometry} USING rtree(id, minx, maxx, miny, maxy)")
        boxes = g.Shapes.from_wkb(pa.array([r[-1] for r in rows], pa.binary())).bounds()
        for k, (x0, y0, x1, y1) in enumerate(boxes.tolist()):
            if not np.isnan(x0):
                con.execute(f"INSERT INTO rtree_{layer}_{geometry} VALUES (?, ?, ?, ?, ?)", (k + 1, x0, x1, y0, y1))
    con.commit()
    con.close()


@pytest.fixture(scope="module")
def place(spark, tmp_path_factory):
    """Sources of one small area: footprints in Parquet, others in a GeoPackage, points in a zipped one; and a configuration."""
    at = tmp_path_factory.mktemp("place")
    rows = [(f"o{k}", bytearray(square(k)[0]), {"xmin": square(k)[1], "ymin": square(k)[2], "xmax": square(k)[1] + 0.0002, "ymax": square(k)[2] + 0.0002}, "house", 3.0, 1, json.dumps({"primary": f"No {k}"}), [("OpenStreetMap" if k % 2 else "other", str(k))]) for k in range(60)]
    rows.append(("far", bytearray(g.to_wkb(g.box(10, 10, 11, 11))), {"xmin": 10.0, "ymin": 10.0, "xmax": 11.0, "ymax": 11.0}, "house", 3.0, 1, None, []))
    spark.createDataFrame(rows, "id string, geometry binary, bbox struct<xmin: double, ymin: double, xmax: double, ymax: double>, class string, height double, num_floors int, names string, sources array<struct<dataset: string, record_id: string>>").write.parquet(str(at / "release" / "2024-06" / "buildings"))
    (at / "listing.xml").write_text("<ListBucketResult><CommonPrefixes><Prefix>release/2024-05/</Prefix></CommonPrefixes><CommonPrefixes><Prefix>release/2024-06/</Prefix></CommonPrefixes></ListBucketResult>")
    second = [(f"f{k}", "Residential" if k % 2 else None, 99.5, square(k + 6)[0]) for k in range(60)] + [("far", "Commercial", "not a number", g.to_wkb(g.box(20, 20, 21, 21))), ("none", None, None, None)]
    package(at / "fema.gpkg", "s", ["BUILD_ID TEXT", "OCC_CLS TEXT", "SQFEET"], second)
    points = [(1000 + k, "RES1", 10.0 * k, None if k % 5 == 0 else 1.0, g.point_wkb(square(k)[1] + 0.0001, square(k)[2] + (0.0001 if k % 2 else 0.00025))) for k in range(80)]
    package(at / "nsi.gpkg", "nsi", ["fd_id INTEGER", "occtype TEXT", "val_struct REAL", "val_cont REAL"], points, index=False)
    with zipfile.ZipFile(at / "nsi.zip", "w") as z:
        z.write(at / "nsi.gpkg", "inner/nsi.gpkg")
        z.writestr("readme.txt", "words")
    (at / "area.geojson").write_text(json.dumps({"type": "Feature", "properties": {"aoi_id": "small", "name": "Small"}, "geometry": {"type": "Polygon", "coordinates": [AREA]}}))
    (at / "config.yaml").write_text(f"""
versions: {{release: null}}
aoi:
  small-place: {{label: Small, bbox: [145.0, 15.0, 145.02, 15.02], geojson: area.geojson}}
  other: {{label: Other, bbox: [0, 0, 1, 1]}}
storage: {{root: "{at}/data"}}
bridges: {{min_iou: 0.10, high_iou: 0.80, buffer_metres: 12, cell: 0.001}}
layout: {{partition_degrees: 0.01, sort_degrees: 0.001}}
run: {{retries: 1, retry_seconds: 0}}
attribution: {{resultant_license: ODbL 1.0}}
sources:
  overture: {{listing: "{at}/listing.xml", path: "{at}/release/{{release}}/buildings"}}
  fema:
    format: geopackage
    layer: s
    schema: "{KINDS}"
    states: {{AA: [144, 14, 146, 16], BB: [0, 0, 1, 1], CC: [140, 10, 150, 20]}}
    paths: {{AA: "{at}/fema.gpkg", BB: "{at}/not wanted.gpkg", CC: "{at}/missing.gpkg"}}
  nsi: {{format: geopackage, layer: nsi, schema: "fd_id long, occtype string, val_struct double, val_cont double", paths: ["{at}/nsi.zip"]}}
""")
    return at


def test_settings(place):
    s = config.load(str(place / "config.yaml"))
    assert s.area("small-place") == s.area("small_place") == s.area() == "small_place" and s.buffer_metres == 12 and s.release is None
    assert s.path("gold", "small-place", "buildings") == f"{place}/data/gold/small_place/buildings" and s.areas["small_place"].geojson == f"{place}/area.geojson"
    with pytest.raises(KeyError):
        s.area("nowhere")


def test_run_by_command_line(spark, place, capsys):
    assert cli.main(["run", "--aoi", "small-place", "--config", str(place / "config.yaml")]) == 0
    said = {k: v for line in capsys.readouterr().out.splitlines() if line.startswith("{") for k, v in json.loads(line).items()}
    assert said["ingest"] == {"overture": 60, "fema": 60, "nsi": 80}
    # k-th second footprint equals the (k + 6)-th first one
    assert said["bridge"]["fema_bridge"] == 54 and said["bridge"]["nsi_bridge"] == 60 and said["bridge"]["nsi_unmatched"] == 20
    assert said["produce"]["buildings"] == 60 + 6
    root = f"{place}/data"
    gold = spark.read.parquet(f"{root}/gold/small_place/buildings")
    assert gold.filter("conflation_confidence = 1.0").count() == 54 and gold.filter("source = 'fema_only'").count() == 6
    assert {r.match_method: r.n for r in spark.read.parquet(f"{root}/silver/small_place/nsi_bridge").groupBy("match_method").agg(F.count("*").alias("n")).collect()} == {"point_in_polygon": 30, "nearest_neighbor": 30}
    foot = sinks.footers(spark, f"{root}/gold/small_place/buildings").collect()
    assert sum(r.rows for r in foot) == 66 and all(json.loads(r.attribution) == {"resultant_license": "ODbL 1.0"} and json.loads(r.geo)["primary_column"] == "geometry" for r in foot)
    cells = spark.read.parquet(f"{root}/gold/small_place/buildings_by_cell")
    assert cells.count() == 66 and set(cells.columns) == {*gold.columns, "cell_partition"}
    assert spark.read.parquet(f"{root}/bronze/small_place/overture_osm").count() == 30
    review = spark.read.parquet(f"{root}/gold/small_place/nsi_review")
    assert said["produce"]["nsi_review"] == review.count() and "nsi_point_wkt" not in review.columns
    archive = (place / "data/tiles/small_place/buildings.pmtiles").read_bytes()
    assert archive[:8] == b"PMTiles\x03" and said["make_tiles"]["gold_buildings"] == struct.unpack_from("<Q", archive, 8 + 64)[0] > 14
    assert cli.main(["report", "--config", str(place / "config.yaml")]) == 0
    told = {k: v for line in capsys.readouterr().out.splitlines() if line.startswith("{") for k, v in json.loads(line).items()}
    assert told["fema"] == {"total": 60, "matched": 54, "overture_matched": 54, "pct": 90.0} and told["nsi"]["pct"] == 75.0 and told["gold"]["total"] == 66
    assert cli.main(["bridge", "--config", str(place / "config.yaml")]) == 0  # overwrites


def test_missing_inputs(spark, place, tmp_path, caplog):
    s = config.load(str(place / "config.yaml"))
    import dataclasses

    s = dataclasses.replace(s, root=str(tmp_path))
    with pytest.raises(FileNotFoundError):
        steps.bridge(spark, s, "small-place")
    steps.ingest_overture(spark, s, "small-place")
    steps.ingest_fema(spark, s, "small-place")
    assert "left out" in caplog.text  # the state whose file is missing
    assert set(steps.bridge(spark, s, "small-place")) == {"fema_bridge"}
    assert steps.produce(spark, s, "small-place") == {"buildings": 66}
    gold = spark.read.parquet(s.path("gold", "small-place", "buildings"))
    assert gold.filter("nsi_point_count = 0 AND NOT has_nsi_match AND nsi_id IS NULL").count() == 66


def test_retries():
    tried = []

    def work():
        tried.append(1)
        if len(tried) < 3:
            raise OSError("again")
        return "made"

    assert steps.with_retries(work, 2, 0) == "made"
    tried.clear()
    with pytest.raises(OSError):
        steps.with_retries(work, 1, 0)


def test_geopackage(spark, place):
    rows = files.geopackage(spark, str(place / "fema.gpkg"), "s", KINDS)
    assert rows.count() == 62 and rows.filter("BUILD_ID = 'far'").first()["SQFEET"] is None and rows.filter("BUILD_ID = 'none'").first()["geometry"] is None
    near = files.geopackage(spark, str(place / "fema.gpkg"), "s", KINDS, bbox=(145.0, 15.0, 145.0029, 15.0009))
    assert sorted(r.BUILD_ID for r in near.collect()) == [] and files.geopackage(spark, str(place / "fema.gpkg"), "s", KINDS, bbox=(145.0, 15.001, 145.0029, 15.0019)).count() == 3
    plain = files.geopackage(spark, str(place / "nsi.zip"), "nsi", "fd_id long", bbox=(145.0, 15.0, 145.0029, 15.0009))
    assert sorted(r.fd_id for r in plain.collect()) == [1000, 1001, 1002]
    assert [(r.name, bytes(r.content)) for r in files.unzipped(spark, str(place / "nsi.zip"), ".txt").collect()] == [("readme.txt", b"words")]


def test_geojson(spark, tmp_path):
    many = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"a": 1}, "geometry": {"type": "MultiPolygon", "coordinates": [[AREA], [[[0, 0], [1, 0], [1, 1], [0, 0]]]]}}, {"type": "Feature", "properties": None, "geometry": {"type": "Point", "coordinates": [1, 2, 3]}}, {"type": "Feature", "properties": {}, "geometry": None}]}
    (tmp_path / "x.geojson").write_text(json.dumps(many))
    made = files.geojson(spark, str(tmp_path / "x.geojson")).collect()
    assert [None if r.geometry is None else g.to_wkt(g.Shapes.from_wkb(pa.array([bytes(r.geometry)])), 0)[:12] for r in made] == ["MULTIPOLYGON", "POINT (1 2)", None]
    assert json.loads(made[0].properties) == {"a": 1}


def test_download(spark, tmp_path):
    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            if self.path == "/here.zip":
                self.send_response(200)
                self.end_headers()
                self.wfile.write(b"z" * 3_000_000)
            else:
                self.send_error(404 if self.path == "/gone.zip" else 500)

        def log_message(self, *_):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    made = {r.url.rpartition("/")[2]: r for r in files.download(spark, [f"{base}/here.zip", f"{base}/gone.zip", f"{base}/broken.zip"], str(tmp_path / "d"), 1, 0).collect()}
    server.shutdown()
    assert (made["here.zip"].status, made["here.zip"].bytes) == ("ok", 3_000_000) and (tmp_path / "d/here.zip").stat().st_size == 3_000_000
    assert made["gone.zip"].status == "missing" and made["broken.zip"].status.startswith("failed")


def test_sinks(spark, tmp_path):
    import pyarrow.parquet as pq

    df = spark.range(250_000).selectExpr("id", "id % 7 AS k").repartition(1)
    sinks.write_parquet(df, str(tmp_path / "p"))
    one = next((tmp_path / "p").glob("part-*.parquet"))
    meta = pq.read_metadata(one)
    assert [meta.row_group(k).num_rows for k in range(meta.num_row_groups)] == [100_000, 100_000, 50_000] and meta.row_group(0).column(0).compression == "ZSTD"
    shaped = df.withColumn("geometry", F.lit(g.point_wkb(1, 2)))
    assert sinks.write_geoparquet(shaped, str(tmp_path / "g"), {"a": "b"}) == 250_000 == sinks.row_count(spark, str(tmp_path / "g"))
    meta = pq.read_metadata(next((tmp_path / "g").glob("part-*.parquet")))
    assert [meta.row_group(k).num_rows for k in range(meta.num_row_groups)] == [100_000, 100_000, 50_000]
    with pytest.raises(FileExistsError):
        sinks.write_geoparquet(shaped, str(tmp_path / "g"))
    assert sinks.write_geoparquet(shaped.limit(5), str(tmp_path / "g"), mode="overwrite") == 5 and sinks.footers(spark, str(tmp_path / "g")).agg(F.sum("rows")).first()[0] == 5
    cells = spark.range(1000).selectExpr("id", "id % 10 AS fine")
    sinks.write_cells(cells, str(tmp_path / "c"), (F.col("id") % 3).cast("string"), F.col("fine"))
    with pytest.raises(Exception, match="exist"):
        sinks.write_cells(cells, str(tmp_path / "c"), (F.col("id") % 3).cast("string"), F.col("fine"))
    back = spark.read.parquet(str(tmp_path / "c"))
    assert back.filter("id % 3 != cell_partition").count() == 0 and back.count() == 1000
    for part in (tmp_path / "c").glob("cell_partition=*/*.parquet"):
        fine = pq.read_table(part, partitioning=None).column("fine").to_pylist()
        assert fine == sorted(fine)
    named = sinks.with_attribution(cells, "id", {"a": 1})
    sinks.write_parquet(named, str(tmp_path / "n"))
    assert json.loads(spark.read.parquet(str(tmp_path / "n")).schema["id"].metadata["attribution"]) == {"a": 1}


def test_tile_bytes():
    ring = np.array([[0.0, 0.0], [10.0, 0.0], [10.0, 10.0], [0.0, 10.0], [0.0, 0.0]])
    rows = pa.table({"id": pa.array([7, 8, 9]), "kind": pa.array(["a", None, "a"]), "n": pa.array([1.5, 2.5, None]), "geometry": pa.array([g.to_wkb([[ring]]), g.point_wkb(-90, 45), None], pa.binary())})
    layer = dict(tiles.fields(tiles.tile_bytes(rows, "buildings", 0, 0, 0)))[3]
    made = [dict(tiles.fields(v)) for k, v in tiles.fields(layer) if k == 2]
    assert dict(tiles.fields(layer))[1] == b"buildings" and dict(tiles.fields(layer))[15] == 2 and [v for k, v in tiles.fields(layer) if k == 3] == [b"kind", b"n"]
    assert [(f[1], f[3]) for f in made] == [(7, 3), (8, 1)] and len(made) == 2

    def integers(data):
        out, n, shift = [], 0, 0
        for b in data:
            n |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                out.append(n)
                n = shift = 0
        return out

    point = integers(made[1][4])
    assert point[0] == 9 and (point[1] >> 1, point[2] >> 1) == (1024, 1473)  # a quarter from the left edge
    commands = integers(made[0][4])
    assert commands[0] == 9 and commands[3] == 2 | 3 << 3 and commands[-1] == 15


def test_tile_ids_and_thinning(spark):
    z, x, y = (np.array(v) for v in zip(*[(k, i, j) for k in range(4) for i in range(1 << k) for j in range(1 << k)], strict=True))
    assert sorted(tiles.tile_id(z, x, y).tolist()) == list(range(85)) and tiles.tile_id(np.array([1, 1]), np.array([0, 1]), np.array([1, 0])).tolist() == [2, 4]
    df = spark.range(500).select("id", F.lit(g.point_wkb(10.0, 20.0)).alias("geometry"))
    kept = tiles.features(df, 0, 3).collect()
    assert sorted((r.z, r.id) for r in kept) == [(0, 0), (1, 0), (2, 0), (3, 0)]
    wide = spark.createDataFrame([(1, bytearray(g.to_wkb(g.box(-170, -80, 170, 80))))], "id long, geometry binary")
    assert tiles.features(wide, 0, 2).count() == 1 + 4 + 16


def test_discovery(spark):
    pages = spark.createDataFrame([(1, '<a href="/x/Deliverable2023AA.zip">'), (2, '<a href="/x/Deliverable2024AA.zip"><a href="/y/DeliverableBB.zip"><a href="/z.txt">')], "n int, html string")
    assert {r.key: r.url for r in discovery.index_links(pages, "html", r"Deliverable\\d*([A-Z]{2})\\.zip$".replace("\\\\", "\\"), "n").collect()} == {"AA": "/x/Deliverable2024AA.zip", "BB": "/y/DeliverableBB.zip"}


def test_views(spark):
    c = spark.createDataFrame([(None,), (float("nan"),), (-1.0,), (0.0,), (0.25,), (1.0,), (7.0,)], "v double")
    made = [tuple(r) for r in c.select(views.confidence_step(F.col("v")), views.confidence_colour(F.col("v"))).collect()]
    assert made == [(None, "#999999"), (None, "#999999"), (0, "rgb(215,48,39)"), (0, "rgb(215,48,39)"), (5, "rgb(235,136,89)"), (20, "rgb(26,152,80)"), (20, "rgb(26,152,80)")]
    b = spark.createDataFrame([("a", "Residential"), ("b", None), ("c", "Strange")], "id string, general_occupancy string")
    from plinth.functions.scoring import CLASSES

    assert views.occupancy_filter(b, CLASSES).count() == 3 and views.occupancy_filter(b, []).count() == 0 and [r.id for r in views.occupancy_filter(b, ["Residential"]).collect()] == ["a"]


def test_stream_is_bridged_as_a_batch(spark, tmp_path):
    from plinth.operators.bridges import nsi_bridge
    from plinth.plans import fixture as fx
    from plinth.streaming.points import bridge_stream

    d = "/root/testdata/sf0.001"
    points, o = fx.points(spark, d).limit(200).persist(), fx.overture(spark, d).persist()
    points.repartition(2).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(points.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    query = bridge_stream(stream.selectExpr(*points.columns), o, str(tmp_path / "out"), str(tmp_path / "check"), fx.REACH, fx.CELL)
    query.awaitTermination(300)
    made, want = spark.read.parquet(str(tmp_path / "out")).drop("batch"), nsi_bridge(points, o, fx.REACH, fx.CELL)
    assert made.exceptAll(want).count() == 0 and want.exceptAll(made).count() == 0 and want.count() > 50


@pytest.mark.parametrize("name", ["reprojection", "tile_counts", "vector_tiles"])
def test_beyond_the_poles(spark, tmp_path, name):
    """Customers so many that the fixture's latitudes go round, in the SQL's terms."""
    import duckdb

    spark.range(4000).selectExpr("id AS o_orderkey", "id * 337 AS o_custkey", "id / 8 AS o_totalprice").write.parquet(str(tmp_path / "orders.parquet"))
    spark.range(3).selectExpr("id AS p_partkey", "CAST(id AS INT) AS p_size").write.parquet(str(tmp_path / "part.parquet"))
    con = duckdb.connect()
    for t in ("orders", "part"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    found = catalogue.QUERIES[name](spark, str(tmp_path))
    key = lambda rows: sorted((tuple(map(str, r)) for r in rows))
    expected = con.execute(f"SELECT {', '.join(found.columns)} FROM ({catalogue.SQL[name]})").fetchall()
    assert key(map(tuple, found.collect())) == key(expected) and len(expected) > 1000


def test_tiles_across_batches(spark):
    p = spark.range(3000).selectExpr("id", "12 AS z", "CAST(id % 7 * (id % 2) AS INT) AS x", "0 AS y", "id % 5 AS n").withColumn("geometry", F.lit(g.point_wkb(-170, 85)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    made = tiles.encode(p, "points").collect()
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(made) == 7
    for r in made:
        rows = p.filter(F.col("x") == r.x).orderBy("id").toArrow()
        assert bytes(r.tile) == tiles.tile_bytes(rows, "points", r.z, r.x, r.y)


def test_cells_are_whole_files(spark, tmp_path):
    """A small cell is one file, a dense one as many as it fills; names that folders cannot have, nulls and column metadata come back."""
    rows = spark.range(4000).selectExpr("id", "id % 100 AS fine", "CASE WHEN id < 2000 THEN 'a/b' WHEN id < 2300 THEN NULL ELSE concat('3_-', id % 50) END AS name")
    sinks.write_cells(sinks.with_attribution(rows, "id", {"a": 1}), str(tmp_path / "c"), F.col("name"), F.col("fine"), together=1000)
    files = [len(list(f.glob("*.parquet"))) for f in (tmp_path / "c").glob("cell_partition=*")]
    assert len(files) == 52 and sum(n == 1 for n in files) == 51 and max(files) == 2
    back = spark.read.parquet(str(tmp_path / "c"))
    assert json.loads(back.schema["id"].metadata["attribution"]) == {"a": 1} and not [p for p in (tmp_path / "c").rglob("_*")]
    assert back.filter("NOT name <=> cell_partition").count() == 0 and sorted(r.id for r in back.collect()) == list(range(4000))
    sinks.write_cells(rows.limit(7), str(tmp_path / "c"), F.col("name"), F.col("fine"), mode="overwrite")
    assert spark.read.parquet(str(tmp_path / "c")).count() == 7
