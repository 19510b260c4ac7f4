"""Each flow reads what the one before wrote: bronze sources, silver crosswalks, the gold table, map tiles.

Missing inputs: without footprints of either source a flow raises; without points it says so and goes on. One state's failure stops no other.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions import spatial
from plinth.operators import bridges, diagnostics, gold, tiles
from plinth.sources import discovery, files, sinks, storage
from plinth.sources.config import Settings

log = logging.getLogger("plinth")
Made = TypeVar("Made")


def with_retries(work: Callable[[], Made], retries: int, seconds: float) -> Made:
    for attempt in range(retries + 1):
        try:
            return work()
        except FileNotFoundError:
            raise  # it won't come by waiting
        except Exception as e:
            if attempt == retries:
                raise
            log.warning("attempt %d failed, again in %s s: %s", attempt + 1, seconds, e)
            time.sleep(seconds)
    raise AssertionError


def _read(spark: SparkSession, path: str, what: str) -> DataFrame:
    if not storage.exists(spark, path):
        raise FileNotFoundError(f"{what} not found: {path}")
    return spark.read.parquet(path)


def _maybe(spark: SparkSession, path: str, what: str) -> DataFrame | None:
    if storage.exists(spark, path):
        return spark.read.parquet(path)
    log.warning("%s not found: %s", what, path)
    return None


def _place(spark: SparkSession, s: Settings, area: str):
    """(the area's polygon or None, its box)"""
    known = s.areas[s.area(area)]
    if known.geojson:
        _, shape, _ = files.area_of_interest(spark, known.geojson)
        return shape, known.bbox
    return None, known.bbox


def _source(spark: SparkSession, spec: dict, path: str, bbox) -> DataFrame:
    """A source's files by their kind: geopackage (also zipped), geojson, else Parquet with WKB."""
    kind = spec.get("format", "parquet")
    if kind == "geopackage":
        return files.geopackage(spark, path, spec["layer"], spec["schema"], spec.get("geometry", "geom"), bbox)
    if kind == "geojson":
        read = files.geojson(spark, path)
        return read.select(F.from_json("properties", spec["schema"]).alias("p"), "geometry").select("p.*", "geometry")
    return files.parquet(spark, path)


def _states(spark: SparkSession, spec: dict, bbox, read: Callable[[str], DataFrame]) -> list[DataFrame]:
    """One frame for each file of a source; one that can't be read is left out."""
    paths = spec["paths"]
    if isinstance(paths, dict):
        states = spark.createDataFrame([(c, *map(float, b)) for c, b in spec.get("states", {}).items()], "state string, x0 double, y0 double, x1 double, y1 double")
        wanted = {r.state for r in files.states_overlapping(states, bbox).collect()} if spec.get("states") else set(paths)
        paths = [p for c, p in paths.items() if c in wanted]
    out = []
    for path in paths:
        try:
            df = read(path)
            df.limit(1).count()  # a file that can't be read fails here
            out.append(df)
        except Exception as e:
            log.warning("failed to read %s, left out: %s", path, e)
    return out


def _write(df: DataFrame, path: str, s: Settings) -> int:
    sinks.write_parquet(df, path, mode="overwrite")
    n = sinks.row_count(df.sparkSession, path)
    log.info("%d rows to %s", n, path)
    return n


def ingest_overture(spark: SparkSession, s: Settings, area: str) -> int:
    spec, (shape, bbox) = s.sources["overture"], _place(spark, s, area)
    release = s.release
    if release is None and "listing" in spec:
        release = discovery.latest_release(spark.read.text(spec["listing"], wholetext=True), "value").first()["release"]
    df = files.parquet(spark, spec["path"].replace("{release}", release or ""), bbox=bbox if spec.get("bbox", True) else None)
    named = df.withColumnsRenamed({"id": "overture_id", "class": "overture_class"})
    kept = files.in_area(named, shape) if shape else named
    valid = sinks.nonempty(kept.withColumn("geometry", spatial.st_makevalid("geometry")))
    out = s.path("bronze", area, "overture")
    n = _write(sinks.in_curve_order(bridges.boxed(valid)), out, s)
    osm = F.filter("sources", lambda x: x["dataset"] == "OpenStreetMap")
    if "sources" in df.columns:
        made = spark.read.parquet(out).select("overture_id", osm.alias("osm_sources")).filter(F.size("osm_sources") > 0)
        _write(made, s.path("bronze", area, "overture_osm"), s)
    return n


def ingest_fema(spark: SparkSession, s: Settings, area: str) -> int:
    spec, (shape, bbox) = s.sources["fema"], _place(spark, s, area)
    frames = _states(spark, spec, bbox, lambda path: _source(spark, spec, path, bbox))
    if not frames:
        log.warning("no second-source files for %s", area)
        return 0
    df = files.concat(frames)
    if spec.get("crs", 4326) != 4326:
        df = df.withColumn("geometry", spatial.st_transform(F.col("geometry"), spec["crs"], 4326))
    kept = files.in_area(bridges.boxed(df), shape) if shape else bridges.boxed(df)
    valid = sinks.nonempty(kept.withColumn("geometry", spatial.st_makevalid("geometry")))
    known = {c.lower(): c for c in valid.columns}
    named = valid.withColumnsRenamed({known[k]: v for k, v in {"build_id": "fema_id", "occ_cls": "occ_cls"}.items() if k in known})
    if "fema_id" not in named.columns:
        named = files.identified(named, "objectid", "fema_id", [*bridges.SIDES])
    return _write(sinks.in_curve_order(named), s.path("bronze", area, "fema"), s)


def ingest_nsi(spark: SparkSession, s: Settings, area: str) -> int:
    spec, (shape, bbox) = s.sources["nsi"], _place(spark, s, area)
    frames = _states(spark, spec, bbox, lambda path: _source(spark, spec, path, bbox))
    if not frames:
        log.warning("no point files for %s", area)
        return 0
    df = files.concat(frames)
    if spec.get("crs", 4326) != 4326:
        df = df.withColumn("geometry", spatial.st_transform(F.col("geometry"), spec["crs"], 4326))
    at = sinks.nonempty(df).withColumn("_at", spatial.st_centroid("geometry"))
    placed = at.withColumns({"px": F.col("_at.x"), "py": F.col("_at.y")}).drop("_at")
    kept = files.points_in_area(placed, shape) if shape else placed
    known = files.identified(kept, "fd_id", "nsi_id", ["px", "py"])
    return _write(sinks.in_curve_order(known), s.path("bronze", area, "nsi"), s)


def ingest(spark: SparkSession, s: Settings, area: str) -> dict[str, int]:
    made = {"overture": ingest_overture, "fema": ingest_fema, "nsi": ingest_nsi}
    return {k: with_retries(lambda f=f: f(spark, s, area), s.retries, s.retry_seconds) for k, f in made.items() if k in s.sources}


def bridge(spark: SparkSession, s: Settings, area: str) -> dict[str, int]:
    def work() -> dict[str, int]:
        o = _read(spark, s.path("bronze", area, "overture"), "first-source footprints")
        f = _read(spark, s.path("bronze", area, "fema"), "second-source footprints")
        n = _maybe(spark, s.path("bronze", area, "nsi"), "points")
        made = {"fema_bridge": _write(bridges.fema_bridge(o, f, s.min_iou, s.cell), s.path("silver", area, "fema_bridge"), s)}
        if n is not None:
            made["nsi_bridge"] = _write(bridges.nsi_bridge(n, o, spatial.buffer_degrees(s.buffer_metres), s.cell), s.path("silver", area, "nsi_bridge"), s)
            matched = spark.read.parquet(s.path("silver", area, "nsi_bridge"))
            made["nsi_unmatched"] = _write(bridges.nsi_unmatched(n, matched), s.path("silver", area, "nsi_unmatched"), s)
            made["nsi_fema_bridge"] = _write(bridges.nsi_fema_bridge(n, f, s.cell), s.path("silver", area, "nsi_fema_bridge"), s)
        return made

    return with_retries(work, s.retries, s.retry_seconds)


def produce(spark: SparkSession, s: Settings, area: str) -> dict[str, int]:
    """The gold table as one set of GeoParquet files and once more by cells; the points that no footprint holds for review."""

    def work() -> dict[str, int]:
        o = _read(spark, s.path("bronze", area, "overture"), "first-source footprints")
        f = _read(spark, s.path("bronze", area, "fema"), "second-source footprints")
        b = _read(spark, s.path("silver", area, "fema_bridge"), "crosswalk of footprints")
        n, nf = _maybe(spark, s.path("silver", area, "nsi_bridge"), "crosswalk of points"), _maybe(spark, s.path("silver", area, "nsi_fema_bridge"), "second crosswalk of points")
        table = gold.produce(_with_details(o), _with_class(f), b, n, nf if n is not None else None, s.high_iou)
        made = {"buildings": sinks.write_geoparquet(table, s.path("gold", area, "buildings"), s.attribution, mode="overwrite")}
        back = spark.read.parquet(s.path("gold", area, "buildings"))
        sinks.write_cells_of(back, s.path("gold", area, "buildings_by_cell"), s.partition_degrees, s.sort_degrees, mode="overwrite")
        left = _maybe(spark, s.path("silver", area, "nsi_unmatched"), "unmatched points")
        if left is not None and nf is not None:
            made["nsi_review"] = sinks.write_geoparquet(gold.review(left, nf), s.path("gold", area, "nsi_review"), s.attribution, mode="overwrite")
        return made

    return with_retries(work, s.retries, s.retry_seconds)


def _with_details(o: DataFrame) -> DataFrame:
    kinds = {"height": "double", "num_floors": "int", "overture_class": "string", "names": "string"}
    return o.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in o.columns})


def _with_class(f: DataFrame) -> DataFrame:
    return f if "occ_cls" in f.columns else f.withColumn("occ_cls", F.lit(None).cast("string"))


def make_tiles(spark: SparkSession, s: Settings, area: str, max_zoom: int = 14, point_zoom: int = 16) -> dict[str, int]:
    def work() -> dict[str, int]:
        g = _read(spark, s.path("gold", area, "buildings"), "gold table").withColumnRenamed("building_id", "id").withColumn("names", F.col("names").cast("string"))
        f = _read(spark, s.path("bronze", area, "fema"), "second-source footprints").select(F.col("fema_id").cast("string").alias("id"), "occ_cls", "geometry")
        made = {"gold_buildings": tiles.write_archive(tiles.encode(tiles.features(g, 0, max_zoom), "buildings"), s.path("tiles", area, "buildings.pmtiles"), "buildings"), "fema_buildings": tiles.write_archive(tiles.encode(tiles.features(f, 0, max_zoom), "fema"), s.path("tiles", area, "fema.pmtiles"), "fema")}
        n = _maybe(spark, s.path("gold", area, "nsi_review"), "points for review")
        if n is not None:
            points = n.withColumnRenamed("nsi_id", "id")
            made["nsi_unmatched"] = tiles.write_archive(tiles.encode(tiles.features(points, 0, point_zoom), "nsi_unmatched"), s.path("tiles", area, "nsi_unmatched.pmtiles"), "nsi_unmatched")
        return made

    return with_retries(work, s.retries, s.retry_seconds)


def report(spark: SparkSession, s: Settings, area: str) -> dict[str, DataFrame]:
    """Rates and counts of the layers that are there."""
    read = lambda layer, name: _maybe(spark, s.path(layer, area, name), name)
    f, n, g = read("bronze", "fema"), read("bronze", "nsi"), read("gold", "buildings")
    fb, nb = read("silver", "fema_bridge"), read("silver", "nsi_bridge")
    made = {}
    if f is not None and fb is not None:
        made |= {"fema": diagnostics.fema_rates(fb, f), "fema without id": diagnostics.lost_rows(f)}
    if n is not None and nb is not None:
        made["nsi"] = diagnostics.nsi_rates(nb, n)
    if g is not None:
        made["gold"] = diagnostics.gold_counts(g)
    return made


RECIPES = {"ingest": [ingest], "bridge": [bridge], "gold": [produce], "tiles": [make_tiles], "process": [bridge, produce, make_tiles], "run": [ingest, bridge, produce, make_tiles]}
