"""Sources: Parquet, GeoJSON, GeoPackage and ZIP files on any file system that Spark reads; downloads."""

from __future__ import annotations

import io
import json
import sqlite3
import time
import urllib.error
import urllib.request
import zipfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plinth.functions import geometry as g
from plinth.functions import spatial

BBox = tuple[float, float, float, float]
CHUNK = 1 << 20


def parquet(spark: SparkSession, path: str, columns: list[str] | None = None, bbox: BBox | None = None) -> DataFrame:
    """Files by path or glob; a bounding box becomes filters on the ``bbox`` struct that reach the Parquet reader."""
    df = spark.read.option("recursiveFileLookup", "true").parquet(path)
    if bbox:
        df = df.filter(spatial_overlap(bbox))
    return df.select(*columns) if columns else df


def bare(spark: SparkSession, path: str) -> DataFrame:
    """``FROM 'path'``."""
    return spark.sql(f"SELECT * FROM parquet.`{path}`")


def spatial_overlap(bbox: BBox):
    """The struct ``bbox`` meets a box."""
    x0, y0, x1, y1 = bbox
    return (F.col("bbox.xmin") <= x1) & (F.col("bbox.xmax") >= x0) & (F.col("bbox.ymin") <= y1) & (F.col("bbox.ymax") >= y0)


def geojson(spark: SparkSession, path: str) -> DataFrame:
    """(properties as JSON, geometry as WKB) of the features of GeoJSON files, one task for each file; other geometries than points and polygons are null."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0).to_pylist():
                top = json.loads(text)
                features = top["features"] if top.get("type") == "FeatureCollection" else [top]
                shapes = [f.get("geometry") or {} for f in features]
                yield pa.RecordBatch.from_arrays([pa.array([json.dumps(f.get("properties") or {}) for f in features]), pa.array([g.from_coordinates(s["type"], s["coordinates"]) if "coordinates" in s else None for s in shapes], pa.binary())], names=["properties", "geometry"])

    return spark.read.text(path, wholetext=True).mapInArrow(read, "properties string, geometry binary")


def area_of_interest(spark: SparkSession, path: str) -> tuple[str, bytes, BBox]:
    """(id, WKB, bounding box) of the one polygon in a GeoJSON file."""
    row = geojson(spark, path).first()
    shapes = g.Shapes.from_wkb(pa.array([bytes(row.geometry)]))
    return json.loads(row.properties).get("aoi_id", ""), bytes(row.geometry), tuple(shapes.bounds()[0].tolist())


def in_area(df: DataFrame, area: bytes, geometry: str = "geometry") -> DataFrame:
    """Rows whose polygon meets the area, touching included, kept whole."""
    x0, y0, x1, y1 = g.Shapes.from_wkb(pa.array([area])).bounds()[0].tolist()
    if {"x0", "y0", "x1", "y1"} <= set(df.columns):
        df = df.filter((F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0))
    elif "bbox" in df.columns:
        df = df.filter(spatial_overlap((x0, y0, x1, y1)))
    return df.filter(spatial.st_intersects(F.col(geometry), F.lit(area)))


def points_in_area(df: DataFrame, area: bytes, x: str = "px", y: str = "py") -> DataFrame:
    """Rows whose point lies in the area or on its edge."""
    x0, y0, x1, y1 = g.Shapes.from_wkb(pa.array([area])).bounds()[0].tolist()
    near = df.filter(F.col(x).between(x0, x1) & F.col(y).between(y0, y1))
    return near.filter(spatial.st_distance(F.col(x).cast("double"), F.col(y).cast("double"), F.lit(area)) == 0)


def unzipped(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(archive, name, content) of the entries of ZIP files, one task for each archive."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    for entry in z.namelist():
                        if entry.endswith(suffix) and not entry.endswith("/"):
                            yield pa.RecordBatch.from_pylist([{"archive": name, "name": entry, "content": z.read(entry)}])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(read, "archive string, name string, content binary")


def _plain_wkb(blob: bytes | None) -> bytes | None:
    """A GeoPackage geometry without its header."""
    if blob is None:
        return None
    return bytes(blob[8 + {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[(blob[3] >> 1) & 7] :])


def geopackage(spark: SparkSession, path: str, layer: str, schema: str, geometry: str = "geom", bbox: BBox | None = None) -> DataFrame:
    """A layer of GeoPackage files, or of the first one in ZIP files: columns by ``schema`` and geometry as WKB, one task for each file.

    With a bounding box the layer's spatial index, if it has one, chooses the rows; boxes of geometries then decide. Files are read through Spark,
    so each must fit into memory. Values that don't fit a column's type are null."""
    kinds = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(kinds)

    def database(content: bytes) -> sqlite3.Connection:
        if content[:2] == b"PK":
            with zipfile.ZipFile(io.BytesIO(content)) as z:
                content = z.read(next(n for n in z.namelist() if n.endswith(".gpkg")))
        con = sqlite3.connect(":memory:")
        con.deserialize(content)
        return con

    def value(v, kind: pa.DataType):
        try:
            return None if v is None else pa.scalar(v if not pa.types.is_string(kind) else str(v)).cast(kind).as_py()
        except (pa.ArrowInvalid, pa.ArrowNotImplementedError):
            return None

    def quoted(name: str) -> str:
        return '"' + name.replace('"', '""') + '"'

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = ", ".join(map(quoted, [*arrow.names, geometry]))
        for batch in batches:
            for content in batch.column(0).to_pylist():
                con = database(content)
                index = f"rtree_{layer}_{geometry}"
                query, values = f"SELECT {wanted} FROM {quoted(layer)}", ()
                if bbox and con.execute("SELECT count(*) FROM sqlite_master WHERE name = ?", (index,)).fetchone()[0]:
                    query += f" WHERE rowid IN (SELECT id FROM {quoted(index)} WHERE minx <= ? AND maxx >= ? AND miny <= ? AND maxy >= ?)"
                    values = (bbox[2], bbox[0], bbox[3], bbox[1])
                rows = con.execute(query, values)
                while some := rows.fetchmany(10_000):
                    shapes = pa.array([_plain_wkb(r[-1]) for r in some], pa.binary())
                    columns = [pa.array([value(r[k], f.type) for r in some], f.type) for k, f in enumerate(arrow)]
                    made = pa.RecordBatch.from_arrays([*columns, shapes], names=[*arrow.names, "geometry"])
                    if bbox:
                        b = g.Shapes.from_wkb(shapes).bounds()
                        with np.errstate(invalid="ignore"):
                            made = made.filter(pa.array((b[:, 0] <= bbox[2]) & (b[:, 2] >= bbox[0]) & (b[:, 1] <= bbox[3]) & (b[:, 3] >= bbox[1])))
                    yield made
                con.close()

    out = T.StructType([*kinds.fields, T.StructField("geometry", T.BinaryType())])
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(read, out)


def download(spark: SparkSession, urls: list[str], directory: str, retries: int = 1, wait: float = 1.0) -> DataFrame:
    """Fetch URLs into a shared folder, one task for each: (url, path, status, bytes). status is 'ok', 'missing' (404) or 'failed: why'; neither
    of the latter stops the others."""

    def fetch(url: str) -> dict:
        files, folder = arrow_fs.FileSystem.from_uri(directory) if "://" in directory else (arrow_fs.LocalFileSystem(), directory)
        files.create_dir(folder, recursive=True)
        target, why = f"{folder}/{url.rstrip('/').rpartition('/')[2]}", ""
        for attempt in range(retries + 1):
            try:
                size = 0
                with urllib.request.urlopen(url, timeout=600) as got, files.open_output_stream(f"{target}.part") as out:
                    while chunk := got.read(CHUNK):
                        out.write(chunk)
                        size += len(chunk)
                files.move(f"{target}.part", target)
                return {"url": url, "path": target, "status": "ok", "bytes": size}
            except urllib.error.HTTPError as e:
                if e.code == 404:
                    return {"url": url, "path": None, "status": "missing", "bytes": 0}
                why = str(e)
            except OSError as e:
                why = str(e)
            if attempt < retries:
                time.sleep(wait)
        return {"url": url, "path": None, "status": f"failed: {why}", "bytes": 0}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = pa.schema([("url", pa.string()), ("path", pa.string()), ("status", pa.string()), ("bytes", pa.int64())])
        for batch in batches:
            for url in batch.column(0).to_pylist():
                yield pa.RecordBatch.from_pylist([fetch(url)], schema=made)

    wanted = spark.createDataFrame([(u,) for u in urls], "url string").repartition(max(1, len(urls)))
    return wanted.mapInArrow(work, "url string, path string, status string, bytes long")


def states_overlapping(states: DataFrame, bbox: BBox) -> DataFrame:
    x0, y0, x1, y1 = bbox
    return states.filter((F.col("x0") <= x1) & (F.col("x1") >= x0) & (F.col("y0") <= y1) & (F.col("y1") >= y0))


def identified(df: DataFrame, source: str, name: str, order: list[str]) -> DataFrame:
    """df with the id ``name``: the column ``source`` renamed (in any case), else numbers from 0 in the given order."""
    from plinth.operators.ranking import surrogate_id

    have = {c.lower(): c for c in df.columns}
    return df.withColumnRenamed(have[source.lower()], name) if source.lower() in have else surrogate_id(df, name, order)


def concat(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
