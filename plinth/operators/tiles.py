"""Vector tiles: which features each map tile shows, their encoding as MVT, and an archive of the tiles.

A feature goes to every tile that its box meets. At zooms where a feature is smaller than a cell of a grid over the tile, one feature of each
cell stays (the one with the least id), so that a tile of a whole country holds no more than its picture can show. Tiles are encoded by task, those
of a batch together. Polygons aren't clipped: coordinates outside of a tile's extent are allowed.
"""

from __future__ import annotations

import gzip
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions import geometry as g
from plinth.functions import spatial
from plinth.operators.views import tile_of

EXTENT = 4096
GRID = 256


def features(df: DataFrame, min_zoom: int, max_zoom: int, grid: int | None = GRID) -> DataFrame:
    """df (id, geometry in degrees as WKB, and properties) with z, x, y for each tile that shows the row."""
    boxed = df.withColumn("_b", spatial.st_extent("geometry")).filter("_b.xmin IS NOT NULL AND _b.ymin IS NOT NULL")
    ranges = []
    for z in range(min_zoom, max_zoom + 1):
        x0, y1 = tile_of(F.col("_b.xmin"), F.col("_b.ymin"), z)
        x1, y0 = tile_of(F.col("_b.xmax"), F.col("_b.ymax"), z)
        wide = F.greatest(F.col("_b.xmax") - F.col("_b.xmin"), F.col("_b.ymax") - F.col("_b.ymin")) * float(1 << z) / 360.0
        cx, cy = tile_of((F.col("_b.xmin") + F.col("_b.xmax")) / 2, (F.col("_b.ymin") + F.col("_b.ymax")) / 2, z + (grid or 1).bit_length() - 1)
        ranges.append(F.struct(F.lit(z).alias("z"), x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"), (wide < 1.0 / (grid or 1)).alias("small"), cx.alias("cx"), cy.alias("cy")))
    at = boxed.withColumn("_t", F.explode(F.array(*ranges)))
    laid = at.withColumn("x", F.explode(F.sequence("_t.x0", "_t.x1"))).withColumn("y", F.explode(F.sequence("_t.y0", "_t.y1")))
    out = laid.select(F.col("_t.z").alias("z"), "x", "y", *df.columns, F.col("_t.small").alias("_small"), F.col("_t.cx").alias("_cx"), F.col("_t.cy").alias("_cy"))
    names = ["z", "x", "y", *df.columns]
    if grid is None:
        return out.select(*names)
    rest = F.struct(*(F.col(c) for c in df.columns))
    one = out.filter("_small").groupBy("z", "x", "y", "_cx", "_cy").agg(F.min_by(rest, "id").alias("r")).select("z", "x", "y", *(F.col(f"r.`{c}`").alias(c) for c in df.columns))
    return out.filter("NOT _small").select(*names).unionAll(one)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 0x7F:
        out.append(n & 0x7F | 0x80)
        n >>= 7
    out.append(n)
    return bytes(out)


def _field(number: int, data: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _zigzag(n: int) -> int:
    return n << 1 if n >= 0 else (-n << 1) - 1


def _value(v) -> bytes:
    if isinstance(v, bool):
        return _varint(7 << 3) + _varint(int(v))
    if isinstance(v, int):
        return _varint(6 << 3) + _varint(_zigzag(v))
    if isinstance(v, float):
        return _varint(3 << 3 | 1) + struct.pack("<d", v)
    return _field(1, str(v).encode())


def _commands(shapes: g.Shapes, row: int, x: np.ndarray, y: np.ndarray) -> tuple[int, list[int]]:
    """(type, geometry) of a row whose vertices have the tile coordinates x, y."""
    rings = range(shapes.first[row], shapes.first[row + 1])
    px = py = 0
    out: list[int] = []
    if shapes.kind[row] == g.POINT:
        at = shapes.ring[rings[0]]
        return 1, [1 | 1 << 3, _zigzag(int(x[at])), _zigzag(int(y[at]))]
    for k in rings:
        xs, ys = x[shapes.ring[k] : shapes.ring[k + 1] - 1], y[shapes.ring[k] : shapes.ring[k + 1] - 1]
        if len(xs) < 3:
            continue
        turn = int((xs * np.roll(ys, -1) - np.roll(xs, -1) * ys).sum())
        if (turn < 0) == bool(shapes.shell[k]):  # shells turn clockwise on the screen, whose y goes down, holes the other way
            xs, ys = xs[::-1], ys[::-1]
        for n, (a, b) in enumerate(zip(xs.tolist(), ys.tolist(), strict=True)):
            if n < 2:
                out.append((1 if n == 0 else 2) | (1 if n == 0 else len(xs) - 1) << 3)
            out += [_zigzag(a - px), _zigzag(b - py)]
            px, py = a, b
        out.append(7 | 1 << 3)
    return 3, out


def tile_bytes(rows: pa.Table, layer: str, z: int, x: int, y: int, extent: int = EXTENT) -> bytes:
    """The MVT of a tile; numeric ids become feature ids, all other columns are properties."""
    n = rows.num_rows
    return tiles_bytes(rows, layer, *(np.full(n, v, np.int64) for v in (z, x, y)), np.array([0, n]), extent)[0]


def tiles_bytes(rows: pa.Table, layer: str, z: np.ndarray, x: np.ndarray, y: np.ndarray, first: np.ndarray, extent: int = EXTENT) -> list[bytes]:
    """``tile_bytes`` of several tiles: z, x, y of each row; a tile's rows begin at its place of ``first``, which has one more entry at the end."""
    shapes = g.Shapes.from_wkb(rows.column("geometry"))
    at = shapes.vertices()
    n = (1 << z)[at]
    with np.errstate(divide="ignore", invalid="ignore"):
        mx = (shapes.x + 180.0) / 360.0 * n
        lat = np.radians(shapes.y)
        up = np.tan(lat) + 1.0 / np.cos(lat)
        my = np.clip(np.where(up > 0, (1.0 - np.log(up) / np.pi) / 2.0 * n, n), 0, n)  # as views.tile_of
    px, py = np.floor((mx - x[at]) * extent).astype(np.int64), np.floor((my - y[at]) * extent).astype(np.int64)
    names = [c for c in rows.column_names if c not in ("geometry", "z", "x", "y")]
    numeric = pa.types.is_integer(rows.schema.field("id").type)
    if numeric:
        names.remove("id")
    columns = [(k, rows.column(c).to_pylist()) for k, c in enumerate(names)]
    ids = rows.column("id").to_pylist()
    empty = (np.diff(shapes.first) == 0).tolist()
    head, tail = _field(1, layer.encode()), _varint(5 << 3) + _varint(extent) + _varint(15 << 3) + _varint(2)
    keys, out = b"".join(_field(3, c.encode()) for c in names), []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        values: dict = {}
        made = []
        for row in range(lo, hi):
            if empty[row]:
                continue
            kind, commands = _commands(shapes, row, px, py)
            if not commands:
                continue
            tags = []
            for k, column in columns:
                v = column[row]
                if v is not None:
                    tags += [k, values.setdefault((type(v), v), len(values))]
            feature = (_varint(1 << 3) + _varint(ids[row])) if numeric and ids[row] is not None and ids[row] >= 0 else b""
            feature += _field(2, b"".join(map(_varint, tags))) if tags else b""
            made.append(_field(2, feature + _varint(3 << 3) + _varint(kind) + _field(4, b"".join(map(_varint, commands)))))
        out.append(_field(3, head + b"".join(made) + keys + b"".join(_field(4, _value(v)) for _, v in values) + tail))
    return out


def encode(tiled: DataFrame, layer: str, extent: int = EXTENT) -> DataFrame:
    """(z, x, y, tile) of features with z, x, y. A batch's tiles are encoded together; its last one waits for the rows that may follow."""

    def made(rows: pa.Table) -> pa.RecordBatch:
        place = [rows.column(c).to_numpy().astype(np.int64) for c in ("z", "x", "y")]
        new = np.any([c[1:] != c[:-1] for c in place], axis=0)
        first = np.concatenate([[0], np.flatnonzero(new) + 1, [rows.num_rows]])
        done = tiles_bytes(rows, layer, *place, first, extent)
        return pa.RecordBatch.from_arrays([*(pa.array(c[first[:-1]], pa.int32()) for c in place), pa.array(done, pa.binary())], names=["z", "x", "y", "tile"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            place = [batch.column(c).to_numpy() for c in ("z", "x", "y")]
            other = np.flatnonzero(np.any([c != c[-1] for c in place], axis=0))
            split = int(other[-1]) + 1 if len(other) else 0
            if not split and held and all(h.column(c)[0] == batch.column(c)[0] for h in held[-1:] for c in ("z", "x", "y")):
                held.append(batch)
                continue
            whole = [*held, batch.slice(0, split)] if split else held
            if whole:
                yield made(pa.Table.from_batches(whole))
            held = [batch.slice(split)]
        if held:
            yield made(pa.Table.from_batches(held))

    keys = ["z", "x", "y"]
    laid = tiled.repartition(*keys).sortWithinPartitions(*keys, F.asc_nulls_last("id"))
    return laid.mapInArrow(work, "z int, x int, y int, tile binary")


def fields(data: bytes):
    """(number, value) of a protobuf message: ints, or bytes of what has a length."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 0x7F) << shift
            if b < 0x80:
                return out
            shift += 7

    while at < len(data):
        tag = varint()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, varint()
        elif kind == 2:
            n = varint()
            yield tag >> 3, data[at : at + n]
            at += n
        else:
            n = 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + n]
            at += n


def read_counts(tiled: DataFrame) -> DataFrame:
    """tiled with n: the features in all layers of each tile."""

    @F.arrow_udf(spatial.LONG)
    def count(tile: pa.Array) -> pa.Array:
        return pa.array([sum(1 for k, layer in fields(t) if k == 3 for f, _ in fields(layer) if f == 2) for t in tile.to_pylist()], pa.int64())

    return tiled.withColumn("n", count("tile"))


def tile_id(z: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A tile's place in an archive: all lower zooms first, then along a Hilbert curve."""
    out = np.zeros(len(z), np.int64)
    for zoom in np.unique(z).tolist():
        at = np.flatnonzero(z == zoom)
        key, i, j, s = np.zeros(len(at), np.int64), x[at].astype(np.int64), y[at].astype(np.int64), 1 << zoom >> 1
        while s:
            a, b = ((i & s) > 0).astype(np.int64), ((j & s) > 0).astype(np.int64)
            key += s * s * ((3 * a) ^ b)
            flip = (b == 0) & (a == 1)
            i, j = np.where(flip, s - 1 - (i & (s - 1)), i & (s - 1)), np.where(flip, s - 1 - (j & (s - 1)), j & (s - 1))
            i, j = np.where(b == 0, j, i), np.where(b == 0, i, j)
            s >>= 1
        out[at] = ((1 << 2 * zoom) - 1) // 3 + key
    return out


def _directory(entries: list[tuple[int, int, int, int]]) -> bytes:
    """entries: (tile id, offset, length, run)."""
    out = bytearray(_varint(len(entries)))
    last = 0
    for i, *_ in entries:
        out += _varint(i - last)
        last = i
    for *_, run in entries:
        out += _varint(run)
    for _, _, length, _ in entries:
        out += _varint(length)
    for k, (_, offset, _, _) in enumerate(entries):
        out += _varint(0 if k and offset == entries[k - 1][1] + entries[k - 1][2] else offset + 1)
    return gzip.compress(bytes(out), mtime=0)


def write_archive(tiled: DataFrame, path: str, layer: str, leaf: int = 4096) -> int:
    """One PMTiles (version 3) file of the tiles (z, x, y, tile), in order of tile id; returns how many. The tiles stream through the driver, as
    the file is one; it keeps 4 numbers for each."""

    @F.arrow_udf(spatial.LONG)
    def place(z: pa.Array, x: pa.Array, y: pa.Array) -> pa.Array:
        return pa.array(tile_id(*(c.to_numpy() for c in (z, x, y))))

    ordered = tiled.withColumn("id", place("z", "x", "y")).orderBy("id")
    files, target = arrow_fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (arrow_fs.LocalFileSystem(), path)
    files.create_dir(target.rpartition("/")[0], recursive=True)
    entries: list[tuple[int, int, int, int]] = []
    zooms, size = [], 0
    with files.open_output_stream(f"{target}.data") as out:
        for r in ordered.toLocalIterator():
            data = gzip.compress(bytes(r.tile), mtime=0)
            out.write(data)
            entries.append((r.id, size, len(data), 1))
            size += len(data)
            zooms = [min([r.z, *zooms[:1]]), max([r.z, *zooms[1:]])]
    root, leaves = _directory(entries), b""
    if len(root) > 16_384 - 127:
        each = []
        for lo in range(0, len(entries), leaf):
            part = _directory(entries[lo : lo + leaf])
            each.append((entries[lo][0], len(leaves), len(part), 0))
            leaves += part
        root = _directory(each)
    meta = gzip.compress(json.dumps({"vector_layers": [{"id": layer, "fields": {}}]}).encode(), mtime=0)
    at = [127, 127 + len(root), 127 + len(root) + len(meta), 127 + len(root) + len(meta) + len(leaves)]
    low, high = zooms or [0, 0]
    head = b"PMTiles" + struct.pack("<B8Q3Q", 3, at[0], len(root), at[1], len(meta), at[2], len(leaves), at[3], size, len(entries), len(entries), len(entries))
    head += struct.pack("<6B4iB2i", 1, 2, 2, 1, low, high, -1_800_000_000, -850_000_000, 1_800_000_000, 850_000_000, low, 0, 0)
    with files.open_output_stream(target) as out, files.open_input_stream(f"{target}.data") as data:
        out.write(head + root + meta + leaves)
        while chunk := data.read(1 << 20):
            out.write(chunk)
    files.delete_file(f"{target}.data")
    return len(entries)
