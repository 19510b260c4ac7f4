"""Planar kernels over columns of geometries in WKB.

A column is decoded once into flat arrays (``Shapes``) and every measure works on all rows of a batch together, over edges with the number of their
row. Polygons may be concave, have holes and several parts that don't overlap. Boundaries: within excludes them, intersects includes touching.
Geometries of other kinds (lines, collections), empty and null ones have no edges: measures of them are null and predicates false.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

POINT, LINE, POLYGON, MULTIPOLYGON = 1, 2, 3, 6
#: Edge pairs, or edges times slabs, that are worked on at once.
TOGETHER = 1 << 20
Parts = list[list[np.ndarray]]


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated aranges: for each i the positions starts[i] .. starts[i]+lengths[i]-1."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()), dtype=np.int64)


def _read(data: bytes, at: int = 0) -> tuple[int, list[np.ndarray], list[bool], int]:
    """(kind, rings, whether each is a shell, next place) of a geometry in ISO or extended WKB; z and m are left out."""
    order = "<" if data[at] == 1 else ">"
    (code,) = struct.unpack_from(f"{order}I", data, at + 1)
    at += 5 + (4 if code & 0x20000000 else 0)
    dims = 2 + bool(code & 0x80000000) + bool(code & 0x40000000)
    code &= 0x0FFFFFFF
    dims, kind = max(dims, 2 + (1 if code // 1000 in (1, 2) else 2 if code // 1000 == 3 else 0)), code % 1000

    def points(at: int, n: int) -> tuple[np.ndarray, int]:
        return np.frombuffer(data, f"{order}f8", dims * n, at).reshape(n, dims)[:, :2].astype(float), at + 8 * dims * n

    if kind == POINT:
        xy, at = points(at, 1)
        return (kind, [], [], at) if np.isnan(xy).all() else (kind, [xy], [True], at)
    (n,) = struct.unpack_from(f"{order}I", data, at)
    at += 4
    rings: list[np.ndarray] = []
    shell: list[bool] = []
    if kind == LINE:
        xy, at = points(at, n)
        return kind, [xy], [True], at
    if kind == POLYGON:
        for k in range(n):
            (m,) = struct.unpack_from(f"{order}I", data, at)
            xy, at = points(at + 4, m)
            if m:
                rings.append(xy)
                shell.append(k == 0)
        return kind, rings, shell, at
    if kind in (4, 5, 6, 7):
        for _ in range(n):
            _, more, which, at = _read(data, at)
            rings += more
            shell += which
        return kind, rings, shell, at
    raise ValueError(f"not a WKB geometry: type {kind}")


@dataclass
class Shapes:
    """Geometries as flat arrays: vertices (x, y), where rings begin among them, which rings are shells, where rows begin among rings, kinds."""

    x: np.ndarray
    y: np.ndarray
    ring: np.ndarray
    shell: np.ndarray
    first: np.ndarray
    kind: np.ndarray

    def __len__(self) -> int:
        return len(self.kind)

    @classmethod
    def of(cls, rows: list[tuple[int, list[np.ndarray], list[bool]]]) -> Shapes:
        rings = [r for _, some, _ in rows for r in some]
        xy = np.concatenate([np.zeros((0, 2)), *rings])
        ring = np.concatenate([[0], np.cumsum([len(r) for r in rings], dtype=np.int64)]).astype(np.int64)
        first = np.concatenate([[0], np.cumsum([len(some) for _, some, _ in rows], dtype=np.int64)]).astype(np.int64)
        return cls(xy[:, 0].copy(), xy[:, 1].copy(), ring, np.array([s for _, _, some in rows for s in some], bool), first, np.array([k for k, *_ in rows], np.int64))

    @classmethod
    def from_wkb(cls, column: pa.Array) -> Shapes:
        """A null, or what is no WKB, is a row of kind 0."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = column.cast(pa.large_binary()).fill_null(b"")
        n = len(column)
        offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1] if n else np.zeros(1, np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
        size = np.diff(offsets)
        # columns of points, and most polygons, are little-endian; they are decoded together
        if n and (size == 21).all():
            rows = data[offsets[0] : offsets[-1]].reshape(n, 21)
            xy = np.ascontiguousarray(rows[:, 5:]).view("<f8")
            if (rows[:, :5] == (1, POINT, 0, 0, 0)).all() and not np.isnan(xy).all(axis=1).any():
                return cls(xy[:, 0].copy(), xy[:, 1].copy(), np.arange(n + 1), np.ones(n, bool), np.arange(n + 1), np.full(n, POINT))
        plain = size >= 13
        at = offsets[:-1][plain]
        words = lambda k: np.ndarray.view(data[at[:, None] + np.arange(k, k + 4)], "<u4")[:, 0].astype(np.int64)
        if len(at):
            plain[plain] = (data[at] == 1) & (words(1) == POLYGON) & (words(5) == 1) & (size[plain] == 13 + 16 * words(9)) & (words(9) > 0)
        if plain.all() and n:
            count = (size - 13) // 16
            bytes_ = data[ragged(offsets[:-1] + 13, count * 16)]
            xy = bytes_.view("<f8").reshape(-1, 2)
            return cls(xy[:, 0].copy(), xy[:, 1].copy(), np.concatenate([[0], np.cumsum(count)]), np.ones(n, bool), np.arange(n + 1), np.full(n, POLYGON))
        rows = []
        for a, b in zip(offsets.tolist(), offsets[1:].tolist(), strict=False):
            try:
                kind, rings, shell, _ = _read(data[a:b].tobytes()) if b > a else (0, [], [], 0)
            except (struct.error, ValueError, IndexError):
                kind, rings, shell = 0, [], []
            rows.append((kind, rings, shell))
        return cls.of(rows)

    def parts(self, row: int) -> Parts:
        """Of a row: polygons, each a shell and its holes."""
        out: Parts = []
        for k in range(self.first[row], self.first[row + 1]):
            ring = np.stack([self.x[self.ring[k] : self.ring[k + 1]], self.y[self.ring[k] : self.ring[k + 1]]], axis=1)
            if self.shell[k] or not out:
                out.append([ring])
            else:
                out[-1].append(ring)
        return out

    def take(self, rows: np.ndarray) -> Shapes:
        rings = ragged(self.first[rows], np.diff(self.first)[rows])
        size = np.diff(self.ring)[rings]
        at = ragged(self.ring[rings], size)
        return Shapes(self.x[at], self.y[at], np.concatenate([[0], np.cumsum(size)]), self.shell[rings], np.concatenate([[0], np.cumsum(np.diff(self.first)[rows])]), self.kind[rows])

    @property
    def polygonal(self) -> np.ndarray:
        return np.isin(self.kind, (POLYGON, MULTIPOLYGON)) & (np.diff(self.first) > 0)

    def vertices(self) -> np.ndarray:
        """The row of each vertex."""
        return np.repeat(np.repeat(np.arange(len(self)), np.diff(self.first)), np.diff(self.ring))

    def edges(self) -> tuple[np.ndarray, ...]:
        """(row, x0, y0, x1, y1) of the edges of polygonal rows, in order of row; rings are closed."""
        size = np.diff(self.ring)
        row = self.vertices()
        follow = np.arange(len(self.x)) + 1
        ends = self.ring[1:][size > 0] - 1
        follow[ends] = self.ring[:-1][size > 0]
        keep = self.polygonal[row] & ((self.x != self.x[follow]) | (self.y != self.y[follow])) if len(row) else np.zeros(0, bool)
        at = np.flatnonzero(keep)
        return row[at], self.x[at], self.y[at], self.x[follow[at]], self.y[follow[at]]

    def bounds(self) -> np.ndarray:
        """(rows, 4): xmin, ymin, xmax, ymax; nan of empty ones."""
        row, out = self.vertices(), np.full((len(self), 4), np.nan)
        if len(row):
            head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            who = row[head]
            out[who] = np.stack([np.minimum.reduceat(self.x, head), np.minimum.reduceat(self.y, head), np.maximum.reduceat(self.x, head), np.maximum.reduceat(self.y, head)], axis=1)
        return out

    def _rings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, signed area, first moments about the ring's first vertex in x and y, +1 or -1 by shell or hole) of each ring."""
        size = np.diff(self.ring)
        of = np.repeat(np.arange(len(size)), size)
        follow = np.arange(len(self.x)) + 1
        follow[self.ring[1:][size > 0] - 1] = self.ring[:-1][size > 0]
        x, y = self.x - self.x[self.ring[of]], self.y - self.y[self.ring[of]]
        cross = x * y[follow] - x[follow] * y
        total = lambda v: np.bincount(of, v, len(size))
        return np.repeat(np.arange(len(self)), np.diff(self.first)), total(cross) / 2, total((x + x[follow]) * cross) / 6, total((y + y[follow]) * cross) / 6, np.where(self.shell, 1.0, -1.0)

    def area(self) -> np.ndarray:
        """Holes go off; nan of what is no polygon."""
        row, signed, _, _, sign = self._rings()
        return np.where(self.polygonal, np.bincount(row, np.abs(signed) * sign, len(self)), np.nan)

    def centroid(self) -> tuple[np.ndarray, np.ndarray]:
        """Weighted by area; of a point itself, of what has no area the mean of its vertices."""
        row, signed, mx, my, sign = self._rings()
        turn = sign * np.where(signed >= 0, 1.0, -1.0)
        start = self.ring[:-1]
        # about the row's first vertex, so that far places lose no digits
        base = start[np.minimum(self.first[:-1], max(0, len(start) - 1))] if len(start) else np.zeros(len(self), np.int64)
        with np.errstate(divide="ignore", invalid="ignore"):
            if len(start):
                dx, dy = self.x[start] - self.x[base[row]], self.y[start] - self.y[base[row]]
            else:
                dx = dy = np.zeros(0)
            total = np.bincount(row, turn * signed, len(self))
            cx = np.bincount(row, turn * (mx + dx * signed), len(self)) / total
            cy = np.bincount(row, turn * (my + dy * signed), len(self)) / total
            if len(self.x):
                cx, cy = cx + self.x[base], cy + self.y[base]
            v = self.vertices()
            n = np.bincount(v, minlength=len(self))
            mean = (np.bincount(v, self.x, len(self)) / n, np.bincount(v, self.y, len(self)) / n)
        flat = ~self.polygonal | (total == 0)
        return np.where(flat, mean[0], cx), np.where(flat, mean[1], cy)


def to_wkb(parts: Parts) -> bytes:
    """A Polygon, or a MultiPolygon of several parts."""

    def one(rings: list[np.ndarray]) -> bytes:
        return struct.pack("<BII", 1, POLYGON, len(rings)) + b"".join(struct.pack("<I", len(r)) + np.ascontiguousarray(r, "<f8").tobytes() for r in rings)

    return one(parts[0]) if len(parts) == 1 else struct.pack("<BII", 1, MULTIPOLYGON, len(parts)) + b"".join(map(one, parts))


def point_wkb(x: float, y: float) -> bytes:
    return struct.pack("<BIdd", 1, POINT, x, y)


def points_wkb(x: np.ndarray, y: np.ndarray) -> pa.Array:
    """A column of points."""
    rows = np.zeros((len(x), 21), np.uint8)
    rows[:, 0], rows[:, 1] = 1, POINT
    rows[:, 5:] = np.stack([x, y], axis=1).astype("<f8").view(np.uint8)
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(0, 21 * len(x) + 1, 21, dtype=np.int32)), pa.py_buffer(rows)])


def box(x0: float, y0: float, x1: float, y1: float) -> Parts:
    return [[np.array([[x0, y0], [x1, y0], [x1, y1], [x0, y1], [x0, y0]], float)]]


def rings_wkb(first: np.ndarray, xy: np.ndarray) -> pa.Array:
    """Polygons of one ring each: row i has the vertices xy[first[i]:first[i+1]], already closed."""
    n = np.diff(first)
    size = 13 + 16 * n
    offsets = np.concatenate([[0], np.cumsum(size)])
    data = np.zeros(int(offsets[-1]), np.uint8)
    head = np.zeros((len(n), 13), np.uint8)
    head[:, 0], head[:, 1], head[:, 5] = 1, POLYGON, 1
    head[:, 9:13] = n.astype("<u4").view(np.uint8).reshape(-1, 4)
    data[offsets[:-1, None] + np.arange(13)] = head
    data[ragged(offsets[:-1] + 13, 16 * n)] = np.ascontiguousarray(xy, "<f8").view(np.uint8).ravel()
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)])


def _number(v: float) -> str:
    return f"{v:.15g}"


def to_wkt(shapes: Shapes, row: int) -> str | None:
    """Of points and polygons; None of others."""
    kind = int(shapes.kind[row])
    if kind == POINT:
        at = shapes.ring[shapes.first[row]]
        return f"POINT ({_number(shapes.x[at])} {_number(shapes.y[at])})" if shapes.first[row + 1] > shapes.first[row] else "POINT EMPTY"
    if kind not in (POLYGON, MULTIPOLYGON):
        return None
    name = "POLYGON" if kind == POLYGON else "MULTIPOLYGON"
    parts = shapes.parts(row)
    if not parts:
        return f"{name} EMPTY"
    text = [f"({', '.join('(' + ', '.join(f'{_number(x)} {_number(y)}' for x, y in r) + ')' for r in rings)})" for rings in parts]
    return f"POLYGON {text[0]}" if kind == POLYGON else f"MULTIPOLYGON ({', '.join(text)})"


def from_wkt(text: str) -> bytes | None:
    """WKB of a point, polygon or multipolygon; None of other text."""
    found = re.match(r"\s*(POINT|POLYGON|MULTIPOLYGON)\s*(?:Z|M|ZM)?\s*(\(.*\))\s*$", text or "", re.S | re.I)
    if not found:
        return None
    kind, body = found.groups()
    ring = lambda s: np.array([[float(v) for v in p.split()[:2]] for p in s.split(",")])
    if kind.upper() == "POINT":
        x, y = body.strip("() ").split(",")[0].split()[:2]
        return point_wkb(float(x), float(y))
    polygons = re.findall(r"\(\s*(\([^()]*\)(?:\s*,\s*\([^()]*\))*)\s*\)", body)
    return to_wkb([[ring(r) for r in re.findall(r"\(([^()]*)\)", p)] for p in polygons]) if polygons else None


def from_coordinates(kind: str, coordinates: list) -> bytes | None:
    """WKB of a GeoJSON geometry."""
    ring = lambda r: np.array(r, float)[:, :2]
    if kind == "Point":
        return point_wkb(*coordinates[:2])
    if kind == "Polygon":
        return to_wkb([[ring(r) for r in coordinates]])
    if kind == "MultiPolygon":
        return to_wkb([[ring(r) for r in p] for p in coordinates])
    return None


def within(px: np.ndarray, py: np.ndarray, shapes: Shapes) -> np.ndarray:
    """Whether point i lies inside shape i: holes respected, boundary excluded."""
    row, ax, ay, bx, by = shapes.edges()
    x, y = px[row], py[row]
    crosses = (ay > y) != (by > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        left = x < ax + (y - ay) / (by - ay) * (bx - ax)
    odd = np.bincount(row[crosses & left], minlength=len(shapes)) % 2 == 1
    on = ((bx - ax) * (y - ay) == (by - ay) * (x - ax)) & (np.minimum(ax, bx) <= x) & (x <= np.maximum(ax, bx)) & (np.minimum(ay, by) <= y) & (y <= np.maximum(ay, by))
    return odd & (np.bincount(row[on], minlength=len(shapes)) == 0)


def distance(px: np.ndarray, py: np.ndarray, shapes: Shapes) -> np.ndarray:
    """From point i to shape i: 0 inside and on the boundary; nan of what has no edges."""
    row, ax, ay, bx, by = shapes.edges()
    out = np.full(len(shapes), np.nan)
    if len(row):
        dx, dy, x, y = bx - ax, by - ay, px[row] - ax, py[row] - ay
        t = np.clip((x * dx + y * dy) / (dx * dx + dy * dy), 0, 1)
        far = np.sqrt((x - t * dx) ** 2 + (y - t * dy) ** 2)
        head = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        out[row[head]] = np.minimum.reduceat(far, head)
        out[within(px, py, shapes)] = 0.0
    return out


def _batches(cost: np.ndarray) -> list[np.ndarray]:
    """Rows cut so that each cut has about TOGETHER of cost, or one row."""
    total, out, lo = np.cumsum(cost), [], 0
    while lo < len(cost):
        hi = max(lo + 1, int(np.searchsorted(total, (total[lo - 1] if lo else 0) + TOGETHER, "right")))
        out.append(np.arange(lo, hi))
        lo = hi
    return out


def _edge_pairs(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(edge of a, edge of b): every two of one row."""
    na, nb = np.bincount(a[0], minlength=n), np.bincount(b[0], minlength=n)
    each = np.repeat(nb, na)  # for each edge of a
    return np.repeat(np.arange(len(a[0])), each), ragged(np.repeat(np.cumsum(nb) - nb, na), each)


def _turn(ax, ay, bx, by, cx, cy):
    return (bx - ax) * (cy - ay) - (by - ay) * (cx - ax)


def intersects(a: Shapes, b: Shapes) -> np.ndarray:
    """Whether polygons i of both meet, touching included."""
    out = np.zeros(len(a), bool)
    cost = np.diff(a.ring[a.first]) * np.diff(b.ring[b.first]) + 1
    for rows in _batches(cost):
        s, t = a.take(rows), b.take(rows)
        e, f = s.edges(), t.edges()
        i, j = _edge_pairs(e, f, len(rows))
        (row, p0, p1, q0, q1), (_, r0, r1, s0, s1) = (x[i] for x in e), (x[j] for x in f)
        o1, o2 = np.sign(_turn(p0, p1, q0, q1, r0, r1)), np.sign(_turn(p0, p1, q0, q1, s0, s1))
        o3, o4 = np.sign(_turn(r0, r1, s0, s1, p0, p1)), np.sign(_turn(r0, r1, s0, s1, q0, q1))
        meet = (np.maximum(p0, q0) >= np.minimum(r0, s0)) & (np.maximum(r0, s0) >= np.minimum(p0, q0)) & (np.maximum(p1, q1) >= np.minimum(r1, s1)) & (np.maximum(r1, s1) >= np.minimum(p1, q1))
        touch = np.bincount(row[(o1 * o2 <= 0) & (o3 * o4 <= 0) & meet], minlength=len(rows)) > 0
        # else one may lie in the other: parts don't overlap, so any vertex of each part tells
        for inner, outer in ((s, t), (t, s)):
            rings = np.flatnonzero(np.diff(inner.ring) > 0)
            of = np.repeat(np.arange(len(rows)), np.diff(inner.first))[rings]
            at = inner.ring[rings]
            touch |= np.bincount(of[within(inner.x[at], inner.y[at], outer.take(of))], minlength=len(rows)) > 0
        out[rows] = touch & s.polygonal & t.polygonal
    return out


def intersection_area(a: Shapes, b: Shapes) -> np.ndarray:
    """Area that polygons i of both share; nan if one is none.

    The plane is cut at every x where a vertex lies or two edges cross. Within a slab no edges cross, so the shared length along its
    middle times its width is its share of the area: exact for any polygon, and without rounding where coordinates are few binary digits.
    """
    out = np.full(len(a), np.nan)
    n, m = np.diff(a.ring[a.first]), np.diff(b.ring[b.first])
    for rows in _batches((n + m) * (n + m) + n * m + 1):
        out[rows] = _shared(a.take(rows), b.take(rows))
    return out


def _shared(a: Shapes, b: Shapes) -> np.ndarray:
    n = len(a)
    base = np.zeros((n, 2))
    full = np.diff(a.first) > 0
    at = a.ring[a.first[:-1][full]]
    base[full, 0], base[full, 1] = a.x[at], a.y[at]
    local = lambda e: (e[0], e[1] - base[e[0], 0], e[2] - base[e[0], 1], e[3] - base[e[0], 0], e[4] - base[e[0], 1])
    e, f = local(a.edges()), local(b.edges())
    i, j = _edge_pairs(e, f, n)
    (row, p0, p1, q0, q1), (_, r0, r1, s0, s1) = (x[i] for x in e), (x[j] for x in f)
    with np.errstate(divide="ignore", invalid="ignore"):
        t = _turn(r0, r1, s0, s1, p0, p1) / (_turn(r0, r1, s0, s1, p0, p1) - _turn(r0, r1, s0, s1, q0, q1))
        u = _turn(p0, p1, q0, q1, r0, r1) / (_turn(p0, p1, q0, q1, r0, r1) - _turn(p0, p1, q0, q1, s0, s1))
        cross = np.flatnonzero((t > 0) & (t < 1) & (u > 0) & (u < 1))
    where = np.concatenate([e[0], f[0], row[cross]])
    x = np.concatenate([e[1], f[1], p0[cross] + t[cross] * (q0 - p0)[cross]])
    order = np.lexsort((x, where))
    where, x = where[order], x[order]
    slab = np.flatnonzero((where[1:] == where[:-1]) & (x[1:] > x[:-1]))
    of, width, middle = where[slab], x[slab + 1] - x[slab], (x[slab] + x[slab + 1]) / 2
    number, height, mine = [], [], []
    for edges, which in ((e, 0), (f, 1)):
        count = np.bincount(edges[0], minlength=n)
        start = np.cumsum(count) - count
        k, s = ragged(start[of], count[of]), np.repeat(np.arange(len(of)), count[of])
        mid, x0, x1 = middle[s], edges[1][k], edges[3][k]
        hit = (np.minimum(x0, x1) < mid) & (mid < np.maximum(x0, x1))
        k, s, mid = k[hit], s[hit], mid[hit]
        x0, y0, x1, y1 = (edges[c][k] for c in (1, 2, 3, 4))
        number.append(s)
        height.append(y0 + (mid - x0) / (x1 - x0) * (y1 - y0))
        mine.append(np.full(len(k), which))
    s, y, which = np.concatenate(number), np.concatenate(height), np.concatenate(mine)
    order = np.lexsort((y, s))
    s, y, which = s[order], y[order], which[order]
    # every slab has an even number of either's edges, so parities run on from slab to slab
    inside = (np.cumsum(which == 0) % 2 == 1) & (np.cumsum(which == 1) % 2 == 1)
    step = np.flatnonzero(inside[:-1] & (s[1:] == s[:-1]))
    length = np.bincount(s[step], y[step + 1] - y[step], len(of))
    return np.where(a.polygonal & b.polygonal, np.bincount(of, width * length, n), np.nan)


def iou(a: Shapes, b: Shapes) -> np.ndarray:
    """Shared area over united area; nan if there is none."""
    both = intersection_area(a, b)
    union = a.area() + b.area() - both
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(union == 0, np.nan, both / union)


def hull_ring(xy: np.ndarray) -> np.ndarray:
    """The convex hull of points as a closed counter-clockwise ring (monotone chain); no corners on straight lines."""
    points = sorted(set(map(tuple, xy.tolist())))

    def half(ps):
        out: list = []
        for p in ps:
            while len(out) > 1 and _turn(*out[-2], *out[-1], *p) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    ring = half(points) + half(points[::-1])
    return np.array([*ring, ring[0]]) if ring else np.array(points * 2)


def convex_hulls(shapes: Shapes) -> Shapes:
    rows = []
    at = shapes.ring[shapes.first]
    for k in range(len(shapes)):
        xy = np.stack([shapes.x[at[k] : at[k + 1]], shapes.y[at[k] : at[k + 1]]], axis=1)
        rows.append((POLYGON, [hull_ring(xy)], [True]) if len(xy) else (0, [], []))
    return Shapes.of(rows)


def _loops(ring: np.ndarray) -> list[np.ndarray]:
    """A closed ring as simple closed loops: cut where edges cross, and where it meets a vertex again."""
    a, b = ring[:-1], ring[1:]
    extra: list[list[tuple[float, tuple[float, float]]]] = [[] for _ in a]
    n = len(a)
    for i in range(n):
        j = np.arange(i + 1, n)
        o1, o2 = _turn(*a[i], *b[i], a[j, 0], a[j, 1]), _turn(*a[i], *b[i], b[j, 0], b[j, 1])
        o3, o4 = _turn(a[j, 0], a[j, 1], b[j, 0], b[j, 1], *a[i]), _turn(a[j, 0], a[j, 1], b[j, 0], b[j, 1], *b[i])
        for k in np.flatnonzero((o1 * o2 < 0) & (o3 * o4 < 0)):
            t, u = o3[k] / (o3[k] - o4[k]), o1[k] / (o1[k] - o2[k])
            p = tuple(a[i] + t * (b[i] - a[i]))
            extra[i].append((float(t), p))
            extra[j[k]].append((float(u), p))
    path = [p for k in range(n) for p in [tuple(a[k]), *(q for _, q in sorted(extra[k]))]]
    out, stack, place = [], [], {}
    for p in [*path, path[0]]:
        if p in place:
            loop = [*stack[place[p] :], p]
            for q in stack[place[p] + 1 :]:
                del place[q]
            del stack[place[p] + 1 :]
            if len(loop) > 3:
                out.append(np.array(loop))
        else:
            place[p] = len(stack)
            stack.append(p)
    return out


def make_valid(parts: Parts) -> Parts:
    """Closes rings, drops repeated vertices and empty rings, cuts rings that cross or touch themselves into loops, turns shells
    counter-clockwise and holes clockwise. Rings that cross other rings are left as they are."""
    out: Parts = []
    for rings in parts:
        shells: Parts = []
        for k, r in enumerate(rings):
            r = r if (r[0] == r[-1]).all() else np.vstack([r, r[:1]])
            r = r[np.concatenate([[True], (r[1:] != r[:-1]).any(axis=1)])]
            for loop in _loops(r) if len(r) > 3 else []:
                x, y = (loop - loop[0]).T
                turn = float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum())
                if turn:
                    loop = loop if (turn > 0) == (k == 0) else loop[::-1]
                    if k == 0:
                        shells.append([loop])
                    elif shells:
                        shape = Shapes.of([(POLYGON, [s[0]], [True]) for s in shells])
                        middle = loop[:-1].mean(axis=0)
                        inside = np.flatnonzero(within(np.full(len(shells), middle[0]), np.full(len(shells), middle[1]), shape))
                        shells[int(inside[0]) if len(inside) else 0].append(loop)
            if k == 0 and not shells:
                break
        out += shells
    return out


def is_valid(parts: Parts) -> bool:
    """Rings are closed, have area, and neither cross nor touch themselves."""
    for rings in parts:
        for r in rings:
            if len(r) < 4 or not (r[0] == r[-1]).all():
                return False
            loops = _loops(r[np.concatenate([[True], (r[1:] != r[:-1]).any(axis=1)])])
            if len(loops) != 1:
                return False
    return bool(parts)


def hilbert(x: np.ndarray, y: np.ndarray, bounds: tuple[float, float, float, float] = (-180, -90, 180, 90), bits: int = 16) -> np.ndarray:
    """Place of points on a Hilbert curve over the bounds."""
    x0, y0, x1, y1 = bounds
    top = (1 << bits) - 1
    i = np.clip(np.nan_to_num((np.asarray(x) - x0) / (x1 - x0) * top), 0, top).astype(np.int64)
    j = np.clip(np.nan_to_num((np.asarray(y) - y0) / (y1 - y0) * top), 0, top).astype(np.int64)
    key, s = np.zeros_like(i), 1 << (bits - 1)
    while s:
        a, b = ((i & s) > 0).astype(np.int64), ((j & s) > 0).astype(np.int64)
        key += s * s * ((3 * a) ^ b)
        flip = (b == 0) & (a == 1)
        i, j = np.where(flip, s - 1 - (i & (s - 1)), i & (s - 1)), np.where(flip, s - 1 - (j & (s - 1)), j & (s - 1))
        i, j = np.where(b == 0, j, i), np.where(b == 0, i, j)
        s >>= 1
    return key


RADIUS = 6378137.0


def project(x: np.ndarray, y: np.ndarray, source: int, target: int) -> tuple[np.ndarray, np.ndarray]:
    """Between degrees (4326, and 4269, which counts as the same) and web mercator metres (3857); others raise.

    Latitudes count as angles: beyond a pole y is that of the same angle within a turn, and nan (no place) on the far side."""
    degrees, mercator = (4326, 4269), 3857
    if source in degrees and target in degrees or source == target:
        return x, y
    if source in degrees and target == mercator:
        near = np.where(np.abs(y) <= 90, np.clip(y, -89.999999, 89.999999), y)  # the poles themselves get a finite y
        with np.errstate(invalid="ignore"):
            return np.radians(x) * RADIUS, np.log(np.tan(np.pi / 4 + np.radians(near) / 2)) * RADIUS
    if source == mercator and target in degrees:
        return np.degrees(x / RADIUS), np.degrees(2 * np.arctan(np.exp(y / RADIUS)) - np.pi / 2)
    raise ValueError(f"no transformation from {source} to {target}")
