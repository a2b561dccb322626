"""Polygons as well-known binary (multi-polygons, little-endian), and ring clipping."""

from __future__ import annotations

import math
import struct

import numpy as np

from ..plans.settings import MERC

Point = tuple[float, float]


def wkb(polygons: list[list[list[Point]]]) -> bytes:
    """A multi-polygon: polygons of rings of points; rings are closed here."""
    out = [struct.pack("<BII", 1, 6, len(polygons))]
    for rings in polygons:
        out.append(struct.pack("<BII", 1, 3, len(rings)))
        for ring in rings:
            closed = [*ring, ring[0]]
            out.append(struct.pack(f"<I{2 * len(closed)}d", len(closed), *(c for p in closed for c in p)))
    return b"".join(out)


def from_wkb(data: bytes) -> list[list[list[Point]]]:
    """Polygons of open rings."""
    order, kind, n = struct.unpack_from("<BII", data)
    if (order, kind) != (1, 6):
        raise ValueError("not a little-endian multi-polygon")
    at, out = 9, []
    for _ in range(n):
        rings = []
        (count,) = struct.unpack_from("<I", data, at + 5)
        at += 9
        for _ in range(count):
            (points,) = struct.unpack_from("<I", data, at)
            flat = struct.unpack_from(f"<{2 * points}d", data, at + 4)
            at += 4 + 16 * points
            rings.append(list(zip(flat[:-2:2], flat[1:-2:2], strict=True)))
        out.append(rings)
    return out


def lonlat(x: float, y: float) -> Point:
    return x / MERC * 180, math.degrees(math.atan(math.sinh(y / MERC * math.pi)))


def mercator(lon: float, lat: float) -> Point:
    return lon / 180 * MERC, MERC / math.pi * math.asinh(math.tan(math.radians(lat)))


def mercator_ring(ring: list[Point]) -> np.ndarray:
    """mercator of all points, a row each."""
    lon, lat = np.array(ring).T
    return np.stack([lon / 180 * MERC, MERC / math.pi * np.arcsinh(np.tan(np.radians(lat)))], axis=1)


def area(ring: list[Point]) -> float:
    if len(ring) >= LARGE:
        x, y = np.array(ring).T
        return float((x * np.roll(y, -1) - np.roll(x, -1) * y).sum()) / 2
    return sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def polygon_area(rings: list[list[Point]]) -> float:
    """The outer ring's area without the holes'."""
    return abs(area(rings[0])) - sum(abs(area(r)) for r in rings[1:])


#: From so many points on, a ring is clipped as an array.
LARGE = 48


def clip_half(ring: list[Point], axis: int, limit: float, keep_less: bool) -> list[Point]:
    """The part of a ring on one side of an axis-parallel line (Sutherland and Hodgman, 1974)."""
    along = [p[axis] for p in ring]
    low, high = min(along), max(along)
    if (high <= limit) if keep_less else (low >= limit):
        return ring
    if (low > limit) if keep_less else (high < limit):
        return []
    if len(ring) >= LARGE:
        return clip_large(ring, axis, limit, keep_less)
    out = []
    for p, q in zip(ring, ring[1:] + ring[:1], strict=True):
        inside, next_inside = ((c <= limit) if keep_less else (c >= limit) for c in (p[axis], q[axis]))
        if inside:
            out.append(p)
        if inside != next_inside:
            t = (limit - p[axis]) / (q[axis] - p[axis])
            cut = (p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1]))
            out.append((limit, cut[1]) if axis == 0 else (cut[0], limit))
    return out


def clip_large(ring: list[Point], axis: int, limit: float, keep_less: bool) -> list[Point]:
    """The same with arrays: each point if it is inside, then the place where its edge crosses the line, if it does."""
    p = np.array(ring)
    q = np.roll(p, -1, axis=0)
    inside = p[:, axis] <= limit if keep_less else p[:, axis] >= limit
    crosses = inside != np.roll(inside, -1)
    both = np.stack([p, p], axis=1)
    at = np.flatnonzero(crosses)
    t = (limit - p[at, axis]) / (q[at, axis] - p[at, axis])
    both[at, 1] = p[at] + t[:, None] * (q[at] - p[at])
    both[at, 1, axis] = limit
    return list(map(tuple, both[np.stack([inside, crosses], axis=1)].tolist()))


def clip(rings: list[list[Point]], x0: float, y0: float, x1: float, y1: float) -> list[list[Point]]:
    """A polygon cut to a rectangle; an empty list if nothing is left of its outer ring."""
    out = []
    for i, ring in enumerate(rings):
        for axis, limit, less in ((0, x0, False), (0, x1, True), (1, y0, False), (1, y1, True)):
            ring = clip_half(ring, axis, limit, less) if len(ring) >= 3 else []
        if len(ring) >= 3 and area(ring):
            out.append(ring)
        elif i == 0:
            return []
    return out
