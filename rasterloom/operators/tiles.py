"""Fragments to tiles: which tiles a feature covers, cutting and quantising, byte budgets, and merging of tile sets.

Tiles are rows: z, tx, ty, layer, kind, geom (multi-polygon in tile units, 0..extent, y downward)."""

from __future__ import annotations

import gzip
import math
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geometry import Point, area, clip, from_wkb, mercator_ring, polygon_area, wkb
from ..functions.mvt import decode, encode, encode_sorted, merged
from ..plans.settings import MERC, WORLD

EXTENT = 4096
BUFFER = 80
TILE = "z int, tx int, ty int, layer string, kind string, geom binary"
COLUMNS = ["z", "tx", "ty", "layer", "kind", "geom"]
FLUSH_BYTES = 4 << 20
FLUSH_ROWS = 10_000
#: Bytes of an encoded feature besides its geometry, and what a feature and its names take at most.
FEATURE_BYTES, HEADER_BYTES = 8, 200
#: Bytes that an edge takes, about.
EDGE_BYTES = 3

Feature = tuple[str, str, list[list[list[Point]]]]


def tile_range(low: Column, high: Column, z: Column, buffer: float = 0.0) -> Column:
    """Tile numbers that touch [low, high] in tile units at zoom z, with a buffer in tiles."""
    last = (F.pow(F.lit(2.0), z) - 1).cast("int")
    return F.sequence(F.greatest(F.lit(0), F.floor(low - buffer).cast("int")), F.least(last, F.greatest(F.ceil(high + buffer) - 1, F.floor(low)).cast("int")))


def tile_explode(boxes: DataFrame, buffer: float = 0.0) -> DataFrame:
    """A row per tile that a box (z, u0, v0, u1, v1 in tile units) touches."""
    z = F.col("z")
    out = boxes.withColumn("tx", F.explode(tile_range(F.col("u0"), F.col("u1"), z, buffer)))
    return out.withColumn("ty", F.explode(tile_range(F.col("v0"), F.col("v1"), z, buffer)))


def pieces_of(rings: list[list[Point]], tx0: int, ty0: int, tx1: int, ty1: int, extent: int, buffer: int) -> Iterator[tuple[int, int, list[list[Point]]]]:
    """(tx, ty, rings) of a polygon's pieces in the tiles tx0..tx1, ty0..ty1 (with buffer). The range is halved again and again, so a point
    is looked at once for each halving, not once for each tile."""
    rings = clip(rings, tx0 * extent - buffer, ty0 * extent - buffer, (tx1 + 1) * extent + buffer, (ty1 + 1) * extent + buffer)
    if not rings:
        return
    if (tx0, ty0) == (tx1, ty1):
        yield tx0, ty0, rings
    elif tx1 - tx0 >= ty1 - ty0:
        half = (tx0 + tx1) // 2
        yield from pieces_of(rings, tx0, ty0, half, ty1, extent, buffer)
        yield from pieces_of(rings, half + 1, ty0, tx1, ty1, extent, buffer)
    else:
        half = (ty0 + ty1) // 2
        yield from pieces_of(rings, tx0, ty0, tx1, half, extent, buffer)
        yield from pieces_of(rings, tx0, half + 1, tx1, ty1, extent, buffer)


def rounded(rings: list[list[Point]], x0: float, y0: float) -> list[list[Point]]:
    return [[(float(round(x - x0)), float(round(y - y0))) for x, y in ring] for ring in rings]


def cut_tiles(fragments: DataFrame, extent: int = EXTENT, buffer: int = BUFFER) -> DataFrame:
    """Every fragment cut to each tile it touches (with buffer), in integer tile units. Batch by batch, no shuffle.

    A fragment ends at its block's edge, so it reaches few tiles, and no task holds more than one fragment's pieces beyond FLUSH_BYTES."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out, held = [], 0
        for frame in frames:
            for f in frame.itertuples(index=False):
                n, cut = 1 << f.z, defaultdict(list)
                scale = n * extent / WORLD
                for rings in from_wkb(f.geom):
                    units = [list(map(tuple, ((mercator_ring(ring) * (1, -1) + MERC) * scale).tolist())) for ring in rings]
                    (left, right), (top, bottom) = ((min(c), max(c)) for c in zip(*units[0], strict=True))
                    first, last = (max(0, int((c - buffer) // extent)) for c in (left, top)), (min(n - 1, int((c + buffer) // extent)) for c in (right, bottom))
                    for tx, ty, piece in pieces_of(units, *first, *last, extent, buffer):
                        piece = rounded(piece, tx * extent, ty * extent)
                        if polygon_area(piece):
                            cut[tx, ty].append(piece)
                out += [(f.z, tx, ty, f.layer, f.kind, wkb(p)) for (tx, ty), p in sorted(cut.items())]
                held += len(f.geom)
                if held >= FLUSH_BYTES:
                    yield pd.DataFrame(out, columns=COLUMNS)
                    out, held = [], 0
        if out:
            yield pd.DataFrame(out, columns=COLUMNS)

    return fragments.select("z", "layer", "kind", "geom").mapInPandas(run, TILE)


def snapped(ring: list[Point], step: int) -> list[Point]:
    """The ring in units of `step`, without repeated points, points on straight stretches and spikes; empty if nothing is left of it.

    Every point moves by its own place only, so rings that share a border still do."""
    out: list[Point] = []
    for x, y in ring:
        p = (float(round(x / step) * step), float(round(y / step) * step))
        if not out or out[-1] != p:
            out.append(p)
    changed = True
    while changed and len(out) >= 3:
        changed = False
        for i in range(len(out) - 1, -1, -1):
            if len(out) < 3:
                break
            (ax, ay), (bx, by), (cx, cy) = out[i - 1], out[i % len(out)], out[(i + 1) % len(out)]
            if (bx - ax) * (cy - by) == (cx - bx) * (by - ay):
                del out[i]
                changed = True
    return out if len(out) >= 3 and area(out) else []


def coarser(polygons: list[list[list[Point]]], step: int) -> list[list[list[Point]]]:
    """Polygons in units of `step`; those that are smaller vanish, and their neighbours' borders meet in their place."""
    out = []
    for rings in polygons:
        kept = [r for r in (snapped(ring, step) for ring in rings[:1]) if r]
        if kept:
            out.append(kept + [r for r in (snapped(ring, step) for ring in rings[1:]) if r])
    return out


class Faces:
    """The polygons of a tile as faces over directed edges. Outer rings turn one way and holes the other, so a border that two polygons of a layer
    share is an edge of one and, reversed, of the other. Dissolving takes such pairs of edges away; what is left are the rings of both
    together, and no area is lost."""

    def __init__(self, features: list[Feature]):
        self.features = features
        self.edges: list[set[tuple[Point, Point]]] = []
        self.feature: list[int] = []
        self.area: list[float] = []
        self.owner: dict[tuple[str, Point, Point], int] = {}
        for n, (layer, _, polygons) in enumerate(features):
            for rings in polygons:
                face, edges = len(self.edges), set()
                for i, ring in enumerate(rings):
                    ring = ring if (area(ring) > 0) == (i == 0) else ring[::-1]
                    edges |= {(p, q) for p, q in zip(ring, ring[1:] + ring[:1], strict=True) if p != q}
                edges = {(p, q) for p, q in edges if (q, p) not in edges}  # a spike bounds nothing
                self.edges.append(edges)
                self.feature.append(n)
                self.area.append(polygon_area(rings))
                for p, q in edges:  # an edge that another face has too is shared with neither's neighbours
                    self.owner.setdefault((layer, p, q), face)
        self.heap = [(size, face) for face, size in enumerate(self.area)]
        heapify(self.heap)

    def layer(self, face: int) -> str:
        return self.features[self.feature[face]][0]

    def dissolve_smallest(self) -> int | None:
        """Takes the smallest face that has a neighbour into the one with which its border is longest (the larger, then the first, on a tie).
        Returns how many edges that saves, or None if no face has a neighbour any more."""
        while self.heap:
            size, face = heappop(self.heap)
            if self.area[face] != size or not self.edges[face]:
                continue
            layer, border = self.layer(face), defaultdict(float)
            for p, q in self.edges[face]:
                other = self.owner.get((layer, q, p), face)
                if other != face and (q, p) in self.edges[other]:
                    border[other] += math.hypot(q[0] - p[0], q[1] - p[1])
            if border:
                into = max(border, key=lambda f: (border[f], self.area[f], -f))
                shared = {(p, q) for p, q in self.edges[face] if (q, p) in self.edges[into]}
                self.edges[into] -= {(q, p) for p, q in shared}
                self.edges[into] |= self.edges[face] - shared
                for p, q in self.edges[face]:
                    if self.owner.get((layer, p, q)) == face:
                        self.owner[layer, p, q] = into
                self.edges[face] = set()
                self.area[into] += size
                heappush(self.heap, (self.area[into], into))
                return 2 * len(shared)
        return None

    def rows(self) -> list[Feature]:
        """The features as they are now; those whose faces have all gone into others are no more."""
        held: dict[int, list[list[list[Point]]]] = defaultdict(list)
        for face, edges in enumerate(self.edges):
            if edges:
                held[self.feature[face]] += polygons_of_edges(edges)
        return [(*self.features[n][:2], polygons) for n, polygons in sorted(held.items()) if polygons]


def polygons_of_edges(edges: set[tuple[Point, Point]]) -> list[list[list[Point]]]:
    """Polygons (outer ring and holes) that directed edges bound. Where a boundary touches itself, each ring keeps to its own side."""
    leaving: dict[Point, list[Point]] = defaultdict(list)
    for p, q in sorted(edges):
        leaving[p].append(q)
    rings = []
    for start in sorted(leaving):
        while leaving[start]:
            ring, p, q = [start], start, leaving[start].pop(0)
            while q != start:
                ring.append(q)
                back = math.atan2(p[1] - q[1], p[0] - q[0])
                ways = leaving[q]
                nth = min(range(len(ways)), key=lambda k: (back - math.atan2(ways[k][1] - q[1], ways[k][0] - q[0])) % math.tau or math.tau)  # noqa: B023
                p, q = q, ways.pop(nth)
            rings.append(ring)
    outer = [[r] for r in rings if area(r) > 0]
    box = lambda r: (min(x for x, _ in r), min(y for _, y in r), max(x for x, _ in r), max(y for _, y in r))
    for hole in (r for r in rings if area(r) < 0):
        x0, y0, x1, y1 = box(hole)
        around = [o for o in outer if (b := box(o[0]))[0] <= x0 and b[1] <= y0 and b[2] >= x1 and b[3] >= y1]
        min(around or outer, key=lambda o: area(o[0])).append(hole)
    return outer


def within_budget(features: list[Feature], budget: int, extent: int) -> list[Feature]:
    """Features (layer, kind, polygons) whose encoded tile has at most `budget` bytes. Of an over-full tile the smallest polygons are dissolved
    into their neighbours in the layer, one after the other, so that the layer covers what it did. Polygons that touch no other are
    joined, as parts, to the largest feature of their layer and kind. Only if that isn't enough, coordinates are rounded to 2, 4, 8 ... units."""

    def size() -> int:
        return len(encode(rows, extent))

    rows = sorted(features, key=lambda f: (sum(map(polygon_area, f[2])), f[0], f[1], wkb(f[2])))
    over = size() - budget
    if over <= 0:
        return rows
    faces, more = Faces(rows), True
    while over > 0 and more:
        saved = 0
        while more and saved < over:
            gone = faces.dissolve_smallest()
            more = gone is not None
            saved += FEATURE_BYTES + EDGE_BYTES * (gone or 0)
        rows = faces.rows()
        over = size() - budget
    rows.sort(key=lambda f: (sum(map(polygon_area, f[2])), f[0], f[1], wkb(f[2])))
    largest = {f[:2]: i for i, f in enumerate(rows)}
    parts, gone = {i: [rows[i][2]] for i in largest.values()}, set()
    for i, f in enumerate(rows):
        if over > 0 and largest[f[:2]] != i:
            parts[largest[f[:2]]].append(f[2])
            gone.add(i)
            over -= FEATURE_BYTES
    rows = [(*f[:2], [p for part in parts.get(i, [f[2]]) for p in part]) for i, f in enumerate(rows) if i not in gone]
    step = 2
    while rows and size() > budget:
        rows = [f for f in ((layer, kind, coarser(polygons, step)) for layer, kind, polygons in rows) if f[2]]
        step *= 2
    return rows


def coalesce_smallest(tiles: DataFrame, budget: int, extent: int = EXTENT) -> DataFrame:
    """Tiles whose encoded form has at most budget bytes each, see within_budget. Tiles that are sure to fit skip the grouped pass: a feature
    takes fewer bytes encoded than as it is stored, but for its header and names."""
    total = tiles.groupBy("z", "tx", "ty").agg((F.sum(F.octet_length("geom") + HEADER_BYTES)).alias("bytes"))
    sized = tiles.join(total, ["z", "tx", "ty"])
    fits = sized.where(F.col("bytes") <= budget).drop("bytes")

    def shrink(group: pd.DataFrame) -> pd.DataFrame:
        rows = within_budget([(r.layer, r.kind, from_wkb(r.geom)) for r in group.itertuples(index=False)], budget, extent)
        first = group.iloc[0]
        return pd.DataFrame([(first.z, first.tx, first.ty, layer, kind, wkb(p)) for layer, kind, p in rows], columns=COLUMNS)

    return fits.unionByName(sized.where(F.col("bytes") > budget).drop("bytes").groupBy("z", "tx", "ty").applyInPandas(shrink, TILE))


def encode_tiles(tiles: DataFrame, extent: int = EXTENT, *, compress: bool = False) -> DataFrame:
    """z, tx, ty and the encoded tile, gzipped if asked for. A group is one tile. Spark sorts its features, and they pass by in batches, so
    of a tile with very many of them (coalesce_smallest keeps it under a budget) only the encoded form is held."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((layer, kind, from_wkb(geom)) for batch in batches for layer, kind, geom in zip(*(batch.column(c).to_pylist() for c in ("layer", "kind", "geom")), strict=True))
        data = encode_sorted(rows, extent)
        place = [pa.array([k.as_py()], pa.int32()) for k in key]
        yield pa.RecordBatch.from_arrays([*place, pa.array([gzip.compress(data, mtime=0) if compress else bytes(data)], pa.binary())], ["z", "tx", "ty", "data"])

    place = ["z", "tx", "ty"]
    ordered = tiles.select(COLUMNS).repartition(*place).sortWithinPartitions(COLUMNS)
    return ordered.groupBy(*place).applyInArrow(run, "z int, tx int, ty int, data binary")


def smallest_first(features: DataFrame, keys: list[str], budget: int) -> DataFrame:
    """Adds `merged`: whether a feature (area, bytes, id) is among the smallest of its group, whose removal brings the group under budget."""
    from pyspark.sql import Window

    group = Window.partitionBy(*keys)
    order = group.orderBy("area", "id")
    over = F.sum("bytes").over(group) - budget
    before = F.sum("bytes").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return features.withColumn("merged", F.coalesce(before, F.lit(0)) < over)


def zoom_union(parts: list[DataFrame]) -> DataFrame:
    """Tile sets of different zooms as one. A zoom that two of them share is an error, found when it is run."""
    from functools import reduce

    tagged = reduce(DataFrame.unionByName, [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)])
    clash = tagged.groupBy("z").agg(F.count_distinct("_part").alias("n")).where("n > 1")
    if not clash.isEmpty():
        raise ValueError("tile sets share a zoom")
    return tagged.drop("_part")


def merge_features(one: DataFrame, two: DataFrame) -> DataFrame:
    """All features of both tile sets, tile by tile; none is dropped or joined."""
    return one.unionByName(two, allowMissingColumns=True)


def merge_blobs(one: DataFrame, two: DataFrame, column: str = "data") -> DataFrame:
    """The same for encoded tiles: a full outer join by place, contents one after the other."""
    empty = F.lit(b"")
    pair = one.withColumnRenamed(column, "_one").join(two.withColumnRenamed(column, "_two"), ["z", "tx", "ty"], "full_outer")
    return pair.select("z", "tx", "ty", F.concat(F.coalesce("_one", empty), F.coalesce("_two", empty)).alias(column))


COMPRESSIONS = ("none", "gzip")


def unpacked(data: bytes | None, compression: str) -> bytes:
    return b"" if not data else gzip.decompress(data) if compression == "gzip" else bytes(data)


def merge_tiles(one: DataFrame, two: DataFrame, compressions: tuple[str, str] = ("none", "none"), compression: str = "none") -> DataFrame:
    """Encoded tiles of two sets (z, tx, ty, data) as one set: a full outer join by place. A tile that both have gets each layer once, with all
    features of both; layers that only one of them has stay as they are. Sides may be compressed differently."""
    for c in (*compressions, compression):
        if c not in COMPRESSIONS:
            raise ValueError(f"tiles compressed by {c} can't be merged; known are {', '.join(COMPRESSIONS)}")
    same = compressions == (compression, compression)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out, held = [], 0
            for z, tx, ty, a, b in zip(*(f[c] for c in ("z", "tx", "ty", "_one", "_two")), strict=True):
                if same and (a is None or b is None):
                    tile = a if b is None else b
                else:
                    tile = merged([unpacked(a, compressions[0]), unpacked(b, compressions[1])])
                    tile = gzip.compress(tile, mtime=0) if compression == "gzip" else tile
                out.append((z, tx, ty, tile))
                held += len(tile)
                if held >= FLUSH_BYTES:
                    yield pd.DataFrame(out, columns=["z", "tx", "ty", "data"])
                    out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=["z", "tx", "ty", "data"])

    sides = [df.select("z", "tx", "ty", F.col("data").alias(name)) for df, name in ((one, "_one"), (two, "_two"))]
    return sides[0].join(sides[1], ["z", "tx", "ty"], "full_outer").mapInPandas(run, "z int, tx int, ty int, data binary")


FEATURE = "z int, tx int, ty int, nth_layer int, layer string, kind string, area double, extent int"


def decode_tiles(tiles: DataFrame, compression: str = "none") -> DataFrame:
    """A row for each feature of encoded tiles: FEATURE. area is that of its rings, holes taken off; kind is its attribute of that name."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = ((t.z, t.tx, t.ty, nth, layer, said.get("kind"), sum(map(area, rings)), extent) for t in f.itertuples(index=False) for nth, layer, said, _, rings, extent in decode(unpacked(t.data, compression)))
            while some := list(islice(rows, FLUSH_ROWS)):
                yield pd.DataFrame(some, columns=[c.split(" ")[0] for c in FEATURE.split(", ")])

    return tiles.select("z", "tx", "ty", "data").mapInPandas(run, FEATURE)
