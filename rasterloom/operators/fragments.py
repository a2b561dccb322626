"""Blocks into tagged polygon fragments: z, bx, by, layer, kind, geom (multi-polygon, degrees).

A block's window is read once. Its branch decides the work: empty blocks give nothing, uniform ones their rectangle, the others the
full chain: classify, sieve, crop, polygonize, simplify shared edges, and only then drop no-data, tag and reproject."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import block_window
from ..functions.geometry import lonlat, wkb
from ..plans.settings import LEGEND, MERC, Grid
from ..sources.legend import legend
from .classify import classify_array, fold_array
from .regions import area2, label, sieve, simplify_coverage

FRAGMENT = "z int, bx int, by int, layer string, kind string, geom binary"
#: Fragments and log rows come out of one pass; record_type tells them apart.
RECORD = "record_type string, " + FRAGMENT + ", branch string, ms long, ended double, present string, channels int, n_polygons long, geom_bytes long"
KIND = {idx: (layer, kind) for idx, _, layer, kind, _, _ in LEGEND if layer is not None}


def window_box(z: int, bx: int, by: int, grid: Grid) -> tuple[int, int, int, int]:
    """x0, y0, x1, y1 of a block's window in pixels of level z."""
    size, m, block = grid.size_px(z), grid.margin_px, grid.block_px
    return max(0, bx * block - m), max(0, by * block - m), min(size, (bx + 1) * block + m), min(size, (by + 1) * block + m)


def inner_box(z: int, bx: int, by: int, grid: Grid) -> tuple[int, int, int, int]:
    size, block = grid.size_px(z), grid.block_px
    return bx * block, by * block, min(size, (bx + 1) * block), min(size, (by + 1) * block)


def projected(x: float, y: float, z: int, grid: Grid) -> tuple[float, float]:
    """Degrees of a pixel corner."""
    px = grid.metres_per_px(z)
    return lonlat(x * px - MERC, MERC - y * px)


def polygons_of(rings: list[list[tuple[int, int]]]) -> list[list[list[tuple[int, int]]]]:
    """One polygon of a region's rings: outer ring and holes (a 4-connected region has a single outer ring)."""
    outer = [r for r in rings if area2(r) > 0]
    return [[*outer, *(r for r in rings if area2(r) < 0)]] if outer else []


def block_polygons(values: np.ndarray, z: int, bx: int, by: int, grid: Grid) -> list[tuple[int, list[list[tuple[int, int]]]]]:
    """(channel, rings in pixels of level z) of a full block, no-data included."""
    x0, y0, _, _ = window_box(z, bx, by, grid)
    ix0, iy0, ix1, iy1 = inner_box(z, bx, by, grid)
    cleaned = sieve(classify_array(values, z, grid), grid.sieve_px)
    inner = cleaned[iy0 - y0 : iy1 - y0, ix0 - x0 : ix1 - x0]
    labels = label(inner)
    simple = simplify_coverage(labels, grid.tolerance(z) / grid.metres_per_px(z))
    flat = inner.ravel()
    return [(int(flat[r]), [[(x + ix0, y + iy0) for x, y in ring] for ring in rings]) for r, rings in sorted(simple.items())]


def process_window(values: np.ndarray, z: int, bx: int, by: int, grid: Grid) -> list[dict]:
    """Fragment records and one log record of a block."""
    began = time.perf_counter()
    present = np.unique(values)
    active = sorted({int(c) for c in fold_array(present, z)} - {0})
    branch = "empty" if not active else "uniform" if len(present) == 1 else "full"
    out: list[dict] = []
    if branch == "uniform":
        x0, y0, x1, y1 = inner_box(z, bx, by, grid)
        shapes = [(active[0], [[(x0, y1), (x1, y1), (x1, y0), (x0, y0)]])]
    else:
        shapes = block_polygons(values, z, bx, by, grid) if branch == "full" else []
    for channel, rings in shapes:
        if channel in KIND:
            parts = [rings] if branch == "uniform" else polygons_of(rings)
            layer, kind = KIND[channel]
            geom = wkb([[[projected(x, y, z, grid) for x, y in ring] for ring in p] for p in parts])
            out.append({"record_type": "fragment", "layer": layer, "kind": kind, "geom": geom, "geom_bytes": len(geom)})
    log = {"record_type": "log", "branch": branch, "kind": KIND[active[0]][1] if branch == "uniform" else None, "present": ",".join(map(str, present)), "channels": len(active) if branch == "full" else None, "ms": int((time.perf_counter() - began) * 1000), "ended": time.time(), "n_polygons": len(out), "geom_bytes": sum(f["geom_bytes"] for f in out)}
    return [{"z": z, "bx": bx, "by": by} | r for r in [*out, log]]


def process_blocks(chunks: DataFrame, grid: Grid, count: Callable[[int], None] | None = None) -> DataFrame:
    """Records of all blocks; count is called with 1 for each (an accumulator's add). chunks: z, bx, by, x0, y0, width, height, data (uint8 bytes, row by row) - pieces of each block's window.

    A group is one window, whose size the grid fixes; what no piece covers is 0."""
    names = [f.split(" ")[0] for f in RECORD.split(", ")]

    def run(pieces: pd.DataFrame) -> pd.DataFrame:
        z, bx, by = (int(pieces[c].iat[0]) for c in ("z", "bx", "by"))
        x0, y0, x1, y1 = window_box(z, bx, by, grid)
        values = np.zeros((y1 - y0, x1 - x0), np.uint8)
        for p in pieces.itertuples(index=False):
            a = np.frombuffer(p.data, np.uint8).reshape(p.height, p.width)
            u0, v0, u1, v1 = max(x0, p.x0), max(y0, p.y0), min(x1, p.x0 + p.width), min(y1, p.y0 + p.height)
            if u0 < u1 and v0 < v1:
                values[v0 - y0 : v1 - y0, u0 - x0 : u1 - x0] = a[v0 - p.y0 : v1 - p.y0, u0 - p.x0 : u1 - p.x0]
        made = process_window(values, z, bx, by, grid)
        if count:
            count(1)
        return pd.DataFrame([[r.get(n) for n in names] for r in made], columns=names, dtype=object)

    return chunks.groupBy("z", "bx", "by").applyInPandas(run, RECORD)


def only_value(data: Column) -> Column:
    """The value of a chunk that holds a single one; -1 of others."""
    first = F.substring(data, 1, 1)
    return F.when(data == F.rpad(data.substr(1, 1), F.octet_length(data), first), F.conv(F.hex(first), 16, 10).cast("int")).otherwise(-1)


def chunk_span(low: Column, high: Column, chunk: int) -> Column:
    """How many chunks along an axis the pixels [low, high) touch."""
    return F.floor((high - 1) / chunk) - F.floor(low / chunk) + 1


def settled_blocks(chunks: DataFrame, blocks: DataFrame, grid: Grid, chunk: int = 512) -> DataFrame:
    """z, bx, by, only: the value of blocks whose whole window has a single one by the stored chunks' `only` (level, cx, cy, only), null for others.

    No pixel is read: a window that no stored chunk touches is 0; one that all its chunks cover has their value if they agree."""
    held = block_keys(chunks, grid, chunk).groupBy("z", "bx", "by").agg(F.count("*").alias("n"), F.min("only").alias("low"), F.max("only").alias("high"))
    m, size = grid.margin_px, grid.block_px
    last = (F.lit(grid.tile_px) * F.pow(F.lit(2.0), F.col("z"))).cast("int")
    ends = lambda c: (F.greatest(F.lit(0), F.col(c) * size - m), F.least(last, (F.col(c) + 1) * size + m))
    whole = chunk_span(*ends("bx"), chunk) * chunk_span(*ends("by"), chunk)
    only = F.when(F.col("n").isNull(), 0).when((F.col("low") == F.col("high")) & (F.col("low") >= 0) & (F.col("n") == whole), F.col("low"))
    return blocks.select("z", "bx", "by").join(held, ["z", "bx", "by"], "left").select("z", "bx", "by", only.alias("only"))


def settle(blocks: DataFrame, grid: Grid, count: Callable[[int], None] | None = None) -> DataFrame:
    """Records of settled blocks (z, bx, by, only), as process_blocks makes them, from their places alone."""
    names = [f.split(" ")[0] for f in RECORD.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            made = [r for b in frame.itertuples(index=False) for r in process_window(np.array([[b.only]], np.uint8), b.z, b.bx, b.by, grid)]
            if count:
                count(len(frame))
            yield pd.DataFrame([[r.get(n) for n in names] for r in made], columns=names, dtype=object)

    return blocks.select("z", "bx", "by", "only").mapInPandas(run, RECORD)


def fragments_of(records: DataFrame) -> DataFrame:
    return records.where("record_type = 'fragment'").select("z", "bx", "by", "layer", "kind", "geom")


def log_of(records: DataFrame) -> DataFrame:
    """A row per block: id, branch, ms, ts (its end), bytes by layer, present values, channels (full blocks), kind (uniform blocks)."""
    sizes = records.where("record_type = 'fragment'").groupBy("z", "bx", "by").agg(*(F.sum(F.when(F.col("layer") == layer, F.col("geom_bytes"))).alias(name) for layer, name in (("land", "land_bytes"), ("water_polygons", "water_bytes"))))
    blocks = records.where("record_type = 'log'").select("z", "bx", "by", "branch", "ms", F.col("ended").cast("timestamp").alias("ts"), "present", "channels", "kind")
    return blocks.join(sizes, ["z", "bx", "by"], "left")


def uniform_fragments(uniform: DataFrame, grid: Grid) -> DataFrame:
    """Rectangles of uniform blocks, relational: z, bx, by, layer, kind, west, south, east, north. uniform: z, bx, by, channel."""
    spark = uniform.sparkSession
    box = block_window(F.col("z"), F.col("bx"), F.col("by"), grid)
    kinds = legend(spark).where("layer is not null").select(F.col("idx").alias("channel"), "layer", "kind")
    return uniform.join(F.broadcast(kinds), "channel").select("z", "bx", "by", "layer", "kind", *(box[c].alias(c) for c in ("west", "south", "east", "north")))


def tag(regions: DataFrame, codes: DataFrame, keys: list[str]) -> DataFrame:
    """Regions with their layer and kind; no-data (code 1) has no partner and drops out. codes: keys, code, channel."""
    spark = regions.sparkSession
    kinds = legend(spark).where("layer is not null").select(F.col("idx").alias("channel"), "layer", "kind")
    return regions.join(codes, [*keys, "code"]).join(F.broadcast(kinds), "channel")


def union_fragments(parts: list[DataFrame]) -> DataFrame:
    """All fragments by z and layer: bag union, columns by name, whatever else a part carries."""
    out = parts[0].select("z", "bx", "by", "layer", "kind", "geom")
    for p in parts[1:]:
        out = out.unionByName(p.select("z", "bx", "by", "layer", "kind", "geom"))
    return out


def layers_by_zoom(fragments: DataFrame) -> DataFrame:
    """z, n_land, n_water: what a zoom's tiles are made from. A zoom without fragments has no row, and gets no tiles; a layer with none is
    left out of its zoom's tiles."""
    count = lambda layer: F.count_if(F.col("layer") == layer)
    return fragments.where("geom is not null").groupBy("z").agg(count("land").alias("n_land"), count("water_polygons").alias("n_water"))


def chunk_pixels(pixels: DataFrame, chunk: int = 512) -> DataFrame:
    """Sparse storage: level, cx, cy, data; chunks of nothing but 0 have no row. pixels: level, x, y, value."""

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        a = np.zeros((chunk, chunk), np.uint8)
        a[group["y"] % chunk, group["x"] % chunk] = group["value"]
        cx, cy = int(group["x"].iat[0]) // chunk, int(group["y"].iat[0]) // chunk
        return pd.DataFrame({"level": group["level"].iloc[:1], "cx": [cx], "cy": [cy], "data": [a.tobytes()]})

    some = pixels.where("value <> 0").withColumns({"cx": F.floor(F.col("x") / chunk), "cy": F.floor(F.col("y") / chunk)})
    return some.groupBy("level", "cx", "cy").applyInPandas(pack, "level int, cx int, cy int, data binary")


def mode_of_four(a: np.ndarray) -> np.ndarray:
    """The mode of each 2 x 2 cell, the smallest value on a tie."""
    low, second, third, high = np.sort(np.stack([a[::2, ::2], a[::2, 1::2], a[1::2, ::2], a[1::2, 1::2]]), axis=0)
    return np.where(low == second, low, np.where(second == third, second, np.where(third == high, third, low)))


def halve_chunks(chunks: DataFrame, chunk: int = 512) -> DataFrame:
    """The next coarser level of stored chunks (cx, cy, data): four chunks make one, and never more rows than that meet in a task's group.

    Chunks that aren't stored are 0, and 0 is counted; a chunk of nothing but 0 isn't stored."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        out = np.zeros((chunk, chunk), np.uint8)
        half = chunk // 2
        for p in group.itertuples(index=False):
            x, y = p.cx % 2 * half, p.cy % 2 * half
            out[y : y + half, x : x + half] = mode_of_four(np.frombuffer(p.data, np.uint8).reshape(chunk, chunk))
        place = {"cx": [int(group["cx"].iat[0]) // 2], "cy": [int(group["cy"].iat[0]) // 2], "data": [out.tobytes()]}
        return pd.DataFrame(place if out.any() else {k: [] for k in place})

    places = [F.floor(F.col(c) / 2) for c in ("cx", "cy")]
    return chunks.select("cx", "cy", "data").groupBy(*(p.alias(f"parent_{c}") for p, c in zip(places, ("cx", "cy"), strict=True))).applyInPandas(run, "cx int, cy int, data binary")


def block_keys(chunks: DataFrame, grid: Grid, chunk: int = 512) -> DataFrame:
    """Chunks with z, bx, by of each block whose window they overlap."""
    m, size = grid.margin_px, grid.block_px
    span = lambda c: F.sequence(F.greatest(F.lit(0), F.floor((F.col(c) * chunk - m) / size)), F.floor((F.col(c) * chunk + chunk - 1 + m) / size))
    placed = chunks.withColumn("bx", F.explode(span("cx"))).withColumn("by", F.explode(span("cy")))
    return placed.withColumns({"z": F.col("level").cast("int"), "bx": F.col("bx").cast("int"), "by": F.col("by").cast("int")})


def chunks_for_blocks(chunks: DataFrame, blocks: DataFrame, grid: Grid, chunk: int = 512) -> DataFrame:
    """Each chunk once for every block whose window it overlaps, plus an empty piece per block so that all blocks are processed.

    Zoom z reads level z. Block ids come from arithmetic on the chunk's place; the join only keeps planned blocks."""
    placed = block_keys(chunks, grid, chunk)
    placed = placed.select("z", "bx", "by", (F.col("cx") * chunk).cast("int").alias("x0"), (F.col("cy") * chunk).cast("int").alias("y0"), F.lit(chunk).alias("width"), F.lit(chunk).alias("height"), "data")
    none = blocks.select("z", "bx", "by", F.lit(0).alias("x0"), F.lit(0).alias("y0"), F.lit(0).alias("width"), F.lit(0).alias("height"), F.lit(b"").alias("data"))
    return placed.join(blocks.select("z", "bx", "by"), ["z", "bx", "by"], "left_semi").unionByName(none)
