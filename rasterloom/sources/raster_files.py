"""Georeferenced raster files: north-up TIFF with one byte a pixel, in degrees, tiled or in strips, plain or deflated.

Two ways to read them. read_blocks reads whole files, a file in a task, through Spark's own reader. RasterSource, the format "raster", plans
its tasks from the files' directories and reads ranges of bytes: filters on a box and on the level reach the plan, so that a window
costs the blocks that it touches, and a file of any size is dealt out over tasks."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

#: A block of a file: the corner in the north-west and the size of a pixel in degrees, and its pixels row by row.
BLOCKS = "path string, lon double, lat double, dlon double, dlat double, width int, height int, data binary"

# Tags, number types and compressions of the format.
WIDTH, HEIGHT, BITS, COMPRESSION, STRIPS, SAMPLES, STRIP_ROWS, STRIP_BYTES = 256, 257, 258, 259, 273, 277, 278, 279
PREDICTOR, TILE_WIDTH, TILE_HEIGHT, TILES, TILE_BYTES, PIXEL_SCALE, TIE_POINT = 317, 322, 323, 324, 325, 33550, 33922
TYPES = {1: "B", 3: "H", 4: "I", 12: "d", 16: "Q"}
PLAIN, DEFLATED, DEFLATED_OLD = 1, 8, 32946


def directories(read: Callable[[int, int], bytes]) -> Iterator[dict[int, tuple]]:
    """The tags of every directory of a file, classic or big. read: (place, bytes) to bytes."""
    head = read(0, 16)
    order = {b"II": "<", b"MM": ">"}.get(head[:2])
    version = struct.unpack_from(order + "H", head, 2)[0] if order and len(head) >= 8 else 0
    if version not in (42, 43):
        raise ValueError("not a TIFF file")
    word, at, count = ("Q", 8, "Q") if version == 43 else ("I", 4, "H")
    (at,) = struct.unpack_from(order + word, head, at)
    form = f"{order}HH{word}"
    fixed, room = struct.calcsize(form), struct.calcsize(word)
    while at:
        (entries,) = struct.unpack(order + count, read(at, struct.calcsize(count)))
        at += struct.calcsize(count)
        content, out = read(at, entries * (fixed + room) + room), {}
        for k in range(entries):
            place = k * (fixed + room)
            tag, kind, n = struct.unpack_from(form, content, place)
            if kind in TYPES:
                values = f"{order}{n}{TYPES[kind]}"
                if (size := struct.calcsize(values)) > room:
                    out[tag] = struct.unpack(values, read(struct.unpack_from(order + word, content, place + fixed)[0], size))
                else:
                    out[tag] = struct.unpack_from(values, content, place + fixed)
        yield out
        (at,) = struct.unpack_from(order + word, content, entries * (fixed + room))


@dataclass(frozen=True)
class Block:
    """Where a block lies in its file, and on the globe."""

    level: int
    place: int
    size: int
    west: float
    north: float
    dlon: float
    dlat: float
    wide: int
    width: int
    height: int
    compression: int
    predictor: int

    @property
    def edges(self) -> dict[str, float]:
        return {"west": self.west, "north": self.north, "east": self.west + self.width * self.dlon, "south": self.north - self.height * self.dlat}

    def pixels(self, data: bytes) -> np.ndarray:
        """Its pixels from its bytes; what the block has beyond the image is cut off."""
        values = np.frombuffer(data if self.compression == PLAIN else zlib.decompress(data), np.uint8)
        values = values[: len(values) // self.wide * self.wide].reshape(-1, self.wide)
        if self.predictor == 2:
            values = np.cumsum(values, axis=1, dtype=np.uint8)
        return np.ascontiguousarray(values[: self.height, : self.width])


def layout(read: Callable[[int, int], bytes]) -> Iterator[Block]:
    """The blocks of a file and of its reduced images, level 0 first. A reduced image covers what the whole one covers; blocks of 0 that a sparse
    file leaves out have none."""
    whole: tuple[float, ...] = ()
    for level, tags in enumerate(directories(read)):
        one = lambda tag, default=None: tags[tag][0] if tag in tags else default  # noqa: B023, E731
        width, height, compression, predictor = one(WIDTH), one(HEIGHT), one(COMPRESSION, PLAIN), one(PREDICTOR, 1)
        if one(BITS, 1) != 8 or one(SAMPLES, 1) != 1 or compression not in (PLAIN, DEFLATED, DEFLATED_OLD) or predictor not in (1, 2):
            raise ValueError("only one plain or deflated byte a pixel is read")
        if level == 0:
            if PIXEL_SCALE not in tags or TIE_POINT not in tags:
                raise ValueError("the file has no place on the globe")
            dlon, dlat = tags[PIXEL_SCALE][:2]
            i, j, _, east, north, _ = tags[TIE_POINT][:6]
            whole = (east - i * dlon, north + j * dlat, width * dlon, height * dlat)
        west, north, across_lon, across_lat = whole
        dlon, dlat = across_lon / width, across_lat / height
        if TILES in tags:
            wide, high, places, sizes = one(TILE_WIDTH), one(TILE_HEIGHT), tags[TILES], tags[TILE_BYTES]
        else:
            wide, high, places, sizes = width, one(STRIP_ROWS, height), tags[STRIPS], tags[STRIP_BYTES]
        across = -(-width // wide)
        for k, (place, size) in enumerate(zip(places, sizes, strict=True)):
            x, y = k % across * wide, k // across * high
            if size:
                yield Block(level, place, size, west + x * dlon, north - y * dlat, dlon, dlat, wide, min(wide, width - x), min(high, height - y), compression, predictor)


def blocks_of(content: bytes) -> Iterator[tuple[float, float, float, float, np.ndarray]]:
    """(lon, lat, dlon, dlat, pixels) of every block of a file's whole image."""
    for b in layout(lambda at, n: content[at : at + n]):
        if b.level == 0:
            yield b.west, b.north, b.dlon, b.dlat, b.pixels(content[b.place : b.place + b.size])


#: A block as the source gives it: its edges in degrees, the size of a pixel, and its pixels. level 0 is the whole image.
WINDOWS = "path string, level int, west double, north double, east double, south double, dlon double, dlat double, width int, height int, data binary"
PART_BYTES = 16 << 20
#: So many bytes are read at once of the front of a file, where directories mostly are.
FRONT_BYTES = 1 << 16


def open_ranges(path: str) -> Callable[[int, int], bytes]:
    """Reads ranges of a file, on this machine or in a store that Arrow knows by its address."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    held = system.open_input_file(name)

    def read(at: int, n: int) -> bytes:
        held.seek(at)
        return held.read(n)

    return read


def with_front(read: Callable[[int, int], bytes]) -> Callable[[int, int], bytes]:
    """The same, with the front of the file read once."""
    front = read(0, FRONT_BYTES)
    return lambda at, n: front[at : at + n] if at + n <= len(front) else read(at, n)


@dataclass
class Part(InputPartition):
    """Blocks of one file, by place."""

    path: str
    blocks: list[Block]

    def __init__(self, path: str, blocks: list[Block]):
        super().__init__(None)
        self.path, self.blocks = path, blocks


COMPARED = {GreaterThan: lambda a, b: a > b, GreaterThanOrEqual: lambda a, b: a >= b, LessThan: lambda a, b: a < b, LessThanOrEqual: lambda a, b: a <= b, EqualTo: lambda a, b: a == b}
PRUNED_BY = ("level", "west", "north", "east", "south")


class RasterReader(DataSourceReader):
    def __init__(self, paths: list[str], part_bytes: int):
        self.paths, self.part_bytes, self.held = paths, part_bytes, []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Comparisons of an edge or of the level with a constant are met by the plan; others are left to Spark."""
        for f in filters:
            if type(f) in COMPARED and len(f.attribute) == 1 and f.attribute[0] in PRUNED_BY:
                self.held.append((f.attribute[0], COMPARED[type(f)], f.value))
            else:
                yield f

    def wanted(self, b: Block) -> bool:
        seen = {"level": b.level, **b.edges}
        return all(compare(seen[name], value) for name, compare, value in self.held)

    def partitions(self) -> list[Part]:
        """Only directories are read here, many files at a time; a part is neighbouring blocks of a file."""
        with ThreadPoolExecutor(16) as pool:
            found = list(pool.map(lambda p: [b for b in layout(with_front(open_ranges(p))) if self.wanted(b)], self.paths))
        out = []
        for path, blocks in zip(self.paths, found, strict=True):
            part, size = [], 0
            for b in sorted(blocks, key=lambda b: b.place):
                if part and size + b.size > self.part_bytes:
                    out.append(Part(path, part))
                    part, size = [], 0
                part.append(b)
                size += b.size
            if part:
                out.append(Part(path, part))
        return out or [Part("", [])]

    def read(self, partition: Part) -> Iterator[tuple]:
        read = open_ranges(partition.path) if partition.blocks else None
        for b in partition.blocks:
            e = b.edges
            yield partition.path, b.level, e["west"], e["north"], e["east"], e["south"], b.dlon, b.dlat, b.width, b.height, b.pixels(read(b.place, b.size)).tobytes()


class RasterSource(DataSource):
    """Format "raster". Options: path (a file, or lines of files), part_bytes (of a task's blocks, about)."""

    @classmethod
    def name(cls) -> str:
        return "raster"

    def schema(self) -> str:
        return WINDOWS

    def reader(self, schema) -> RasterReader:
        return RasterReader([p for p in self.options.get("path", "").splitlines() if p], int(self.options.get("part_bytes", PART_BYTES)))


def read_windows(spark: SparkSession, paths: list[str], part_bytes: int = PART_BYTES) -> DataFrame:
    """WINDOWS of the named files; filters on level and edges are pushed into the plan."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(RasterSource)
    return spark.read.format("raster").option("part_bytes", part_bytes).load("\n".join(paths))


def window(blocks: DataFrame, west: float, south: float, east: float, north: float, level: int = 0) -> DataFrame:
    """BLOCKS of a level that a half-open box in degrees touches, for warp_blocks."""
    c = F.col
    touched = blocks.where((c("level") == level) & (c("west") < east) & (c("east") > west) & (c("south") < north) & (c("north") > south))
    return touched.select("path", c("west").alias("lon"), c("north").alias("lat"), "dlon", "dlat", "width", "height", "data")


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    """BLOCKS of all files that a path (or pattern) names."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for f in frame.itertuples(index=False):
                for lon, lat, dlon, dlat, pixels in blocks_of(bytes(f.content)):
                    yield pd.DataFrame({"path": [f.path], "lon": [lon], "lat": [lat], "dlon": [dlon], "dlat": [dlat], "width": [pixels.shape[1]], "height": [pixels.shape[0]], "data": [pixels.tobytes()]})

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, BLOCKS)
