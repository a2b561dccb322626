"""Source blocks in degrees to chunks of a level of the projected grid, by dominant value.

A target pixel takes the source cells whose centres it covers, in each direction; where the target is finer than the source and covers
none, it takes the cell that its own centre is in. So no pixel inside a source is left out, at any latitude.

A block counts the values that each target pixel takes from it, chunk by chunk, in the task that has read it; only these counts are
shuffled, by chunk. Whether a pixel covers a centre follows from the source's lattice, so blocks needn't know their neighbours. Sources of
any number need no mosaic first: a pixel on the border of two tiles adds up both tiles' counts. Where sources overlap each of them
counts, so the value that most of them have wins; resample.mosaic is for sources of which the later one shall win."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from ..plans.settings import MERC, Grid

COUNTS = "cx int, cy int, counts binary"


def rows_at(lat: np.ndarray, z: int, grid: Grid) -> np.ndarray:
    """Places of latitudes in pixel rows, as fractions; beyond the square less than 0 or more than its size."""
    with np.errstate(all="ignore"):
        y = (MERC - MERC / np.pi * np.arcsinh(np.tan(np.radians(np.clip(lat, -89.9999, 89.9999))))) / grid.metres_per_px(z)
    return y


def columns_at(lon: np.ndarray, z: int, grid: Grid) -> np.ndarray:
    return (lon / 180 * MERC + MERC) / grid.metres_per_px(z)


def lat_of_rows(y: np.ndarray, z: int, grid: Grid) -> np.ndarray:
    return np.degrees(np.arctan(np.sinh((MERC - y * grid.metres_per_px(z)) / MERC * np.pi)))


def lon_of_columns(x: np.ndarray, z: int, grid: Grid) -> np.ndarray:
    return (x * grid.metres_per_px(z) - MERC) / MERC * 180


def taken(centres: np.ndarray, index_of: Callable[[np.ndarray], np.ndarray], n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(target, source) along an axis: which of a block's n source lines each target line takes, by target.

    centres: places of the lines' centres in target lines, rising, with those of the line before the block and the one behind it; index_of:
    the source line, as a fraction, that a place in target lines is in."""
    on = np.clip(np.floor(centres), -1, size).astype(np.int64)
    low, high = np.maximum(on[:-1] + 1, 0), np.minimum(on[1:], size)
    missed = np.concatenate([np.empty(0, np.int64), *(np.arange(a, b) for a, b in zip(low, high, strict=True) if a < b)])
    line = np.floor(index_of(missed + 0.5)).astype(np.int64)
    target, source = np.r_[on[1:-1], missed], np.r_[np.arange(n), line]
    inside = (target >= 0) & (target < size) & (source >= 0) & (source < n)
    order = np.argsort(target[inside], kind="stable")
    return target[inside][order], source[inside][order]


def taken_columns(lon: float, dlon: float, width: int, z: int, grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    return taken(columns_at(lon + (np.arange(-1, width + 1) + 0.5) * dlon, z, grid), lambda x: (lon_of_columns(x, z, grid) - lon) / dlon, width, grid.size_px(z))


def taken_rows(lat: float, dlat: float, height: int, z: int, grid: Grid) -> tuple[np.ndarray, np.ndarray]:
    return taken(rows_at(lat - (np.arange(-1, height + 1) + 0.5) * dlat, z, grid), lambda y: (lat - lat_of_rows(y, z, grid)) / dlat, height, grid.size_px(z))


def stretches(places: np.ndarray, chunk: int) -> list[tuple[int, slice]]:
    """(chunk number, slice) of neighbouring places in one chunk."""
    number = places // chunk
    cuts = np.flatnonzero(np.diff(number)) + 1
    return [(int(number[a]), slice(a, b)) for a, b in zip(np.r_[0, cuts], np.r_[cuts, len(number)], strict=True) if a < b]


def packed(keys: np.ndarray, n: np.ndarray) -> bytes:
    return zlib.compress(np.concatenate([keys, n]).astype("<u4").tobytes(), 1)


def dominant(parts: list[bytes], chunk: int) -> np.ndarray:
    """The most frequent value of each pixel, the smallest on a tie; 0 where none has fallen."""
    halves = [np.frombuffer(zlib.decompress(p), "<u4").reshape(2, -1) for p in parts]
    keys, where = np.unique(np.concatenate([h[0] for h in halves]), return_inverse=True)
    n = np.bincount(where, np.concatenate([h[1] for h in halves]))
    order = np.lexsort((keys, -n, keys >> 8))
    pixel = keys[order] >> 8
    first = order[np.r_[True, pixel[1:] != pixel[:-1]]]
    out = np.zeros(chunk * chunk, np.uint8)
    out[keys[first] >> 8] = keys[first] & 255
    return out


def warp_blocks(blocks: DataFrame, z: int, grid: Grid, chunk: int = 512) -> DataFrame:
    """cx, cy, data of level z from source blocks (lon, lat, dlon, dlat, width, height, data); chunks of nothing but 0 have no row."""

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for b in frame.itertuples(index=False):
                values = np.frombuffer(b.data, np.uint8).reshape(b.height, b.width).astype(np.uint32)
                (xs, from_x), (ys, from_y) = taken_columns(b.lon, b.dlon, b.width, z, grid), taken_rows(b.lat, b.dlat, b.height, z, grid)
                out = []
                for cy, rows in stretches(ys, chunk):
                    for cx, columns in stretches(xs, chunk):
                        pixel = (ys[rows, None] % chunk * chunk + xs[None, columns] % chunk).astype(np.uint32)
                        out.append((cx, cy, packed(*np.unique(pixel << 8 | values[from_y[rows]][:, from_x[columns]], return_counts=True))))
                yield pd.DataFrame(out, columns=["cx", "cy", "counts"])

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        data = dominant(list(group["counts"]), chunk)
        row = {"cx": group["cx"].iloc[:1], "cy": group["cy"].iloc[:1], "data": [data.tobytes()]}
        return pd.DataFrame(row if data.any() else {k: [] for k in row})

    counted = blocks.select("lon", "lat", "dlon", "dlat", "width", "height", "data").mapInPandas(count, COUNTS)
    return counted.groupBy("cx", "cy").applyInPandas(merge, "cx int, cy int, data binary")
