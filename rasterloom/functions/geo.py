"""Projection, grid and cell arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..plans.settings import CELL_DEGREES, MERC, WORLD, Grid


def lat_of(y: Column) -> Column:
    """Degrees north of a projected northing."""
    return F.degrees(F.atan(F.sinh(y / MERC * F.pi())))


def lon_of(x: Column) -> Column:
    return x / MERC * 180


def y_of(lat: Column) -> Column:
    """Northing of degrees north; null at the poles and beyond. asinh(tan) would lose digits towards the south."""
    return F.when(F.abs(lat) < 90, F.log(F.tan(F.pi() / 4 + F.radians(lat) / 2)) / F.pi() * MERC)


def x_of(lon: Column) -> Column:
    return lon / 180 * MERC


def corner_lonlat(x: Column, y: Column, z: Column, grid: Grid) -> tuple[Column, Column]:
    """Degrees of a pixel corner of level z."""
    px = metres_per_px(z, grid)
    return lon_of(x * px - MERC), lat_of(F.lit(MERC) - y * px)


def pixel_at(lon: Column, lat: Column, z: int, grid: Grid) -> tuple[Column, Column]:
    """The pixel of level z that holds a point in degrees; points beyond the square's latitudes are in no pixel (null)."""
    px, last = grid.metres_per_px(z), grid.size_px(z) - 1
    x, y = F.floor((x_of(lon) + MERC) / px), F.floor((F.lit(MERC) - y_of(lat)) / px)
    inside = x.between(0, last) & y.between(0, last)
    return F.when(inside, x).cast("int"), F.when(inside, y).cast("int")


def blocks_per_axis(z: Column, grid: Grid) -> Column:
    return F.ceil(F.pow(F.lit(2.0), z) / grid.block_tiles).cast("int")


def metres_per_px(z: Column, grid: Grid) -> Column:
    return F.lit(WORLD) / F.pow(F.lit(2.0), z) / grid.tile_px


def tolerance(z: Column) -> Column:
    return F.lit(WORLD) / (F.lit(256.0) * F.pow(F.lit(2.0), z))


def snap(degrees: Column) -> Column:
    """The cell that holds a coordinate; floors toward minus infinity."""
    return (F.floor(degrees / CELL_DEGREES) * CELL_DEGREES).cast("int")


def block_window(z: Column, bx: Column, by: Column, grid: Grid) -> dict[str, Column]:
    """Inner rectangle, window with halo, window size in pixels and inner box in degrees of a block."""
    tiles = F.pow(F.lit(2.0), z)
    span = F.lit(WORLD) / tiles
    px = span / grid.tile_px
    x0, y0 = bx * grid.block_tiles, by * grid.block_tiles
    x1, y1 = F.least(x0 + grid.block_tiles, tiles), F.least(y0 + grid.block_tiles, tiles)
    minx, maxx = x0 * span - MERC, x1 * span - MERC
    miny, maxy = F.lit(MERC) - y1 * span, F.lit(MERC) - y0 * span
    m = px * grid.margin_px
    wminx, wminy = F.greatest(F.lit(-MERC), minx - m), F.greatest(F.lit(-MERC), miny - m)
    wmaxx, wmaxy = F.least(F.lit(MERC), maxx + m), F.least(F.lit(MERC), maxy + m)
    return {
        "minx": minx,
        "miny": miny,
        "maxx": maxx,
        "maxy": maxy,
        "win_minx": wminx,
        "win_miny": wminy,
        "win_maxx": wmaxx,
        "win_maxy": wmaxy,
        "px_width": F.round((wmaxx - wminx) / px).cast("int"),
        "px_height": F.round((wmaxy - wminy) / px).cast("int"),
        "west": lon_of(minx),
        "south": lat_of(miny),
        "east": lon_of(maxx),
        "north": lat_of(maxy),
    }


def window_struct(z: Column, bx: Column, by: Column, grid: Grid) -> Column:
    """The same as one nested column: inner, window, size and lonlat."""
    w = block_window(z, bx, by, grid)
    pick = lambda names, prefix="": F.struct(*(w[prefix + n].alias(n) for n in names))
    return F.struct(pick(("minx", "miny", "maxx", "maxy")).alias("inner"), pick(("minx", "miny", "maxx", "maxy"), "win_").alias("window"), pick(("width", "height"), "px_").alias("size"), pick(("west", "south", "east", "north")).alias("lonlat"))


def ring_of(west: Column, south: Column, east: Column, north: Column) -> Column:
    """The closed five-point ring of a rectangle: SW, SE, NE, NW, SW."""
    point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    return F.array(point(west, south), point(east, south), point(east, north), point(west, north), point(west, south))
