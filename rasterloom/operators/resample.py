"""Rasters as rows (level, x, y, value): mode resampling, pyramids, windows and halos."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import pixel_at, x_of, y_of
from ..plans.settings import MERC, Grid


def mode_of(value: str) -> Column:
    """The most frequent value, the smallest on a tie; counted map-side."""
    return F.mode(value, deterministic=True)


def resample(pixels: DataFrame, x: Column, y: Column) -> DataFrame:
    """x, y, value: the dominant source value of each target pixel."""
    return pixels.groupBy(x.cast("int").alias("x"), y.cast("int").alias("y")).agg(mode_of("value").alias("value"))


def dominant(counted: DataFrame) -> DataFrame:
    """x, y, value: the same of places and values (x, y, value) that are counted already (n)."""
    totals = counted.groupBy("x", "y", "value").agg(F.sum("n").alias("n"))
    return totals.groupBy("x", "y").agg(F.max_by("value", F.when(F.col("value").isNotNull(), F.struct("n", -F.col("value")))).alias("value"))


def placed(centre: Column, step: float, place: Callable[[Column], Column]) -> Column:
    """A source cell along an axis, in target lines: the line its centre is on, those of its neighbours' centres, and its edges."""
    one, two = place(centre - step / 2), place(centre + step / 2)
    on = [F.floor(place(c)).alias(name) for c, name in ((centre, "here"), (centre - step, "before"), (centre + step, "behind"))]
    return F.struct(*on, F.least(one, two).alias("low"), F.greatest(one, two).alias("high"))


def takers(cell: str, size: int) -> Column:
    """The target lines that take a placed cell: the one its centre is on, and those that no centre is on but whose middle is in the cell."""
    c = F.col(cell)
    low, high = F.greatest(F.floor(c["low"]), F.lit(0)), F.least(F.floor(c["high"]), F.lit(size - 1))
    takes = lambda t: (t == c["here"]) | ((t + 0.5 >= c["low"]) & (t + 0.5 < c["high"]) & (t != c["before"]) & (t != c["behind"]))
    return F.when(low <= high, F.filter(F.sequence(low, high), takes))


def warp(samples: DataFrame, z: int, grid: Grid, dlon: float | None = None, dlat: float | None = None) -> DataFrame:
    """x, y, value of level z from source cells in degrees (lon, lat of their centres on a lattice of dlon x dlat, value): the dominant value
    of the cells whose centres a target pixel covers or, where it covers none, of the cell that its middle is in. Without dlon and dlat
    the samples are points, and a pixel that covers none has no row.

    Samples of one cell and value are counted map-side before they are placed, so only distinct ones are spread over the pixels that take
    them; the sources needn't be joined into one raster first, and those that overlap count together."""
    samples = samples.groupBy("lon", "lat", "value").agg(F.count("*").alias("n"))
    if dlon is None or dlat is None:
        x, y = pixel_at(F.col("lon"), F.col("lat"), z, grid)
        return dominant(samples.select(x.alias("x"), y.alias("y"), "value", "n").where("x is not null and y is not null"))
    size, metres, pole = grid.size_px(z), grid.metres_per_px(z), F.lit(89.9999)
    x = placed(F.col("lon"), dlon, lambda c: (x_of(c) + MERC) / metres)
    y = placed(F.col("lat"), dlat, lambda c: (F.lit(MERC) - y_of(F.greatest(F.least(c, pole), -pole))) / metres)
    cells = samples.select(x.alias("px"), y.alias("py"), "value", "n")
    spread = cells.select(F.explode(takers("px", size)).alias("x"), "py", "value", "n").select("x", F.explode(takers("py", size)).alias("y"), "value", "n")
    return dominant(spread.select(F.col("x").cast("int").alias("x"), F.col("y").cast("int").alias("y"), "value", "n"))


def halve(pixels: DataFrame, factor: int = 2) -> DataFrame:
    return resample(pixels, F.floor(F.col("x") / factor), F.floor(F.col("y") / factor))


def pyramid(base: DataFrame, levels: int) -> DataFrame:
    """level, x, y, value from `levels` (the base) down to 0, each level the mode of the one above it (mode of modes)."""
    out, current = [base.select(F.lit(levels).alias("level"), "x", "y", "value")], base
    for level in range(levels - 1, -1, -1):
        current = halve(current)
        out.append(current.select(F.lit(level).alias("level"), "x", "y", "value"))
    return reduce(DataFrame.unionByName, out)


def pyramid_direct(base: DataFrame, levels: int) -> DataFrame:
    """The same levels, each the mode of base pixels."""
    out = [base.select(F.lit(levels).alias("level"), "x", "y", "value")]
    out += [halve(base, 1 << (levels - level)).select(F.lit(level).alias("level"), "x", "y", "value") for level in range(levels - 1, -1, -1)]
    return reduce(DataFrame.unionByName, out)


def at_level(levels: DataFrame, z: int) -> DataFrame:
    """A zoom reads the level of its own resolution: partition pruning on `level` does the rest."""
    return levels.where(F.col("level") == z).select("x", "y", "value")


def dense(pixels: DataFrame, width: int, height: int, x0: int = 0, y0: int = 0) -> DataFrame:
    """Every pixel of a rectangle; uncovered ones are 0."""
    spark = pixels.sparkSession
    ys = spark.range(y0, y0 + height).select(F.col("id").cast("int").alias("y"))
    full = ys.select(F.explode(F.sequence(F.lit(x0), F.lit(x0 + width - 1))).alias("x"), "y")
    return full.join(pixels, ["x", "y"], "left").select("x", "y", F.coalesce("value", F.lit(0)).alias("value"))


def window(pixels: DataFrame, x0: int, y0: int, x1: int, y1: int) -> DataFrame:
    """The half-open window [x0, x1) x [y0, y1), dense. The range filter reaches the scan."""
    inside = pixels.where(f"x >= {x0} and x < {x1} and y >= {y0} and y < {y1}")
    return dense(inside, x1 - x0, y1 - y0, x0, y0)


def crop(pixels: DataFrame, x0: int, y0: int, x1: int, y1: int) -> DataFrame:
    return pixels.where(f"x >= {x0} and x < {x1} and y >= {y0} and y < {y1}")


def with_halo(pixels: DataFrame, z: int, grid: Grid) -> DataFrame:
    """bx, by and the pixel, once for each block whose window holds it (up to four): exploded block ids, no join."""
    m, size, last = grid.margin_px, grid.block_px, grid.blocks(z) - 1
    span = lambda c: F.sequence(F.greatest(F.lit(0), F.floor((F.col(c) - m) / size)), F.least(F.lit(last), F.floor((F.col(c) + m) / size)))
    out = pixels.withColumn("bx", F.explode(span("x").cast("array<int>"))).withColumn("by", F.explode(span("y").cast("array<int>")))
    return out.select(F.lit(z).alias("z"), "bx", "by", "x", "y", "value")


def mosaic(parts: list[DataFrame]) -> DataFrame:
    """Several rasters as one; where they overlap, the later one wins."""
    if len(parts) == 1:
        return parts[0].select("x", "y", "value")
    numbered = [p.select("x", "y", F.struct(F.lit(i).alias("part"), "value").alias("v")) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, numbered).groupBy("x", "y").agg(F.max("v").alias("v")).select("x", "y", "v.value")


def histogram(pixels: DataFrame, *by: str) -> DataFrame:
    return pixels.groupBy(*by, "value").agg(F.count("*").alias("n"))


def present(pixels: DataFrame, *by: str) -> DataFrame:
    """The sorted distinct values of each group."""
    return pixels.groupBy(*by).agg(F.array_sort(F.collect_set("value")).alias("present"))
