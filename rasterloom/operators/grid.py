"""Block grids and the join against occupied cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.geo import block_window, blocks_per_axis, snap
from ..plans.settings import CELL_DEGREES, Grid


def zooms(spark: SparkSession, grid: Grid) -> DataFrame:
    return spark.range(grid.max_level + 1).select(F.col("id").cast("int").alias("z"))


def block_grid(spark: SparkSession, grid: Grid) -> DataFrame:
    """z, bx, by of every block of every zoom."""
    return blocks_of(zooms(spark, grid), grid)


def blocks_of(zooms_: DataFrame, grid: Grid) -> DataFrame:
    """A row for every block of the zoom z of each row, beside the row's other columns: generated in parallel from (z, row)."""
    line = F.sequence(F.lit(0), blocks_per_axis(F.col("z"), grid) - 1)
    return zooms_.withColumn("by", F.explode(line)).select(*zooms_.columns, F.explode(line).alias("bx"), "by")


def block_windows(blocks: DataFrame, grid: Grid) -> DataFrame:
    return blocks.select("*", *(c.alias(n) for n, c in block_window(F.col("z"), F.col("bx"), F.col("by"), grid).items()))


def covered_cells(boxes: DataFrame) -> DataFrame:
    """A row per cell that a half-open box (south, north, west, east) touches. A box that is empty touches none."""
    lats = F.sequence(snap(F.col("south")), snap(F.col("north")), F.lit(CELL_DEGREES))
    lons = F.sequence(snap(F.col("west")), snap(F.col("east")), F.lit(CELL_DEGREES))
    out = boxes.where("south < north and west < east").withColumn("lat", F.explode(lats)).withColumn("lon", F.explode(lons))
    return out.where("lat < north and lon < east")


def touching(boxes: DataFrame, cells: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of the boxes that touch an occupied cell: a hash join on exploded cells instead of a range join."""
    return covered_cells(boxes).join(cells, ["lat", "lon"], "left_semi").select(*keys).distinct()


def nonempty_blocks(blocks: DataFrame, cells: DataFrame, grid: Grid) -> DataFrame:
    return touching(block_windows(blocks, grid), cells, ["z", "bx", "by"])


def row_major(blocks: DataFrame) -> DataFrame:
    """Adds `nth`: the place of a block among those of its zoom, row by row from the north-west, from 0."""
    return blocks.withColumn("nth", F.row_number().over(Window.partitionBy("z").orderBy("by", "bx")).cast("int") - 1)


def in_order(blocks: DataFrame) -> DataFrame:
    """Blocks by zoom, then row by row."""
    return blocks.orderBy("z", "by", "bx")


def skipped_blocks(blocks: DataFrame, cells: DataFrame, grid: Grid) -> DataFrame:
    return blocks.join(nonempty_blocks(blocks, cells, grid), ["z", "bx", "by"], "left_anti")


def pending(planned: DataFrame, manifest: DataFrame) -> DataFrame:
    """Planned (z, bx, by, has_land, has_water) without what is finished: each layer that a block has must be in the manifest.

    manifest: z, bx, by, layer of written fragments."""
    done = manifest.groupBy("z", "bx", "by").agg(F.bool_or(F.col("layer") == "land").alias("land"), F.bool_or(F.col("layer") == "water_polygons").alias("water"))
    complete = (~F.col("has_land") | F.coalesce("land", F.lit(False))) & (~F.col("has_water") | F.coalesce("water", F.lit(False)))
    return planned.join(done, ["z", "bx", "by"], "left").where(~complete).select(planned["*"])
