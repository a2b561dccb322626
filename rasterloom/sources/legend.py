"""The channel legend as a small table, and what follows from it at a zoom."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.settings import LEGEND

SCHEMA = "idx int, codes array<int>, layer string, kind string, max_zoom int, colour string"


def legend(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, list(c), layer, kind, z, colour) for i, c, layer, kind, z, colour in LEGEND], SCHEMA)


def is_active(z: Column | int) -> Column:
    """Whether a channel is drawn at zoom z."""
    return F.col("layer").isNotNull() & (F.col("max_zoom") >= z)


def active_channels(spark: SparkSession, zooms: DataFrame) -> DataFrame:
    """idx, layer, kind of the channels drawn at the zoom z of each row, beside the row's columns."""
    return zooms.join(F.broadcast(legend(spark)), F.col("layer").isNotNull() & (F.col("max_zoom") >= F.col("z"))).select(*zooms.columns, "idx", "layer", "kind")


def active_layers(spark: SparkSession, zooms: DataFrame) -> DataFrame:
    """has_land, has_water: whether a channel of the layer is drawn at the zoom z of each row (z and other columns that tell rows apart)."""
    return active_channels(spark, zooms).groupBy(*zooms.columns).agg(F.bool_or(F.col("layer") == "land").alias("has_land"), F.bool_or(F.col("layer") == "water_polygons").alias("has_water"))


def nodata_codes(spark: SparkSession, zooms: DataFrame) -> DataFrame:
    """For the zoom z of each row, beside its columns, the source codes that fold into no-data there: the complement of the active ones."""
    return zooms.join(F.broadcast(legend(spark)), F.col("layer").isNull() | (F.col("max_zoom") < F.col("z"))).select(*zooms.columns, F.explode("codes").alias("code"))


def channel_of(code: Column, z: Column | int) -> Column:
    """The channel of a source code at zoom z; 0 (no-data) for inactive and unknown codes. A literal expression of a fixed legend."""
    out = F.lit(0)
    for idx, codes, layer, _, max_zoom, _ in LEGEND:
        if layer is not None:
            out = F.when(code.isin(*codes) & (F.lit(max_zoom) >= z), idx).otherwise(out)
    return out


def styled(channels: DataFrame) -> DataFrame:
    """Channels (of a legend) that a style sheet draws."""
    return channels.where("layer is not null and kind is not null and colour is not null")
