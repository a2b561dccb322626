"""Sinks: lists, logs, fragments, tiles, style sheets, and upkeep of the output folder."""

from __future__ import annotations

import json
import os
import shutil
import tempfile
import xml.etree.ElementTree as ET
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import block_id, colour, iso_millis
from .legend import legend, styled

LOG_COLUMNS = ("timestamp", "id", "branch", "ms", "land_bytes", "water_bytes", "present", "channels", "kind")


def atomic(path: str, produce: Callable[[str], None]) -> None:
    """produce(temporary path beside it), then a rename; the temporary file goes if anything fails. For driver-local files only:
    DataFrame writes have the commit protocol of their file system."""
    fd, temporary = tempfile.mkstemp(prefix=".tmp-", dir=os.path.dirname(path) or ".")
    os.close(fd)
    try:
        produce(temporary)
        os.replace(temporary, path)
    except BaseException:
        if os.path.exists(temporary):
            os.unlink(temporary)
        raise


def write_list(names: DataFrame, path: str) -> None:
    """A name per line."""
    names.select("key").write.mode("overwrite").text(path)


def write_records(records: DataFrame, path: str) -> None:
    """What blocks have made, by kind of record and zoom. The folder counts once it is complete; an incomplete one is written anew."""
    records.write.mode("overwrite").partitionBy("record_type", "z").parquet(path)


def write_tiles(tiles: DataFrame, path: str) -> None:
    """Tiles by zoom, rows of a tile together."""
    tiles.repartition("z", "tx", "ty").write.mode("overwrite").option("compression", "zstd").partitionBy("z").parquet(path)


def write_container(encoded: DataFrame, path: str, metadata: dict) -> None:
    """Encoded tiles (z, tx, ty, data) by zoom, in the order of their places, and beside them `metadata.json`: what a container of tiles says
    of itself. The tiles are compressed already."""
    encoded.repartitionByRange("z", "tx", "ty").sortWithinPartitions("z", "tx", "ty").write.mode("overwrite").option("compression", "none").partitionBy("z").parquet(f"{path}/tiles")
    spark = encoded.sparkSession
    spark.range(1).select(F.lit(json.dumps(metadata, sort_keys=True)).alias("value")).coalesce(1).write.mode("overwrite").text(f"{path}/metadata.json")


def read_container(spark, path: str) -> tuple[DataFrame, dict]:
    tiles = spark.read.schema("tx int, ty int, data binary, z int").parquet(f"{path}/tiles").select("z", "tx", "ty", "data")
    return tiles, json.loads(spark.read.text(f"{path}/metadata.json").first().value)


def log_rows(log: DataFrame) -> DataFrame:
    """The nine log columns as text, nulls empty. log: z, bx, by, branch, ms, land_bytes, water_bytes, present, channels, kind and ts."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    return log.select(iso_millis(F.col("ts")).alias("timestamp"), block_id(F.col("z"), F.col("bx"), F.col("by")).alias("id"), "branch", *(text(c) for c in LOG_COLUMNS[3:]))


def write_log(log: DataFrame, path: str) -> None:
    """Tab-separated rows under a header, one file per task; a log that is there already is replaced."""
    log_rows(log).select(*LOG_COLUMNS).write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").csv(path)


def style_rules(channels: DataFrame) -> DataFrame:
    """idx, layer, kind, fill and the filter of each drawn kind of a legend."""
    return styled(channels).select("idx", "layer", "kind", colour(F.col("colour")).alias("fill"), F.concat(F.lit("\"kind\" = '"), F.col("kind"), F.lit("'")).alias("rule"))


#: fixed values: what the desktop viewer writes for a plain fill without an outline.
FILL_OPTIONS = (
    ("border_width_map_unit_scale", "3x:0,0,0,0,0,0"),
    ("color", None),
    ("joinstyle", "bevel"),
    ("offset", "0,0"),
    ("offset_map_unit_scale", "3x:0,0,0,0,0,0"),
    ("offset_unit", "MM"),
    ("outline_color", "0,0,0,0,rgb:0,0,0,0"),
    ("outline_style", "no"),
    ("outline_width", "0"),
    ("outline_width_unit", "MM"),
    ("style", "solid"),
)
#: fixed values: layer flags of the viewer.
LAYER_FLAGS = (("Identifiable", "1"), ("Removable", "1"), ("Searchable", "1"), ("Private", "0"))
DOCTYPE = "<!DOCTYPE qgis PUBLIC 'http://mrcc.com/qgis.dtd' 'SYSTEM'>"


def option_map(parent: ET.Element, options) -> ET.Element:
    """A map of string options; one without a value is an empty option."""
    held = ET.SubElement(parent, "Option", type="Map")
    for name, value in options:
        ET.SubElement(held, "Option", {"name": name} if value is None else {"type": "QString", "name": name, "value": value})
    return held


def style_sheet(spark) -> str:
    """A style document of the desktop viewer: one fill rule per kind, no outlines."""
    root = ET.Element("qgis", version="3.40.3-Bratislava", styleCategories="AllStyleCategories", minScale="1e+08", maxScale="0", hasScaleBasedVisibilityFlag="0", autoRefreshTime="0", autoRefreshMode="Disabled")
    flags = ET.SubElement(root, "flags")
    for name, value in LAYER_FLAGS:
        ET.SubElement(flags, name).text = value
    ET.SubElement(ET.SubElement(root, "customproperties"), "Option")
    styles = ET.SubElement(ET.SubElement(root, "renderer", type="basic"), "styles")
    none = (("name", ""), ("properties", None), ("type", "collection"))
    for r in style_rules(legend(spark)).orderBy("idx").collect():  # the legend: a dozen rows
        one = ET.SubElement(styles, "style", {"geometry": "2", "min-zoom": "-1", "max-zoom": "-1", "layer": r.layer, "enabled": "1", "name": r.kind, "expression": r.rule})
        symbol = ET.SubElement(ET.SubElement(one, "symbols"), "symbol", type="fill", name="0", alpha="1", is_animated="0", frame_rate="10", clip_to_extent="1", force_rhr="0")
        option_map(ET.SubElement(symbol, "data_defined_properties"), none)
        fill = ET.SubElement(symbol, "layer", {"class": "SimpleFill", "enabled": "1", "locked": "0", "pass": "0"})
        option_map(fill, ((name, r.fill if name == "color" else value) for name, value in FILL_OPTIONS))
        option_map(ET.SubElement(fill, "data_defined_properties"), none)
    ET.SubElement(ET.SubElement(root, "labeling", type="basic", labelsEnabled="1"), "styles")
    ET.SubElement(root, "blendMode").text = "0"
    ET.SubElement(root, "layerOpacity").text = "1"
    ET.indent(root)
    return f"{DOCTYPE}\n{ET.tostring(root, encoding='unicode')}\n"


def write_style(spark, path: str) -> None:
    def produce(temporary: str) -> None:
        with open(temporary, "w", encoding="utf-8") as f:
            f.write(style_sheet(spark))

    atomic(path, produce)


def clean(folder: str, remove: list[str]) -> list[str]:
    """Removes the named entries of a folder, and no others; returns those that were there."""
    gone = []
    for name in remove:
        path = os.path.join(folder, name)
        if os.path.basename(name) != name or name in ("", ".", ".."):
            raise ValueError(f"not an entry of the folder: {name}")
        if os.path.isdir(path) and not os.path.islink(path):
            shutil.rmtree(path)
        elif os.path.lexists(path):
            os.unlink(path)
        else:
            continue
        gone.append(name)
    return gone
