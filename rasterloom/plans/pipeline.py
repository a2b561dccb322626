"""The three jobs end to end: source to pyramid, blocks to tiles, and merging with a base tile set."""

from __future__ import annotations

from contextlib import nullcontext

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import fragments, grid, tiles
from ..operators.progress import Progress
from ..operators.warp import warp_blocks
from ..sources import listing, packs, raster_files, sinks
from ..sources.legend import active_layers
from .settings import LAYERS, Grid


def load_levels(base: DataFrame, out: str, grid_: Grid, chunk: int = 512) -> None:
    """Base pixels (x, y, value at the top level) to a pyramid of sparse chunks. For rasters that come as chunks, see load_chunks."""
    load_chunks(fragments.chunk_pixels(base.select(F.lit(grid_.max_level).alias("level"), "x", "y", "value"), chunk), out, grid_, chunk)


def load_chunks(chunks: DataFrame, out: str, grid_: Grid, chunk: int = 512) -> None:
    """Base chunks (cx, cy, data: chunk * chunk bytes, row by row) to a pyramid, a level at a time from the one before.

    The base is written as it comes, without a shuffle; each coarser level is made chunk by chunk and read back from storage. Beside its
    pixels a chunk has `only`, its value if it has a single one, by which a build settles blocks without reading them."""
    spark = chunks.sparkSession
    stored = ["cx", "cy", "data", fragments.only_value(F.col("data")).alias("only")]
    remove(spark, f"{out}/{CHANGES}")  # they were of the base that this one replaces
    chunks.select(*stored).write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/level={grid_.max_level}")
    for level in range(grid_.max_level - 1, -1, -1):
        above = spark.read.parquet(f"{out}/level={level + 1}")
        fragments.halve_chunks(above, chunk).select(*stored).write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/level={level}")


#: Where changes of a pyramid are kept, beside its levels; readers of the folder as a table pass over it.
CHANGES = "_changes"
#: As many places of chunks, of 16 bytes each, are sent to all tasks at most.
FEW = 1_000_000


def versions_of(spark: SparkSession, levels: str) -> list[int]:
    """The numbers of a pyramid's complete changes: those of which the last level, 0, is written."""
    folder = f"{levels}/{CHANGES}"
    numbers = sorted(int(name.removeprefix("version=")) for name in listed(spark, folder) if name.startswith("version="))
    return [n for n in numbers if "_SUCCESS" in listed(spark, f"{folder}/version={n}/level=0")]


def if_few(places: DataFrame) -> DataFrame:
    """A table of places, to be sent to all tasks if it is counted to be small, and shuffled otherwise."""
    return F.broadcast(places) if places.count() <= FEW else places


def newest_chunks(spark: SparkSession, levels: str, versions: list[int], level: int | None = None) -> DataFrame:
    """level, cx, cy, data, only after these changes: of each place the newest chunk, or none where that is empty. A single level is read alone.

    Versions are compared by place, so pixels take no part in the grouping, and of the stored chunks none is shuffled unless very many changed."""
    inside, columns = ("" if level is None else f"/level={level}"), ["level", "cx", "cy", "data", "only"]
    held = spark.read.option("basePath", levels).parquet(levels + inside).withColumn("level", F.col("level").cast("int")).select(columns)
    if not versions:
        return held
    folder = f"{levels}/{CHANGES}"
    changes = spark.read.option("basePath", folder).parquet(*(f"{folder}/version={n}{inside}" for n in versions)).withColumns({c: F.col(c).cast("int") for c in ("level", "version")})
    place = ["level", "cx", "cy"]
    last = if_few(changes.groupBy(place).agg(F.max("version").alias("version")))
    kept = changes.join(last, [*place, "version"], "left_semi").where("data is not null")
    return held.join(last, place, "left_anti").unionByName(kept.select(columns))


def read_levels(spark: SparkSession, levels: str) -> DataFrame:
    """level, cx, cy, data, only of a pyramid, as its complete changes have left it."""
    return newest_chunks(spark, levels, versions_of(spark, levels))


def update_chunks(changed: DataFrame, levels: str, grid_: Grid, chunk: int = 512) -> int:
    """New base chunks (cx, cy, data; each place once) into a stored pyramid: only the chunks above them are made anew, one a level for each
    family of four with a change. Returns the number of the change.

    A null or all-zero chunk takes away the one that was there. Stored files stay as they are: a change is a version of its own, which
    counts once its level 0 is written, so a stopped update changes nothing and is written over by the next one. One update at a time."""
    spark = changed.sparkSession
    before = versions_of(spark, levels)
    version = max(before, default=0) + 1
    target = f"{levels}/{CHANGES}/version={version}"
    remove(spark, target)  # what a stopped update has left
    only = fragments.only_value(F.col("data"))
    rows = changed.select(F.col("cx").cast("int").alias("cx"), F.col("cy").cast("int").alias("cy"), F.when(only != 0, F.col("data")).alias("data"))
    for level in range(grid_.max_level, -1, -1):
        rows.select("cx", "cy", "data", only.alias("only")).write.option("compression", "zstd").parquet(f"{target}/level={level}")
        if level:
            parents = [F.floor(F.col(c) / 2).cast("int") for c in ("cx", "cy")]
            dirty = spark.read.parquet(f"{target}/level={level}").select(*(p.alias(c) for p, c in zip(parents, ("cx", "cy"), strict=True))).distinct()
            now = newest_chunks(spark, levels, [*before, version], level)
            box = dirty.agg(*(f(c).alias(f"{name}_{c}") for c in ("cx", "cy") for name, f in (("low", F.min), ("high", F.max)))).first()
            if box.low_cx is not None:  # a range reaches the files' statistics
                now = now.where(" and ".join(f"{c} between {2 * box[f'low_{c}']} and {2 * box[f'high_{c}'] + 1}" for c in ("cx", "cy")))
            family = now.join(if_few(dirty.toDF("parent_cx", "parent_cy")), [p == F.col(f"parent_{c}") for p, c in zip(parents, ("cx", "cy"), strict=True)], "left_semi")
            rows = dirty.join(fragments.halve_chunks(family, chunk), ["cx", "cy"], "left")
    return version


def build_root(spark: SparkSession, levels: str, out: str, grid_: Grid) -> str:
    """Where the results of a build go: a folder for all parameters and, of a changed pyramid, for its version."""
    versions = versions_of(spark, levels)
    return f"{out}/{grid_.params_hash()}" + (f"-{versions[-1]}" if versions else "")


def download(spark: SparkSession, keys: DataFrame, store: str, out: str, grid_: Grid, chunk: int = 512) -> DataFrame:
    """The first job: listed raster files (key) under a store to a pyramid in out/levels, and their list in out/list. Returns the occupied cells.

    Files are read by ranges of bytes and warped block by block; the mosaic is the sum of the blocks' counts."""
    sinks.write_list(keys.distinct(), f"{out}/list")
    listed_keys = listing.read_list(spark, f"{out}/list")
    paths = sorted(f"{store.rstrip('/')}/{r.key}" for r in listed_keys.collect())  # a few thousand names
    blocks = raster_files.window(raster_files.read_windows(spark, paths), -180.0, -90.0, 180.0, 90.0)
    load_chunks(warp_blocks(blocks, grid_.max_level, grid_, chunk), f"{out}/levels", grid_, chunk)
    return listing.occupied_cells(listed_keys)


def pixels_of(chunks: DataFrame, chunk: int = 512) -> DataFrame:
    """x, y, value of stored chunks, zeros included."""

    def run(frames):
        for frame in frames:
            for p in frame.itertuples(index=False):
                y, x = np.divmod(np.arange(chunk * chunk), chunk)
                yield pd.DataFrame({"x": x + p.cx * chunk, "y": y + p.cy * chunk, "value": np.frombuffer(p.data, np.uint8)})

    return chunks.select("cx", "cy", "data").mapInPandas(run, "x int, y int, value int")


def plan_blocks(spark: SparkSession, cells: DataFrame, grid_: Grid) -> DataFrame:
    """z, bx, by of blocks that touch an occupied cell, with the layers that their zoom draws."""
    active = active_layers(spark, grid.zooms(spark, grid_))
    blocks = grid.nonempty_blocks(grid.block_grid(spark, grid_), cells, grid_)
    return blocks.join(F.broadcast(active), "z")  # a row per zoom


def runs_of(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the complete runs in a folder: those whose write has ended."""
    return sorted(n for n in (int(name.removeprefix("run=")) for name in listed(spark, folder) if name.startswith("run=")) if "_SUCCESS" in listed(spark, f"{folder}/run={n}"))


def read_records(spark: SparkSession, root: str, runs: list[int], kind: str) -> DataFrame:
    """Records of one kind of complete runs."""
    if not runs:
        return spark.createDataFrame([], fragments.RECORD)
    read = spark.read.schema(fragments.RECORD).option("basePath", f"{root}/records")
    return read.parquet(*(f"{root}/records/run={n}" for n in runs)).where(F.col("record_type") == kind)


def build(spark: SparkSession, levels: str, cells: DataFrame, out: str, grid_: Grid, *, chunk: int = 512, budget: int = 500_000, metadata: dict | None = None, bar: Progress | None = None) -> DataFrame:
    """Fragments, log, tiles and container under out/<params hash>, see build_root; returns the tiles as features.

    A run's records are one write; it is what makes blocks done, and all else follows from complete runs and is made again where it is
    missing: a log for each run, and the tiles of zooms that have newer records than tiles. So a build that is stopped anywhere and
    started again ends with what it would have ended with. Blocks of complete runs are not done again. All zooms are one plan; bar, if
    given, is followed while it runs."""
    root = build_root(spark, levels, out, grid_)
    before = runs_of(spark, f"{root}/records")
    run = max(before, default=-1) + 1
    planned = plan_blocks(spark, cells, grid_)
    done = read_records(spark, root, before, "log").select("z", "bx", "by")
    pending = planned.join(done, ["z", "bx", "by"], "left_anti")
    stored = read_levels(spark, levels)
    settled = fragments.settled_blocks(stored.select("level", "cx", "cy", "only"), pending, grid_, chunk)
    # Only chunks of blocks that aren't settled yet are shuffled.
    pieces = fragments.chunks_for_blocks(stored.select("level", "cx", "cy", "data"), settled.where("only is null"), grid_, chunk)
    counter = spark.sparkContext.accumulator(0)
    with bar.following(lambda: counter.value) if bar else nullcontext():
        sinks.write_records(fragments.process_blocks(pieces, grid_, counter.add).unionByName(fragments.settle(settled.where("only is not null"), grid_, counter.add)), f"{root}/records/run={run}")
    runs = [*before, run]
    for n in runs:
        if n not in runs_of(spark, f"{root}/log"):
            sinks.write_log(log_of_run(spark, root, runs, n, planned, grid_), f"{root}/log/run={n}")
    renew_tiles(spark, root, runs, grid_, budget, metadata or {})
    return read_tiles(spark, root)


def log_of_run(spark: SparkSession, root: str, runs: list[int], run: int, planned: DataFrame, grid_: Grid) -> DataFrame:
    """A row for every block of the grid, row by row: those that the run has processed, those that an earlier one had (cached), and those
    without a source tile (skip-empty)."""
    files = read_records(spark, root, [run], "fragment").unionByName(read_records(spark, root, [run], "log"))
    made = fragments.log_of(files)
    cached = read_records(spark, root, [n for n in runs if n < run], "log").select("z", "bx", "by").distinct()
    empty = grid.block_grid(spark, grid_).join(planned, ["z", "bx", "by"], "left_anti")
    others = cached.withColumn("branch", F.lit("cached")).unionByName(empty.withColumn("branch", F.lit("skip-empty"))).withColumns({"ms": F.lit(0).cast("long"), "ts": F.current_timestamp()})
    return grid.in_order(made.unionByName(others, allowMissingColumns=True))


def newest_by_zoom(spark: SparkSession, folder: str, inside: str = "") -> dict[int, int]:
    """For each zoom, the newest complete run that has a part of it."""
    out: dict[int, int] = {}
    for n in runs_of(spark, folder):
        for name in listed(spark, f"{folder}/run={n}{inside}"):
            if name.startswith("z="):
                out[int(name.removeprefix("z="))] = n
    return out


def renew_tiles(spark: SparkSession, root: str, runs: list[int], grid_: Grid, budget: int, metadata: dict) -> None:
    """Cuts the tiles of zooms whose newest fragments have none yet, and packs the container if it was made from other tiles."""
    wanted, have = newest_by_zoom(spark, f"{root}/records", "/record_type=fragment"), newest_by_zoom(spark, f"{root}/tiles")
    stale = [z for z, n in wanted.items() if have.get(z, -1) < n]
    if stale:
        pieces = read_records(spark, root, runs, "fragment").where(F.col("z").isin(stale))
        sinks.write_tiles(tiles.coalesce_smallest(tiles.cut_tiles(pieces), budget), f"{root}/tiles/run={runs[-1]}")
    made_from = [[z, n] for z, n in sorted(newest_by_zoom(spark, f"{root}/tiles").items())]
    packed = "metadata.json" in listed(spark, f"{root}/container") and sinks.read_container(spark, f"{root}/container")[1]["made_from"]
    if packed != made_from:
        encoded = tiles.encode_tiles(read_tiles(spark, root), compress=True)
        sinks.write_container(encoded, f"{root}/container", {**described(metadata, grid_), "made_from": made_from})


def described(metadata: dict, grid_: Grid) -> dict:
    """What a container says of itself: the given name, attribution and description, its zooms, and its layers with their attribute."""
    return {"minzoom": 0, "maxzoom": grid_.max_level, "format": "pbf", "compression": "gzip", "vector_layers": [{"id": layer, "fields": {"kind": "String"}} for layer in LAYERS], **metadata}


def read_tiles(spark: SparkSession, root: str) -> DataFrame:
    """The tiles of a build: of each zoom the newest."""
    newest = newest_by_zoom(spark, f"{root}/tiles")
    if not newest:
        return spark.createDataFrame([], tiles.TILE)
    read = spark.read.schema(tiles.TILE).option("basePath", f"{root}/tiles")
    return read.parquet(*(f"{root}/tiles/run={n}/z={z}" for z, n in sorted(newest.items()))).select("z", "tx", "ty", "layer", "kind", "geom")


def read_fragments(spark: SparkSession, root: str) -> DataFrame:
    """The fragments of a build, of all its complete runs."""
    return fragments.fragments_of(read_records(spark, root, runs_of(spark, f"{root}/records"), "fragment"))


def listed(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder of any file system that the engine can read; none if there is no such folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in system.listStatus(target)] if system.exists(target) else []


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder of any file system that the engine can write, if it is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(folder)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def pack_container(spark: SparkSession, container: str, out: str, files: int) -> None:
    """A container as files of tiles with an index, for readers that ask for single tiles."""
    encoded, about = sinks.read_container(spark, container)
    packs.write_pack(encoded, out, about, files)


def merge_containers(spark: SparkSession, ours: str, base: str, out: str, metadata: dict | None = None) -> None:
    """Two containers as one, layer by layer: a tile of both has each layer once, with the features of both. The result is compressed as ours."""
    (one, about), (two, about_base) = sinks.read_container(spark, ours), sinks.read_container(spark, base)
    layers: dict[str, dict] = {}
    for v in [*about_base.get("vector_layers", []), *about.get("vector_layers", [])]:
        held = layers.get(v["id"], {})
        layers[v["id"]] = {**v, **held, "fields": {**v.get("fields", {}), **held.get("fields", {})}}
    about.pop("made_from", None)
    about_base.pop("made_from", None)
    zooms = {"minzoom": min(about["minzoom"], about_base["minzoom"]), "maxzoom": max(about["maxzoom"], about_base["maxzoom"])}
    kinds = (about_base.get("compression", "none"), about.get("compression", "none"))
    made = tiles.merge_tiles(two, one, kinds, kinds[1])
    sinks.write_container(made, out, {**about_base, **about, **zooms, "vector_layers": list(layers.values()), **(metadata or {})})


def merge(ours: DataFrame, base: DataFrame, out: str) -> None:
    """Both tile sets with all their features."""
    sinks.write_tiles(tiles.merge_features(ours, base), out)
