"""Regions of equal value over a raster of many chunks: labels inside each chunk, joined along the seams by keys.

A chunk never meets more than its own pixels: what leaves its task are its regions and the labels along its four sides. Pixels of 0 are in
no region, as chunks of nothing but 0 aren't stored. A part is a region inside one chunk, numbered by its chunk's row and column (16 bits
each) and its first pixel there in row order (20 bits); a region is named by its least part. The whole raster is one level."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import scratch
from .regions import label, sizes_of

PARTS = "cx int, cy int, parts array<long>, sizes array<long>, west array<long>, east array<long>, north array<long>, south array<long>"


def chunk_parts(chunks: DataFrame, chunk: int = 512) -> DataFrame:
    """A row for each chunk (cx, cy, data): its parts, their sizes, and the parts along its sides, each as number * 256 + value; 0 for pixels of 0."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for p in frame.itertuples(index=False):
                a = np.frombuffer(p.data, np.uint8).reshape(chunk, chunk)
                labels = label(a)
                ids, n = sizes_of(labels)
                some = a.ravel()[ids] > 0
                first = (int(p.cy) << 16 | int(p.cx)) << 20
                coded = lambda at, v: np.where(v > 0, (first + at.astype(np.int64)) << 8 | v, 0)
                sides = [coded(labels[s], a[s].astype(np.int64)) for s in (np.s_[:, 0], np.s_[:, -1], np.s_[0], np.s_[-1])]
                rows.append((p.cx, p.cy, coded(ids, a.ravel()[ids].astype(np.int64))[some], n[some], *sides))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in PARTS.split(", ")])

    return chunks.select("cx", "cy", "data").mapInPandas(run, PARTS)


def seam_links(parts: DataFrame) -> DataFrame:
    """u, v (u > v): parts of one value that touch across a seam. Either side of a seam is one row, so a key has two."""
    found = None
    for here, there, axis in (("east", "west", "cx"), ("south", "north", "cy")):
        other = "cy" if axis == "cx" else "cx"
        before = parts.select((F.col(axis) + 1).alias(axis), other, here)
        pairs = before.join(parts.select("cx", "cy", there), ["cx", "cy"]).select(F.explode(F.array_distinct(F.arrays_zip(here, there))).alias("p"))
        one, two = F.col(f"p.{here}"), F.col(f"p.{there}")
        met = pairs.where((one > 0) & (one % 256 == two % 256)).select(F.shiftright(F.greatest(one, two), 8).alias("u"), F.shiftright(F.least(one, two), 8).alias("v"))
        found = met if found is None else found.unionByName(met)
    return found.distinct()


def stars(links: DataFrame) -> DataFrame:
    """u, v: every linked node but the least of its component, with that least one. links: u > v.

    Large and small stars in turns, until a turn changes nothing; each turn is a minimum by node and a join with it, both of which
    may be split where a node has very many links. A turn is a written table, so lost executors cost no more than a turn."""
    spark, state = links.sparkSession, None
    while True:
        path = scratch(spark, "stars")
        links.write.parquet(path)
        held = spark.read.parquet(path)
        now = tuple(held.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return held
        state = now
        both = held.unionByName(held.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        links = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()


def parts_of_regions(chunks: DataFrame, chunk: int = 512) -> DataFrame:
    """cx, cy, part, value, n, region: each part with its pixels and its region. Chunks: cx, cy, data of one level, each place once."""
    spark = chunks.sparkSession
    path = scratch(spark, "parts")
    chunk_parts(chunks, chunk).write.parquet(path)
    held = spark.read.parquet(path)
    parts = held.select("cx", "cy", F.explode(F.arrays_zip("parts", "sizes")).alias("p")).select("cx", "cy", F.shiftright("p.parts", 8).alias("part"), (F.col("p.parts") % 256).cast("int").alias("value"), F.col("p.sizes").alias("n"))
    roots = stars(seam_links(held)).select(F.col("u").alias("part"), F.col("v").alias("region"))
    return parts.join(roots, "part", "left").select("cx", "cy", "part", "value", "n", F.coalesce("region", "part").alias("region"))


def regions_across(chunks: DataFrame, chunk: int = 512) -> DataFrame:
    """region, value, n (pixels), n_chunks: the regions of the whole raster."""
    return parts_of_regions(chunks, chunk).groupBy("region", "value").agg(F.sum("n").alias("n"), F.count_distinct("cx", "cy").alias("n_chunks"))
