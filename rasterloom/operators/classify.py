"""From source codes to one smooth class per pixel: fold, mask, blur, argmax. Twice: relational, and numpy for whole windows.

Both forms use the same integer weights, so they agree exactly. Pixels outside the relation (or window) count as zero for every
channel alike. Ties go to the lowest channel; a pixel that no channel reaches is no-data (channel 0)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.settings import LEGEND, Grid
from ..sources.legend import channel_of


def fold(pixels: DataFrame, z: Column | int) -> DataFrame:
    """Adds `channel`: codes that aren't drawn at z are no-data."""
    return pixels.withColumn("channel", channel_of(F.col("value"), z))


def mask(channels: DataFrame, *keys: str) -> DataFrame:
    """The masks in long form: a row of 255 for the pixel's own channel; all other channels are zero and have no row."""
    return channels.select(*keys, "x", "y", "channel", F.lit(255).alias("mask"))


def blur_axis(scores: DataFrame, axis: str, low: Column, high: Column, grid: Grid, keys: list[str]) -> DataFrame:
    """One pass of the separable blur: every score spreads along the axis; sums stay inside [low, high)."""
    weights = grid.kernel()
    taps = F.array(*(F.struct(F.lit(k).alias("o"), F.lit(weights[abs(k)]).alias("w")) for k in range(1 - len(weights), len(weights)) if weights[abs(k)]))
    spread = scores.withColumn("tap", F.explode(taps)).withColumn(axis, (F.col(axis) + F.col("tap.o")).cast("int"))
    inside = spread.where((F.col(axis) >= low) & (F.col(axis) < high))
    return inside.groupBy(*keys, "x", "y", "channel").agg(F.sum(F.col("score") * F.col("tap.w")).alias("score"))


def blur(channels: DataFrame, bounds: tuple[Column, Column, Column, Column], grid: Grid, keys: list[str]) -> DataFrame:
    """Scores by channel. bounds: x0, x1, y0, y1 of the window, from the row's keys or literals."""
    x0, x1, y0, y1 = bounds
    scores = channels.select(*keys, "x", "y", "channel", F.lit(1).cast("long").alias("score"))
    return blur_axis(blur_axis(scores, "x", x0, x1, grid, keys), "y", y0, y1, grid, keys)


def argmax(scores: DataFrame, *keys: str) -> DataFrame:
    """The channel with the highest score of each pixel, the lowest on a tie."""
    best = F.max_by("channel", F.struct("score", -F.col("channel")))
    return scores.groupBy(*keys, "x", "y").agg(best.alias("channel"))


def classify(pixels: DataFrame, z: int, width: int, height: int, grid: Grid) -> DataFrame:
    """x, y, channel of one dense window."""
    bounds = (F.lit(0), F.lit(width), F.lit(0), F.lit(height))
    return argmax(blur(fold(pixels, z), bounds, grid, []))


def branch(present: DataFrame, z: Column | int) -> DataFrame:
    """Adds active (drawn channels that are present, ascending) and branch: empty, uniform or full. present: sorted values, 0 included."""
    drawn = F.array_sort(F.array_distinct(F.filter(F.transform("present", lambda v: channel_of(v, z)), lambda c: c > 0)))
    out = present.withColumn("active", drawn)
    return out.withColumn("branch", F.when(F.size("active") == 0, "empty").when(F.size("present") == 1, "uniform").otherwise("full"))


def ordinals(present: DataFrame, *keys: str) -> DataFrame:
    """Block-local codes of present channels: 1 is no-data, 2, 3 ... the active ones in legend order."""
    return present.select(*keys, F.posexplode("active").alias("pos", "channel")).select(*keys, (F.col("pos") + 2).alias("code"), "channel")


# numpy, for windows that are too large for rows


CHANNEL_OF = {c: (idx, max_zoom) for idx, codes, layer, _, max_zoom, _ in LEGEND for c in codes if layer is not None}


def fold_array(values: np.ndarray, z: int) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    for code, (idx, max_zoom) in CHANNEL_OF.items():
        table[code] = idx if max_zoom >= z else 0
    return table[values]


def blur_array(mask: np.ndarray, weights: list[int], axis: int) -> np.ndarray:
    out = mask * weights[0]
    n = mask.shape[axis]
    for k in range(1, min(len(weights), n)):
        near, far = [slice(None)] * 2, [slice(None)] * 2
        near[axis], far[axis] = slice(None, n - k), slice(k, None)
        out[tuple(far)] += weights[k] * mask[tuple(near)]
        out[tuple(near)] += weights[k] * mask[tuple(far)]
    return out


#: Rows that are scored at once.
STRIP = 128


def classify_array(values: np.ndarray, z: int, grid: Grid, *, prune: bool = True) -> np.ndarray:
    """The winning channel of each pixel. Only present channels are blurred: an absent one is zero everywhere and can't win.

    Strip by strip of rows, each with the rows that the blur reaches, so that scores are never held for a whole window."""
    folded, weights = fold_array(values, z), grid.kernel()
    kind = np.int32 if (2 * sum(weights)) ** 2 < 2**31 else np.int64
    reach, winner = len(weights) - 1, np.zeros(values.shape, np.uint8)
    for y in range(0, len(values), STRIP):
        first, end = max(0, y - reach), min(len(values), y + STRIP + reach)
        inner = slice(y - first, min(STRIP, len(values) - y) + y - first)
        best = np.zeros((inner.stop - inner.start, values.shape[1]), kind)
        out = winner[y : y + STRIP]
        for channel in np.flatnonzero(np.bincount(folded[first:end].ravel())).tolist() if prune else range(len(LEGEND)):
            score = blur_array(blur_array((folded[first:end] == channel).astype(kind), weights, 1), weights, 0)[inner]
            better = score > best
            best[better], out[better] = score[better], channel
    return winner
