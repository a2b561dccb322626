"""Throughput of a stream: counts per window and key, with a watermark for late rows; and rates over the last rows of each running job."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.progress import SAMPLES


def windowed_rate(events: DataFrame, *, ts: str = "ts", key: str = "event_type", width: str = "5 minutes", slide: str = "1 minute", late: str = "10 minutes") -> DataFrame:
    """start, key, n and rate per second of each window. Works on streams and tables alike; state is one row per open window and key."""
    seconds = F.unix_timestamp(F.col("window.end")) - F.unix_timestamp(F.col("window.start"))
    counted = events.withWatermark(ts, late).groupBy(F.window(ts, width, slide), F.col(key)).agg(F.count("*").alias("n"))
    return counted.select(F.col("window.start").alias("start"), key, "n", (F.col("n") / seconds).alias("rate"))


RATED = "job long, seq long, t_ms long, n long, done long, rate double"
RING = "start long, done long, times array<long>, counts array<long>"


def job_rates(log: DataFrame, samples: int = SAMPLES, start_ms: int | None = None) -> DataFrame:
    """RATED of a streamed log of several jobs (job, seq, t_ms, n): for each row what `progress.sliding_rate` says of its job's log.

    A job's state is its start, its total and a ring of at most `samples` samples, the start among them until so many rows have come; so
    it doesn't grow with the log, and a restart goes on from the checkpoint. Rows of a batch are ordered by seq; a row that comes in a
    later batch than its successors counts when it comes. A batch's rows of one job meet in one task: limit the batch at the source."""

    def run(key: tuple, frames: Iterator[pd.DataFrame], state: Any) -> Iterator[pd.DataFrame]:
        rows = pd.concat(list(frames)).sort_values("seq", kind="stable")
        t = rows["t_ms"].to_numpy(np.int64)
        if state.exists:
            start, before, times, counts = state.get
        else:
            start = int(t[0]) if start_ms is None else start_ms
            before, times, counts = 0, [start], [0]
        done = before + np.cumsum(rows["n"].to_numpy(np.int64))
        all_t, all_done = np.concatenate([times, t]).astype(np.int64), np.concatenate([counts, done]).astype(np.int64)
        oldest = np.maximum(np.arange(len(times), len(all_t)) - (samples - 1), 0)
        span, elapsed = (t - all_t[oldest]) / 1000, (t - start) / 1000
        rate = np.zeros(len(t))
        np.divide(done, elapsed, out=rate, where=elapsed > 0)
        np.divide(done - all_done[oldest], span, out=rate, where=span > 0)
        state.update((start, int(done[-1]), all_t[-samples:].tolist(), all_done[-samples:].tolist()))
        yield rows[["seq", "t_ms", "n"]].assign(job=key[0], done=done, rate=rate)[["job", "seq", "t_ms", "n", "done", "rate"]]

    typed = log.select(*(F.col(c).cast("long").alias(c) for c in ("job", "seq", "t_ms", "n")))
    return typed.groupBy("job").applyInPandasWithState(run, RATED, RING, "append", "NoTimeout")
