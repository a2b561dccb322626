"""Throughput and progress over an ordered log of finished work: seq, t_ms, n. seq orders the log; it need not be dense.

Running totals over one long order don't have to run in one task: rows are numbered and summed inside ranges of seq, and only the
ranges' totals are summed in sequence. A frame of the last 64 rows is then a join by row number."""

from __future__ import annotations

import sys
import threading
import time
from collections import deque
from collections.abc import Callable
from typing import TextIO

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import duration, fraction, percent

SAMPLES = 64
RANGE = 1 << 16


def numbered(log: DataFrame, width: int = RANGE) -> DataFrame:
    """Adds row_no (from 1) and done (running total of n). width: how many values of seq make a range."""
    held = log.withColumn("part", F.floor(F.col("seq") / width))
    totals = held.groupBy("part").agg(F.count("*").alias("rows"), F.sum("n").alias("total"))
    sequence = Window.orderBy("part")  # a row per range, not per log row
    before = totals.select("part", (F.sum("rows").over(sequence) - F.col("rows")).alias("rows_before"), (F.sum("total").over(sequence) - F.col("total")).alias("done_before"))
    inside = Window.partitionBy("part").orderBy("seq")
    out = held.withColumn("row_no", F.row_number().over(inside)).withColumn("done", F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    out = out.join(before, "part")
    return out.select(*log.columns, (F.col("row_no") + F.col("rows_before")).alias("row_no"), (F.col("done") + F.col("done_before")).alias("done"))


def sliding_rate(log: DataFrame, samples: int = SAMPLES, width: int = RANGE, start_ms: int | None = None) -> DataFrame:
    """seq, t_ms, n, done and rate: over the last `samples` rows, or since the start where these span no time, or 0.

    The work started at start_ms (the first row's time, if it isn't given) with nothing done; that is a sample like the rows, the oldest
    one until `samples` rows have come."""
    rows = numbered(log, width)
    if start_ms is None:
        start_ms = log.agg(F.min_by("t_ms", "seq").alias("start")).first().start
    start = F.lit(start_ms).cast("long")
    oldest = rows.select((F.col("row_no") + samples - 1).alias("row_no"), F.col("t_ms").alias("old_t"), F.col("done").alias("old_done"))
    out = rows.join(oldest, "row_no", "left")
    span = (F.col("t_ms") - F.coalesce("old_t", start)) / 1000
    grown = F.col("done") - F.coalesce("old_done", F.lit(0))
    elapsed = (F.col("t_ms") - start) / 1000
    rate = F.when(span > 0, grown / span).when(elapsed > 0, F.col("done") / elapsed).otherwise(0.0)
    return out.select(*log.columns, "done", rate.alias("rate"))


def eta(done: Column, total: Column, rate: Column) -> Column:
    """Seconds left; null where unknown or finished."""
    return F.when((rate > 0) & (done < total), (total - done) / rate)


def with_eta(rates: DataFrame, total: Column) -> DataFrame:
    left = eta(F.col("done"), total, F.col("rate"))
    return rates.withColumn("eta", left).withColumn("eta_text", duration(left))


def percent_lines(log: DataFrame, total: Column, width: int = RANGE) -> DataFrame:
    """The rows at which the whole percentage changes, from that of nothing done: seq, done, pct. The percentage before a row follows from
    the row itself."""
    rows = numbered(log, width).withColumn("pct", percent(F.col("done"), total))
    return rows.where(percent(F.col("done") - F.col("n"), total) != F.col("pct")).select("seq", "done", "pct")


def status_line(done: Column, total: Column, rate: Column) -> Column:
    """` 42% 42/100 (1.5/s, ETA 39s)`."""
    return F.format_string("%3d%% %d/%d (%.1f/s, ETA %s)", percent(done, total), done, total, rate, duration(eta(done, total, rate)))


def filled(done: Column, total: Column, width: int = 24) -> Column:
    """How many of the bar's cells are filled."""
    return F.floor(fraction(done, total) * width + 0.5).cast("int")


def clock(seconds: float | None) -> str:
    """The text of `duration`, for the driver."""
    if seconds is None or seconds < 0:
        return "--"
    minutes, s = divmod(int(seconds + 0.5), 60)
    hours, m = divmod(minutes, 60)
    return f"{hours}h{m:02d}m" if hours else f"{m}m{s:02d}s" if m else f"{s}s"


class Progress:
    """Reports a running job on a text stream: a line at the start, at each new whole percentage and at the end; on a terminal one line
    that is drawn again, with a bar, at most ten times a second."""

    def __init__(self, total: int, label: str = "", out: TextIO | None = None, now: Callable[[], float] = time.monotonic) -> None:
        self.total, self.label, self.out, self.now = total, label, out or sys.stderr, now
        self.count, self.start = 0, now()
        self.samples = deque([(self.start, 0)], maxlen=SAMPLES)
        self.shown: tuple[float, int] | None = None
        self.live = self.out.isatty()
        self.show()

    def rate(self) -> float:
        (t0, n0), (t1, n1) = self.samples[0], self.samples[-1]
        if t1 > t0:
            return (n1 - n0) / (t1 - t0)
        elapsed = self.now() - self.start
        return self.count / elapsed if elapsed > 0 else 0.0

    def status(self) -> str:
        """The text of `status_line`."""
        share, rate = self.count / self.total if self.total else 1.0, self.rate()
        left = (self.total - self.count) / rate if rate > 0 and self.count < self.total else None
        return f"{int(share * 100):3d}% {self.count}/{self.total} ({rate:.1f}/s, ETA {clock(left)})"

    def show(self, force: bool = True) -> None:
        now, share = self.now(), self.count / self.total if self.total else 1.0
        if not force and (now - self.shown[0] < 0.1 if self.live else int(share * 100) == self.shown[1]):
            return
        self.shown, label = (now, int(share * 100)), f"{self.label} " if self.label else ""
        if self.live:
            cells = int(share * 24 + 0.5)
            self.out.write(f"\r{label}[{'█' * cells}{'░' * (24 - cells)}] {self.status()}\x1b[K")
        else:
            self.out.write(f"{label}{self.status()}\n")
        self.out.flush()

    def tick(self, n: int = 1) -> None:
        self.count += n
        self.samples.append((self.now(), self.count))
        self.show(False)

    def set_label(self, label: str) -> None:
        self.label = label

    def done(self) -> None:
        self.count = self.total
        self.show()
        if self.live:
            self.out.write("\n")

    def following(self, counted: Callable[[], int], every: float = 1.0) -> Following:
        """A block during which a counter that tasks add to (an accumulator) is shown as it grows."""
        return Following(self, counted, every)


class Following:
    def __init__(self, bar: Progress, counted: Callable[[], int], every: float) -> None:
        self.bar, self.counted, self.every, self.over = bar, counted, every, threading.Event()
        self.base, self.thread = bar.count, threading.Thread(target=self.run, daemon=True)

    def look(self) -> None:
        """Tasks that are run again count again, so the number is cut to what there is to do."""
        grown = min(self.counted() + self.base, self.bar.total) - self.bar.count
        if grown > 0:
            self.bar.tick(grown)

    def run(self) -> None:
        while not self.over.wait(self.every):
            self.look()

    def __enter__(self) -> Progress:
        self.thread.start()
        return self.bar

    def __exit__(self, *_: object) -> None:
        self.over.set()
        self.thread.join()
        self.look()
