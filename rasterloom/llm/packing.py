"""Sequence packing by minimum bin slack.

Every document becomes its token ids plus an end id. Full windows of `capacity` tokens are cut off its front; what remains
is one shorter piece. All that packing has to know is how many pieces of each length there are: at most `capacity` counts,
however large the corpus. On these counts the driver repeats: take the longest remaining length, find by a bitset
subset-sum programme the multiset of remaining lengths that, with it, comes closest to capacity, trace the counts back,
and use that pattern for as many windows as the counts allow (each use exhausts a length, so the plan is bounded too).

A piece then needs only its rank among the pieces of its length to find its window and offset. Ranks come from salted
groups: counts per (length, salt) are summed up, and row_number runs inside a group. A length with n pieces has about sqrt(n) * `spread`
salts, so that groups, and the sums over a length's groups, both grow with the root of the corpus only. The salt is a hash of a
number that each piece is written with, not of its contents, so a length that a third of all pieces share is spread over many tasks,
even if these are all of one doc_id or of none.

Cases: a null or empty text is the end id alone. Repeated rows are packed each. An empty table gives no piece. Null
doc_ids are kept. Which of two pieces of one length comes first depends on how the input is split.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import as_table, bounded_batches
from .tokens import in_slices, pretokens, tokenizer_path

CAPACITY = 1024
END_ID = 0
SPREAD = 0.25
SLICE_BYTES = 8 << 20

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLAN = ("length", "first_rank", "last_rank", "per_bin", "first_bin", "base")


def cut(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of all documents with the checksum of their ids and a number of their own. One Arrow pass; the ids stay in the worker."""
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, number = pretokens(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for part in in_slices(rows, lambda r: len(r[1] or ""), SLICE_BYTES):
                out: list[tuple] = []
                for (doc, _), ids in zip(part, coder.encode([t or "" for _, t in part]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    for s in range(0, n, capacity):
                        piece = ids[4 * s : 4 * (s + capacity)]
                        out.append((doc, s, len(piece) // 4, zlib.crc32(piece), n))
                columns = [pa.array(c, pa.int64()) for c in (*zip(*out, strict=True), range(number, number + len(out)))]
                number += len(out)
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "number"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, PIECES + ", number long")


def closest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The multiset of lengths (length -> number, within counts) whose sum is the largest up to room."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        left, size = min(counts[length], room // length), 1
        while left > 0:
            take = min(size, left)
            grown = (reach | reach << (length * take)) & mask
            if grown != reach:
                steps.append((reach, length, take))
                reach = grown
            left -= take
            size *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            total -= length * take
            used[length] = used.get(length, 0) + take
    return used


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows of PLAN: pieces of `length` ranked first_rank..last_rank-1 fill bins from first_bin on, per_bin in each, from base."""
    left, seen, bins, out = {k: v for k, v in histogram.items() if v > 0}, dict.fromkeys(histogram, 0), 0, []
    while left:
        longest = max(left)
        left[longest] -= 1
        pattern = closest({k: v for k, v in left.items() if v}, capacity - longest)
        left[longest] += 1
        pattern[longest] = pattern.get(longest, 0) + 1
        times, base = min(left[k] // n for k, n in pattern.items()), 0
        for k, n in sorted(pattern.items(), reverse=True):
            out.append((k, seen[k], seen[k] + n * times, n, bins, base))
            seen[k] += n * times
            left[k] -= n * times
            base += n * k
            if not left[k]:
                del left[k]
        bins += times
    return out


def place(pieces: DataFrame, rows: list[tuple[int, int, int, int, int, int]]) -> DataFrame:
    """Adds sequence_id and offset to pieces that have a rank."""
    held = pieces.sparkSession.sparkContext.broadcast(np.array(sorted(rows), np.int64).reshape(-1, len(PLAN)))  # bounded by the number of lengths

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        starts = {int(k): (i, j) for k in np.unique(table[:, 0]) for i, j in [np.searchsorted(table[:, 0], (k, k + 1))]}
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.empty(len(rank), np.int64)
            for k in np.unique(length):
                i, j = starts[int(k)]
                some = length == k
                at[some] = i + np.searchsorted(table[i:j, 1], rank[some], side="right") - 1
            row = table[at]
            nth = rank - row[:, 1]
            columns = [*batch.columns[:-1], pa.array(row[:, 4] + nth // row[:, 3]), pa.array(row[:, 5] + nth % row[:, 3] * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    return pieces.mapInArrow(run, PIECES + ", sequence_id long, offset long")


def pack(docs: DataFrame, *, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, spread: float = SPREAD) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    bounded_batches(docs.sparkSession)
    pieces = as_table(cut(docs, tokenizer or tokenizer_path(), capacity, end_id), "pieces")
    lengths = pieces.groupBy("length").agg(F.count("*").alias("n"))
    histogram = {r.length: r.n for r in lengths.collect()}  # a row per length, at most `capacity`
    salts = F.broadcast(lengths.select("length", F.ceil(F.sqrt("n") * spread).alias("salts")))  # the same rows
    salted = pieces.join(salts, "length").withColumn("salt", F.pmod(F.xxhash64("number"), F.col("salts")).cast("int"))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    # One row per length and salt; the running sum is taken inside a length.
    offsets = groups.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).select("length", "salt", "before")
    within = Window.partitionBy("length", "salt").orderBy("number")
    ranked = salted.withColumn("nth", F.row_number().over(within)).join(offsets, ["length", "salt"])
    ranked = ranked.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("nth") - 1 + F.col("before")).cast("long").alias("rank"))
    return place(ranked, plan(histogram, capacity))
