"""Packed id matrices by best-fit-decreasing.

Documents become token ids plus an end id; documents longer than a row are split into full rows and a rest, losslessly.
Inside each chunk of a partition (about `chunk_tokens` tokens) pieces are placed longest first into the open row with the
least room that still fits them. Open rows are counted by their room in a segment tree over rooms 0..capacity, so the
search takes log2(capacity) steps. A chunk is packed in the task that encoded it: no shuffle, no group that grows with the
corpus, and a lost executor's rows are made again from their input split.

A row of output holds: row_id, ids (capacity little-endian uint32 ids, padded), n_tokens, cu_seqlens (cumulative lengths
of the row's pieces, from 0), positions (capacity uint32: each piece counts on from 0, padding is 0), doc_ids and starts of the pieces.

Cases: a null or empty text is the end id alone. Null doc_ids stay null. Repeated documents are packed each. An empty
table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_table, bounded_batches
from .tokens import in_slices, pretokens, tokenizer_path

CAPACITY = 1024
END_ID = 0
CHUNK_TOKENS = 2_000_000
SLICE_BYTES = 8 << 20
ROWS = "row_id long, ids binary, n_tokens int, cu_seqlens array<int>, positions binary, doc_ids array<long>, starts array<long>"


class Rooms:
    """Open bins by room. A segment tree over the rooms says which is the smallest one in use that is large enough."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(self.size)]

    def add(self, room: int, bin_no: int) -> None:
        self.bins[room].append(bin_no)
        self._count(room, 1)

    def _count(self, room: int, by: int) -> None:
        at = room + self.size
        while at:
            self.tree[at] += by
            at >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The open bin with the least room >= need, with that room; it is no longer open."""
        at = need + self.size
        if not self.tree[at]:
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        room = at - self.size
        self._count(room, -1)
        return self.bins[room].pop(), room


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins of piece numbers, pieces placed longest first (ties: first come)."""
    rooms, bins = Rooms(capacity), []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        found = rooms.take(lengths[i])
        if found is None:
            bins.append([])
            found = len(bins) - 1, capacity
        bins[found[0]].append(i)
        if found[1] > lengths[i]:
            rooms.add(found[1] - lengths[i], found[0])
    return bins


def rows_of(pieces: list[tuple[int | None, int, bytes]], capacity: int, first_id: int) -> pa.RecordBatch:
    made: dict[str, list] = {k: [] for k in ("row_id", "ids", "n_tokens", "cu_seqlens", "positions", "doc_ids", "starts")}
    for n, chosen in enumerate(best_fit([len(p[2]) // 4 for p in pieces], capacity)):
        lengths = [len(pieces[i][2]) // 4 for i in chosen]
        ids = b"".join([pieces[i][2] for i in chosen])
        positions = np.zeros(capacity, "<u4")
        positions[: sum(lengths)] = np.concatenate([np.arange(x, dtype="<u4") for x in lengths])
        made["row_id"].append(first_id + n)
        made["ids"].append(ids.ljust(4 * capacity, b"\0"))
        made["n_tokens"].append(sum(lengths))
        made["cu_seqlens"].append(np.cumsum([0, *lengths]).tolist())
        made["positions"].append(positions.tobytes())
        made["doc_ids"].append([pieces[i][0] for i in chosen])
        made["starts"].append([pieces[i][1] for i in chosen])
    kinds = [pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(made.values(), kinds, strict=True)], names=list(made))


def pack_matrix(docs: DataFrame, *, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID, chunk_tokens: int = CHUNK_TOKENS) -> DataFrame:
    """Rows of packed ids of all documents. row_id: the partition's number times 2**32, plus a count inside it."""
    bounded_batches(docs.sparkSession)
    path, end = tokenizer or tokenizer_path(), int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, row = pretokens(path), TaskContext.get().partitionId() << 32
        held: list[tuple[int | None, int, bytes]] = []
        tokens = 0
        for batch in batches:
            docs = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            for part in in_slices(docs, lambda r: len(r[1] or ""), SLICE_BYTES):
                for (doc, _), ids in zip(part, coder.encode([t or "" for _, t in part]), strict=True):
                    ids += end
                    held += [(doc, s // 4, ids[s : s + 4 * capacity]) for s in range(0, len(ids), 4 * capacity)]
                    tokens += len(ids) // 4
                if tokens >= chunk_tokens:
                    yield (made := rows_of(held, capacity, row))
                    row, held, tokens = row + made.num_rows, [], 0
        if held:
            yield rows_of(held, capacity, row)

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, ROWS)


def write_matrix(packed: DataFrame, path: str) -> None:
    """Writes the rows as Parquet: `ids` is the id matrix row, with cu_seqlens and positions beside it."""
    packed.write.parquet(path)


def written_matrix(packed: DataFrame) -> DataFrame:
    """The rows as they are read again from a matrix written under the shared folder, which goes when the process ends."""
    return as_table(packed, "matrix")
