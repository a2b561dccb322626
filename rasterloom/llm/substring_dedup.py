"""Exact substring deduplication behind a count-min prefilter.

Windows are runs of 13 consecutive words of one document. A word goes if it lies in a window whose word sequence also starts
in a document with a smaller doc_id.

0. Of documents with one and the same text only the smallest doc_id needs a look: in the others every window starts in it, so all
   their words go if there are 13 or more. They are found by 128 bits of hash and take no part in what follows.
1. Every chunk of documents makes a count-min sketch of its windows: two rows of cells, counts up to "two or more". The
   sketches are split by cell range and merged range by range, so a task holds one range. The merged sketch is as wide as the corpus
   has windows (`CELLS_PER_WINDOW`), so its share of false repeats stays the same at any size, and it is never put together anywhere: a
   merged range answers every chunk, a bit for each of the chunk's own cells, whether another chunk has that cell too.
2. The second pass brings chunks, compressed, and their answers together, and takes windows whose two cells are both repeated. A
   sketch overestimates, so no repeated window is missed. Chunks are known by a hash of the documents in them: one without an answer,
   as after another split of the input, lets all its windows through, and the result is the same. Inside a chunk windows are
   grouped at once: a window that a document with a smaller id in the same chunk has is decided, and of each other window only the
   smallest doc_id of the chunk goes on. So a window that a third of all documents share leaves each chunk once.
3. These are grouped exactly over all chunks, by 96 bits of hash, to the smallest doc_id. That is one shuffle; a group holds at most
   the rows of one document from each chunk.

Cases: a null text has no words; texts under 13 words have no window and stay whole. Rows with the same doc_id never remove
from each other; a repeated row gets the same result as its twin. Rows with a null doc_id lose nothing and remove nothing.
Windows are judged on the input, not on what is left. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_table, bounded_batches, enter, join_counted, row_pass, struct_of_all, text_bytes
from .hashing import SECOND, mixed, run_hashes, word_hashes

WINDOW = 13
CELLS_PER_WINDOW = 3
#: Cells of a range: from the first number on, doubled while there are more than RANGES ranges, up to the second.
RANGE_CELLS = 1 << 20, 1 << 26
RANGES = 1024
CHUNK_WORDS = 1_200_000
WORD = re.compile(rb"[^\x20\x09-\x0D]+")

def words_of(text: bytes | None) -> list[bytes]:
    return text.split() if text else []


def window_hashes(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of every window of a text: 64 bits and, from another chain, 32."""
    words = word_hashes(words_of(text))
    return run_hashes(words, WINDOW), (run_hashes(words ^ SECOND, WINDOW, SECOND | np.uint64(1)) >> np.uint64(32)).astype(np.uint32)


def sketch_width(docs: DataFrame) -> tuple[int, int]:
    """The number of cells, in both rows together, and the cells of a range. A word counts as six bytes."""
    about = docs.agg(F.sum(F.length("text") / 6.0)).first()[0] or 0.0
    wanted, width = 2 * CELLS_PER_WINDOW * about, RANGE_CELLS[0]
    while width < RANGE_CELLS[1] and wanted > width * RANGES:
        width *= 2
    return max(1, int(wanted / (2 * width))) * 2 * width, width


def cells_of(h: np.ndarray, cells: int) -> np.ndarray:
    """The cells of windows in the first row, then those in the second; each row has half of the cells."""
    half = np.uint64(cells // 2)
    return np.concatenate([h % half, mixed(h, 1) % half + half])


def by_range(cells: np.ndarray, total: int, width: int) -> np.ndarray:
    """Where the ranges begin and end in sorted cells."""
    return np.searchsorted(cells, np.arange(0, total + 1, width, dtype=np.uint64))


def pack_cells(cells: np.ndarray) -> bytes:
    """Sorted cells of one range as compressed differences, byte planes apart."""
    gaps = np.diff(cells.astype(np.uint32), prepend=np.uint32(0))
    return zstandard.compress(gaps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_cells(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(np.uint32).ravel(), dtype=np.uint32)


def chunks(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[list[tuple]]:
    """Rows of (doc_id, text, tag) in chunks of about so many words, counted as six bytes each."""
    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            held.append(row)
            size += len(row[1] or b"") // 6
            if size >= words:
                yield held
                held, size = [], 0
    if held:
        yield held


def chunk_key(rows: list[tuple]) -> bytes:
    """A chunk's name: a hash of which documents it holds, in which order."""
    return xxhash.xxh3_128_digest(np.array([(r[0], r[2]) for r in rows], np.int64).tobytes())


def sketch_parts(docs: DataFrame, cells: int, width: int, chunk_words: int) -> DataFrame:
    """Rows (range, chunk, once, more): cells of a chunk counted exactly once, and more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("words")
        for rows in chunks(batches, chunk_words):
            found = [run_hashes(word_hashes(words_of(text)), WINDOW) for _, text, _ in rows]
            own, n = np.unique(cells_of(np.concatenate(found), cells), return_counts=True)
            cuts, key = by_range(own, cells, width), chunk_key(rows)
            out: list[tuple[int, bytes, bytes]] = []
            for r in np.flatnonzero(np.diff(cuts)).tolist():
                part, many = own[cuts[r] : cuts[r + 1]] - np.uint64(r * width), n[cuts[r] : cuts[r + 1]] > 1
                out.append((r, pack_cells(part[~many]), pack_cells(part[many])))
            columns = [pa.array([o[0] for o in out], pa.int64()), pa.array([key] * len(out), pa.binary()), pa.array([o[1] for o in out], pa.binary()), pa.array([o[2] for o in out], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["range", "chunk", "once", "more"])

    return docs.mapInArrow(run, "range long, chunk binary, once binary, more binary")


def merge_ranges(parts: DataFrame, width: int) -> DataFrame:
    """Rows (chunk, range, bits): for each cell that a chunk has once, whether another chunk has it too. A task holds one range at a time:
    its cells, and its parts as they came, which are about as many bytes as a range has cells."""

    def answers(now: int, held: list[tuple[bytes, bytes, bytes]], counts: np.ndarray) -> pa.RecordBatch:
        counts[:] = 0
        for _, once, more in held:
            cells = unpack_cells(once)
            counts[cells] = np.minimum(counts[cells] + 1, 2)
            counts[unpack_cells(more)] = 2
        bits = [np.packbits(counts[unpack_cells(once)] > 1).tobytes() for _, once, _ in held]
        return pa.RecordBatch.from_arrays([pa.array([h[0] for h in held], pa.binary()), pa.array([now] * len(held), pa.int64()), pa.array(bits, pa.binary())], names=["chunk", "range", "bits"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, counts = None, [], np.zeros(width, np.uint8)
        for batch in batches:
            for r, *part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if r != now:
                    if held:
                        yield answers(now, held, counts)
                    now, held = r, []
                held.append(part)
        if held:
            yield answers(now, held, counts)

    return parts.repartition("range").sortWithinPartitions("range").mapInArrow(run, "chunk binary, range long, bits binary")


def chunk_rows(docs: DataFrame, chunk_words: int) -> DataFrame:
    """Rows (chunk, held): the same chunks, as compressed Arrow streams of doc_id, text and tag."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.binary()), ("tag", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter()
        for rows in chunks(batches, chunk_words):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema))
            yield pa.RecordBatch.from_arrays([pa.array([chunk_key(rows)], pa.binary()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["chunk", "held"])

    return docs.mapInArrow(run, "chunk binary, held binary")


def repeated_in(h: np.ndarray, answers: list[dict] | None, cells: int, width: int) -> np.ndarray:
    """Which windows of a chunk may be repeated: those with both cells had twice in the chunk or, by the answers, in another one."""
    own, inverse, n = np.unique(cells_of(h, cells), return_inverse=True, return_counts=True)
    once = np.flatnonzero(n == 1)
    cuts, told = by_range(own[once], cells, width), {a["range"]: a["bits"] for a in answers or ()}
    sizes = np.diff(cuts)
    twice = n > 1
    for r in np.flatnonzero(sizes).tolist():
        bits = told.get(r)
        known = bits is not None and len(bits) == -(-int(sizes[r]) // 8)
        twice[once[cuts[r] : cuts[r + 1]]] = np.unpackbits(np.frombuffer(bits, np.uint8), count=int(sizes[r])).astype(bool) if known else True
    return twice[inverse].reshape(2, -1).all(axis=0)


CANDIDATES = "h1 long, h2 int, doc_id long, tag long, pos int, spans binary"


def candidates(docs: DataFrame, chunk_words: int) -> DataFrame:
    """Two kinds of rows. With h1: a window that may repeat, with the smallest doc_id that has it in its chunk. With spans:
    windows of a document (starts as int32) that a smaller doc_id in its chunk has; their h1 only spreads them. tag tells texts of one
    doc_id apart. docs: doc_id (not null), text as bytes, tag."""
    cells, width = sketch_width(docs)
    answers = merge_ranges(sketch_parts(docs, cells, width, chunk_words), width)
    told = answers.groupBy("chunk").agg(F.collect_list(F.struct("range", "bits")).alias("answers"))  # a bit for each cell of a chunk
    both = chunk_rows(docs, chunk_words).join(told, "chunk", "left").select("held", "answers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("words")
        for batch in batches:
            for held, mine in zip(batch.column(0), batch.column(1), strict=True):
                rows = pa.ipc.open_stream(held.as_buffer()).read_all()
                yield from chunk_candidates(rows, mine.as_py())

    def chunk_candidates(rows: pa.Table, mine: list[dict] | None) -> Iterator[pa.RecordBatch]:
        parts = []
        for i, text in enumerate(rows["text"].to_pylist()):
            h1, h2 = window_hashes(text)
            if len(h1):
                parts.append((h1, h2, np.arange(len(h1), dtype=np.int32), np.full(len(h1), i, np.int32)))
        if not parts:
            return
        h1, h2, pos, row = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        some = repeated_in(h1, mine, cells, width)
        h1, h2, pos, row = h1[some], h2[some], pos[some], row[some]
        ids, tags = rows["doc_id"].to_numpy(), rows["tag"].to_numpy()
        order = np.lexsort((pos, row, ids[row], h2, h1))
        h1, h2, pos, row = h1[order], h2[order], pos[order], row[order]
        new = np.r_[True, (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])] if len(h1) else np.empty(0, bool)
        least = ids[row[np.flatnonzero(new)]][np.cumsum(new) - 1] if len(h1) else ids[:0]
        here = ids[row] > least
        go = ~here
        yield pa.RecordBatch.from_arrays([pa.array(h1[go].view(np.int64)), pa.array(h2[go].view(np.int32)), pa.array(ids[row[go]]), pa.array(tags[row[go]]), pa.array(pos[go]), pa.nulls(int(go.sum()), pa.binary())], names=["h1", "h2", "doc_id", "tag", "pos", "spans"])
        pos, row = pos[here], row[here]
        order = np.lexsort((pos, row))
        pos, row = pos[order], row[order]
        owners, begins = np.unique(row, return_index=True)
        spans = [p.tobytes() for p in np.split(pos, begins[1:])] if len(owners) else []
        yield pa.RecordBatch.from_arrays([pa.array(ids[owners]), pa.nulls(len(owners), pa.int32()), pa.array(ids[owners]), pa.array(tags[owners]), pa.nulls(len(owners), pa.int32()), pa.array(spans, pa.binary())], names=["h1", "h2", "doc_id", "tag", "pos", "spans"])

    return both.mapInArrow(run, CANDIDATES)


def copies_of(docs: DataFrame) -> DataFrame:
    """id and tag of documents whose text a smaller doc_id has too. docs: doc_id, text, tag."""
    hashed = docs.select("doc_id", "tag", F.xxhash64(F.lit(1), "text").alias("h"))
    least = hashed.groupBy("tag", "h").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).where("least < most").select("tag", "h", "least")
    # A table of its own: the join may then split a text that very many documents have.
    return join_counted(hashed, as_table(least, "texts"), ["tag", "h"], "inner").where("doc_id > least").select(F.col("doc_id").alias("id"), "tag").distinct()


def once_each(docs: DataFrame) -> DataFrame:
    """Each text of a doc_id once: what is on several rows is shuffled and written, so that both passes over it cut the same chunks."""
    repeated = as_table(docs.groupBy("doc_id", "tag").agg(F.count("*").alias("n")).where("n > 1").select("doc_id", "tag"), "repeated")
    if repeated.isEmpty():
        return docs
    single = join_counted(docs, repeated, ["doc_id", "tag"], "left_anti").select("doc_id", "text", "tag")
    more = join_counted(docs, repeated, ["doc_id", "tag"], "left_semi").dropDuplicates(["doc_id", "tag"]).select("doc_id", "text", "tag")
    return single.union(as_table(more, "once"))


def repeated_windows(docs: DataFrame, *, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """id, hits: for each text of a doc_id its tag, and spans of words to remove (int32 pairs), or that it is a copy (whole).
    docs: doc_id (not null), text as bytes, tag."""
    copies = as_table(copies_of(docs), "copies")
    own = join_counted(once_each(docs).withColumnRenamed("doc_id", "id"), copies, ["id", "tag"], "left_anti").select(F.col("id").alias("doc_id"), "text", "tag")
    found = candidates(own, chunk_words)
    least = F.min("doc_id").over(Window.partitionBy("h1", "h2", F.col("spans").isNull()))
    late = found.withColumn("least", least).where("spans is not null or doc_id > least")
    starts = late.groupBy("doc_id", "tag").agg(F.collect_list("pos").alias("starts"), F.collect_list("spans").alias("spans"))  # at most the windows of one text, as each is there once
    hits = starts.mapInArrow(words_of_windows, "id long, tag long, spans binary").withColumn("whole", F.lit(False))
    hits = hits.union(copies.select("id", "tag", F.lit(None).cast("binary"), F.lit(True)))
    return hits.groupBy("id").agg(F.collect_list(F.struct("tag", "spans", "whole")).alias("hits"))


def words_of_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Window starts of a text as the spans of words they cover: sorted pairs from, to."""
    for batch in batches:
        spans = []
        for starts, packed in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            at = np.unique(np.concatenate([np.array(starts, np.int32), *(np.frombuffer(p, np.int32) for p in packed)]))
            breaks = np.flatnonzero(np.diff(at) > WINDOW)
            spans.append(np.column_stack([at[np.r_[0, breaks + 1]], at[np.r_[breaks, len(at) - 1]] + WINDOW]).astype(np.int32).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, pa.binary())], names=["id", "tag", "spans"])


def kept_mask(n_words: int, spans: bytes) -> np.ndarray:
    """True for the words that stay."""
    stay = np.ones(n_words, bool)
    for a, b in np.frombuffer(spans, np.int32).reshape(-1, 2):
        stay[a:b] = False
    return stay


def left_text(text: bytes, keep: np.ndarray) -> bytes:
    """The text without the other words: kept stretches as they stand, joined by a blank."""
    places = [m.span() for m in WORD.finditer(text)]
    edges = np.flatnonzero(np.diff(keep.astype(np.int8), prepend=0, append=0))
    return b" ".join([text[places[a][0] : places[b - 1][1]] for a, b in zip(edges[::2], edges[1::2], strict=True)])


OUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType()), T.StructField("text", T.StringType())])


def dedup(docs: DataFrame, keep: Column | None = None, *, want_text: bool = True, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """row (all columns of docs, or keep) and out: n_words, n_removed, kept_sha256 (of the kept words joined by blanks), text
    (the whole text if nothing was removed; null if want_text is false)."""
    bounded_batches(docs.sparkSession)
    keep = struct_of_all(docs) if keep is None else keep
    tag = F.coalesce(F.xxhash64("text"), F.lit(0)).alias("tag")
    plain = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes("text").alias("text"), tag)
    by_id = as_table(repeated_windows(plain, chunk_words=chunk_words), "hits")
    rows = docs.select(keep.alias("row"), F.col("doc_id").cast("long").alias("id"), text_bytes("text").alias("text"), tag)
    size = F.aggregate("hits", F.lit(0), lambda n, x: n + F.coalesce(F.length(x.spans), F.lit(0)) + 16)
    both = join_counted(rows, by_id, ["id"], "left", size)

    def remove(payload: list[dict]) -> dict[str, list]:
        made: dict[str, list] = {"n_words": [], "n_removed": [], "kept_sha256": [], "text": []}
        for r in payload:
            text, words = r["text"], words_of(r["text"])
            mine = next((h for h in r["hits"] or () if h["tag"] == r["tag"]), None)
            stay = None if mine is None or len(words) < WINDOW else np.zeros(len(words), bool) if mine["whole"] else kept_mask(len(words), mine["spans"])
            kept = words if stay is None else [w for w, s in zip(words, stay, strict=True) if s]
            made["n_words"].append(len(words))
            made["n_removed"].append(len(words) - len(kept))
            made["kept_sha256"].append(hashlib.sha256(b" ".join(kept)).hexdigest())
            made["text"].append(None if text is None or not want_text else (text if stay is None else left_text(text, stay)).decode())
        return made

    return row_pass(both, F.struct("text", "tag", "hits"), F.col("row"), remove, OUT)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return dedup(docs, F.struct("doc_id"), want_text=False).select("row.doc_id", "out.n_words", "out.n_removed", "out.kept_sha256")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """All rows of docs, texts without the removed words and n_chars to match, other columns unchanged."""
    done = dedup(docs)
    changed = F.col("out.n_removed") > 0
    text = F.when(changed, F.col("out.text")).otherwise(F.col("row.text"))
    columns = {"text": text, "n_chars": F.when(changed, F.length("out.text").cast("long")).otherwise(F.col("row.n_chars"))} if "n_chars" in docs.columns else {"text": text}
    return done.select([columns.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])
