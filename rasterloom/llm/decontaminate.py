"""Benchmark decontamination by a prefix-filtered set join.

A window is a run of `window` consecutive words of a benchmark item (an item with fewer words is one window). Each window
is a set of word shingles. Shingles are ordered by rarity, counted over the whole corpus; as a window must be contained
entirely, its necessary prefix is its one rarest shingle. Documents are probed for those prefix shingles; the shingle's
place in the window gives the only start that can match (positional bound), which must leave room for the window inside
the document (length bound); then the whole window is compared word by word.

A benchmark of at most `block_windows` windows is held by the driver and broadcast (about 2 kB a window): a count and a probe of the
documents. A larger one never is in one place. Its windows are a table; a bitmap of bounded size (`MARKS`) tells the documents' passes which
shingles may be the benchmark's, so only these leave them. One pass counts them, one sends each place of a prefix shingle with the words
around it, and joins on the shingle, then on the whole window, find the occurrences and their items. So the number of passes doesn't grow
with the benchmark. What is found is a table of hits, which the pass of the result adds.
Hits belong to a text: rows are known by doc_id and a hash of their text.

Cases: a null or wordless text has no words and no hit. A null or wordless item, or one with a null id, gives no window.
Rows of the benchmark with the same item_id count as one item. Repeated documents get a row each. An empty benchmark marks
nothing; empty documents give an empty result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_WORDS, as_table, bounded_batches, enter, join_counted, row_pass, struct_of_all, text_bytes
from .hashing import run_hashes, word_hashes

WINDOW = 10
SHINGLE = 3
BLOCK_WINDOWS = 50_000
#: Bits of the bitmap of shingles, at most (32 MB). Beyond a sixteenth as many shingles it lets more others through, which the join drops.
MARKS = 1 << 28
#: Rows that a pass sends at a time.
STEP = 10_000

Words = tuple[bytes, ...]


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(ALNUM_WORDS).split() if text else []


def item_windows(text: bytes | None, window: int) -> list[Words]:
    words = words_of(text)
    size = min(window, len(words))
    return [tuple(words[s : s + size]) for s in range(len(words) - size + 1)] if size else []


def shingle_starts(window: Words, shingle: int) -> list[tuple[int, Words]]:
    size = min(shingle, len(window))
    return [(o, window[o : o + size]) for o in range(len(window) - size + 1)]


def blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_windows: int) -> Iterator[dict[Words, list[str]]]:
    """Blocks of windows with the items that hold them, read row by row; no more than two are asked for."""
    block: dict[Words, list[str]] = defaultdict(list)
    held = 0
    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), text_bytes(text_col).alias("text")).where("item is not null and text is not null")
    for item, text in rows.toLocalIterator():
        for w in item_windows(bytes(text), window):
            if held >= block_windows:
                yield dict(block)
                block, held = defaultdict(list), 0
            if item not in block[w]:
                block[w].append(item)
            held += 1
    if block:
        yield dict(block)


def heads_by_size(shingles) -> dict[int, frozenset[bytes]]:
    """The first words of shingles, by the number of words in the shingle."""
    heads: dict[int, set[bytes]] = defaultdict(set)
    for s in shingles:
        heads[len(s)].add(s[0])
    return {k: frozenset(v) for k, v in heads.items()}


def shingle_counts(docs: DataFrame, text_col: str, shingles: list[Words]) -> Counter[Words]:
    """How often each of these shingles (a bounded list) stands in all documents."""
    spark = docs.sparkSession
    bounded_batches(spark)
    number = spark.sparkContext.broadcast({s: i for i, s in enumerate(shingles)})
    heads = heads_by_size(shingles)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, found = number.value, np.zeros(len(number.value), np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                for size, first in heads.items():
                    for p in [p for p, w in enumerate(words) if w in first]:
                        at = ids.get(tuple(words[p : p + size]))
                        if at is not None:
                            found[at] += 1
        some = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(found[some], pa.int64())], names=["shingle", "n"])

    counted = docs.select(text_bytes(text_col).alias("text")).mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    out = Counter({shingles[i]: n for i, n in counted.collect()})  # at most len(shingles) rows
    number.unpersist()
    return out


class Index:
    """A block of windows behind their rarest shingles."""

    def __init__(self, block: dict[Words, list[str]], counts: Counter[Words], shingle: int) -> None:
        self.windows = block
        self.prefix: dict[Words, set[tuple[int, int]]] = defaultdict(set)
        for w in block:
            at, rare = min(shingle_starts(w, shingle), key=lambda x: (counts[x[1]], x[1], x[0]))
            self.prefix[rare].add((at, len(w)))
        self.prefix = dict(self.prefix)
        self.heads = heads_by_size(self.prefix)

    def probe(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of words inside an occurrence of a window, and the items found."""
        spans, items, n = [], set(), len(words)
        for size, first in self.heads.items():
            for p in [p for p, w in enumerate(words) if w in first]:
                for at, length in self.prefix.get(tuple(words[p : p + size]), ()):
                    start = p - at
                    if start < 0 or start + length > n:
                        continue
                    held = self.windows.get(tuple(words[start : start + length]))
                    if held:
                        spans.append((start, start + length))
                        items.update(held)
        return spans, items


FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("spans", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType()))])


def merged(spans: list[tuple[int, int]]) -> np.ndarray:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return np.array(out, np.int32).reshape(-1, 2)


def scan(index: Index, payload: list[dict]) -> dict[str, list]:
    """What the index finds in each text, with what `hits` (spans and items that joins found) has."""
    made: dict[str, list] = {"n_words": [], "n_hit": [], "spans": [], "items": []}
    for row in payload:
        words = words_of(row["text"])
        spans, items = index.probe(words)
        for h in row["hits"] or ():
            spans += map(tuple, np.frombuffer(h["spans"], np.int32).reshape(-1, 2).tolist())
            items.update(h["items"])
        union = merged(spans)
        made["n_words"].append(len(words))
        made["n_hit"].append(int((union[:, 1] - union[:, 0]).sum()))
        made["spans"].append(union.tobytes())
        made["items"].append(sorted(items))
    return made


HITS = "array<struct<spans:binary,items:array<string>>>"


def probed(rows: DataFrame, index: Broadcast, keep: Column) -> DataFrame:
    return row_pass(rows, F.struct("text", "hits"), keep, lambda payload: scan(index.value, payload), FOUND)


def marks_of(hashes: DataFrame) -> np.ndarray:
    """Bytes with a bit for the low bits of each `h`; their number is a power of two and at most MARKS / 8."""
    n, bits = hashes.count(), 1 << 16
    while bits < MARKS and bits < 16 * n:
        bits *= 2
    place = F.col("h").bitwiseAND(bits - 1) + 1
    pieces = hashes.groupBy(F.bitmap_bucket_number(place).alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    marks = np.zeros(bits // 8, np.uint8)
    for r in pieces.collect():  # at most MARKS / 32,768 rows of 4 kB
        marks[(r.piece - 1) * 4096 : r.piece * 4096] = np.frombuffer(r.bits, np.uint8)
    return marks


def marked(marks: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes have their bit."""
    at = h & np.uint64(8 * len(marks) - 1)
    return (marks[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def window_rows(benchmark: DataFrame, item_col: str, text_col: str, window: int, shingle: int) -> DataFrame:
    """item, w (the words of a window), size (of its shingles), shingles (their hashes, by place)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("words")
        for batch in batches:
            for item, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                words = words_of(text)
                length = min(window, len(words))
                size = min(shingle, length)
                h = run_hashes(word_hashes(words), size).view(np.int64) if size else None
                for a in range(0, len(words) - length + 1 if size else 0, STEP):
                    starts = range(a, min(len(words) - length + 1, a + STEP))
                    columns = [pa.array([item] * len(starts)), pa.array([words[s : s + length] for s in starts], pa.list_(pa.binary())), pa.array([size] * len(starts), pa.int32()), pa.array([h[s : s + length - size + 1] for s in starts], pa.list_(pa.int64()))]
                    yield pa.RecordBatch.from_arrays(columns, names=["item", "w", "size", "shingles"])

    rows = benchmark.select(F.col(item_col).cast("string").alias("item"), text_bytes(text_col).alias("text")).where("item is not null and text is not null")
    return rows.mapInArrow(run, "item string, w array<binary>, size int, shingles array<bigint>").dropDuplicates(["w", "item"])


def marked_counts(texts: DataFrame, marks: Broadcast, sizes: list[int]) -> DataFrame:
    """h, n: how often each marked shingle stands in all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("words")
        for batch in batches:
            found = [np.empty(0, np.uint64)]
            for text in batch.column(0).to_pylist():
                words = word_hashes(words_of(text))
                for h in (run_hashes(words, size) for size in sizes):
                    found.append(h[marked(marks.value, h)])
            h, n = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["h", "n"])

    return texts.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def marked_places(texts: DataFrame, marks: Broadcast, sizes: list[int], window: int) -> DataFrame:
    """key, n_words, h, p: each place of a marked shingle; around: the words that a window over it can hold, of which `first` is the first."""
    schema = T.StructType([texts.schema["key"], T.StructField("n_words", T.IntegerType()), T.StructField("h", T.LongType()), T.StructField("p", T.IntegerType()), T.StructField("first", T.IntegerType()), T.StructField("around", T.ArrayType(T.BinaryType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("words")
        for batch in batches:
            for i, text in enumerate(batch.column(1).to_pylist()):
                words = words_of(text)
                hashes = word_hashes(words)
                for h in (run_hashes(hashes, size) for size in sizes):
                    at = np.flatnonzero(marked(marks.value, h))
                    for places in np.split(at, range(STEP, len(at), STEP)) if len(at) else ():
                        first = np.maximum(places - (window - 1), 0)
                        around = [words[a : p + window] for a, p in zip(first.tolist(), places.tolist(), strict=True)]
                        columns = [batch.column(0).take(pa.array(np.full(len(places), i))), pa.array(np.full(len(places), len(words)), pa.int32()), pa.array(h[places].view(np.int64)), pa.array(places, pa.int32()), pa.array(first, pa.int32()), pa.array(around, pa.list_(pa.binary()))]
                        yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return texts.select("key", "text").mapInArrow(run, schema)


def joined_hits(texts: DataFrame, windows: DataFrame, window: int) -> DataFrame:
    """key and hits (spans and items) of texts (key, text) that hold a window of a table of any size, by joins."""
    spark = texts.sparkSession
    bounded_batches(spark)
    held = as_table(windows, "windows")
    sizes = [r.size for r in held.select("size").distinct().collect()]  # at most as many as a shingle has words
    each = held.dropDuplicates(["w"]).select("w", F.size("shingles").alias("many"), F.posexplode("shingles").alias("at", "h"))
    marks = spark.sparkContext.broadcast(marks_of(each.select("h").distinct()))
    totals = as_table(marked_counts(texts, marks, sizes), "shingles")
    marks.unpersist()
    # A window with a shingle that no document has can't occur; of the others the rarest shingle is the prefix.
    rarest = join_counted(each, totals, ["h"], "inner").groupBy("w", "many").agg(F.min(F.struct("n", "h", "at")).alias("rare"), F.count("*").alias("have")).where("have = many")
    prefix = rarest.select("rare.h", F.struct("rare.at", F.size("w").alias("length")).alias("place")).groupBy("h").agg(F.collect_set("place").alias("places"))  # places: at most window * window
    prefix = as_table(prefix, "prefix")
    marks = spark.sparkContext.broadcast(marks_of(prefix.select("h")))
    near = join_counted(marked_places(texts, marks, sizes, window), prefix, ["h"], "inner", 16 * F.size("places"))
    starts = near.select("key", "n_words", "first", "around", "p", F.explode("places").alias("place")).withColumn("start", F.col("p") - F.col("place.at"))
    starts = starts.where((F.col("start") >= 0) & (F.col("start") + F.col("place.length") <= F.col("n_words")))  # the positional and the length bound
    starts = starts.select("key", F.struct("start", (F.col("start") + F.col("place.length")).alias("stop")).alias("span"), F.slice("around", F.col("start") - F.col("first") + 1, F.col("place.length")).alias("w"))
    found = join_counted(starts, held.select("w", "item"), ["w"], "inner", 16 * F.size("w"))
    found = found.groupBy("key").agg(F.collect_set("span").alias("spans"), F.collect_set("item").alias("items"))
    schema = T.StructType([texts.schema["key"], T.StructField("spans", T.BinaryType()), T.StructField("items", T.ArrayType(T.StringType()))])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = [merged([(s["start"], s["stop"]) for s in some]).tobytes() for some in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.binary()), batch.column(2)], names=schema.fieldNames())

    return as_table(found.mapInArrow(pack, schema).select("key", F.array(F.struct("spans", "items")).alias("hits")), "hits")


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: Column | None = None, *, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, shingle: int = SHINGLE, block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """row (all columns of docs, or keep) and out: n_words, n_hit, spans (int32 pairs of hit words), items (sorted ids)."""
    spark = docs.sparkSession
    keep = struct_of_all(docs) if keep is None else keep
    rows = docs.select(keep.alias("row"), text_bytes(text_col).alias("text"), F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tag")).alias("key"))
    stream = blocks(benchmark, item_col, item_text_col, window, block_windows)
    block, larger = next(stream, {}), next(stream, None) is not None
    stream.close()
    if larger:
        block = {}
        windows = window_rows(benchmark, item_col, item_text_col, window, shingle)
        found = joined_hits(rows.select("key", "text").where("text is not null"), windows, window)
        size = F.aggregate("hits", F.lit(0), lambda n, h: n + F.length(h.spans) + 64 * F.size(h["items"]))
        # The id and the tag apart, and null-safe: rows without an id have hits too.
        found = found.select(F.col("key.tag").alias("_tag"), F.col("key.id").alias("_id"), "hits")
        on = (F.col("key.tag") == F.col("_tag")) & F.col("key.id").eqNullSafe(F.col("_id"))
        rows = join_counted(rows, found, on, "left", size)
    else:
        rows = rows.withColumn("hits", F.lit(None).cast(HITS))
    shingles = list({s for w in block for _, s in shingle_starts(w, shingle)})
    index = Index(block, shingle_counts(docs, text_col, shingles) if block else Counter(), shingle)
    return probed(rows, spark.sparkContext.broadcast(index), F.col("row"))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_contamination(docs, benchmark, F.struct("doc_id"))
    return found.select("row.doc_id", "out.n_words", "out.n_hit", F.size("out.items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "out.items"), 256).alias("items_sha256"), (F.col("out.n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a hit, columns unchanged."""
    return find_contamination(docs, benchmark).where("out.n_hit = 0").select("row.*")
