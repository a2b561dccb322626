"""Near-duplicate groups: MinHash bands, sequential Bayesian verification, exact confirmation.

A document's set is its distinct runs of five lower-cased words. Documents with equal sets are joined first and one of them,
the smallest doc_id, stands for all. Its MinHash signature is banded; documents that share a band are in one bucket.
A candidate pair is compared batch by batch of the signature: after n values with m equal, the posterior of the similarity
under a uniform prior is Beta(m + 1, n - m + 1), and the pair is dropped once the chance that it reaches the threshold is under
`miss`. Survivors are confirmed on the full sets: 100 * |A and B| >= percent * |A or B|, 85 if nothing else is asked for.

What is wanted are components, so pairs that are joined already are never compared:
1. every member of a bucket against the bucket's smallest member (a pair per member, not per pair of members);
2. then, in buckets that still hold several components, members of different components, block by block, with the few best
   partners in each other component first. A task says if it kept partners back; only its blocks are compared once more, with more
   partners and at last with all that survive, so that no link is lost for want of a partner. Mostly no block is.
Buckets are dealt out in blocks of `block` members; a group of any size is a number of bounded tasks, and the pairs that leave
a task are only survivors between different components.

With 32 bands of 7 values a pair at 85 % misses all buckets with chance 4e-6, and less above it. Other thresholds take as many bands
of 7 values as keep that chance (`bands_for`): 53 at 80 %, where 32 would miss 5e-4.

Cases: a null, empty or wordless text has an empty set and no links; with one to four words the whole sequence is the set.
Rows with the same doc_id are one document of the graph: it has the links of all of them. Rows with a null doc_id take no part
(component_id null, kept). Columns other than those named are not touched.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import ceil, comb, log

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER_AZ, as_table, bounded_batches, enter, join_counted, struct_of_all, text_bytes
from .components import components
from .hashing import mixed, run_hashes, word_hashes

SHINGLE = 5
BANDS, ROWS = 32, 7
#: Values of the signature: those in bands, and more that only the comparison uses.
VALUES = 416
PERCENT = 85
MISS = 1e-5
BATCH = 32
BLOCK = 8192
PARTNERS = (4, 64, None)
CHUNK = 1 << 15

_random = np.random.default_rng(20240229)
FACTORS = _random.integers(1, 1 << 63, VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BAND_SEEDS = [int(x) for x in _random.integers(1, 1 << 62, VALUES // ROWS)]

SETS = "doc_id long, n_shingles long, h1 long, h2 long, sketch binary, bands array<long>"


def bands_for(percent: int) -> int:
    """The number of bands with which a pair at the threshold misses all with the chance that BANDS have at PERCENT."""
    if percent == PERCENT:
        return BANDS
    bands = ceil(BANDS * log(1 - (PERCENT / 100) ** ROWS) / log(1 - (percent / 100) ** ROWS)) if percent < 100 else 1
    if bands > len(BAND_SEEDS):
        raise ValueError(f"{percent} % takes {bands} bands; the signature has values for {len(BAND_SEEDS)}")
    return bands


def shingle_set(text: bytes | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.translate(LOWER_AZ).split() if text else []
    return np.unique(run_hashes(word_hashes(words), min(shingle, max(1, len(words)))))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """MinHash signatures (uint64) of non-empty sets, in chunks that stay in the cache."""
    out, i = np.empty((len(sets), len(FACTORS)), np.uint64), 0
    while i < len(sets):
        j, total = i, 0
        while j < len(sets) and (j == i or total + len(sets[j]) <= CHUNK):
            total += len(sets[j])
            j += 1
        x, starts = np.concatenate(sets[i:j]), np.cumsum([0, *(len(s) for s in sets[i : j - 1])])
        for k, f in enumerate(FACTORS):
            out[i:j, k] = np.minimum.reduceat(x * f, starts)
        i = j
    return out


def sketch(docs: DataFrame, n_bands: int = BANDS) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("words")
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), 256):
                sets = [shingle_set(t) for t in texts[at : at + 256]]
                full = [i for i, s in enumerate(sets) if len(s)]
                signs = signatures([sets[i] for i in full])
                bands = np.zeros((len(full), n_bands), np.uint64)
                for b, seed in enumerate(BAND_SEEDS[:n_bands]):
                    bands[:, b] = mixed(run_hashes_of_rows(signs[:, b * ROWS : (b + 1) * ROWS]), seed)
                small = mixed(signs, 7).astype(np.uint8)  # eight bits of each value
                rows = dict(zip(full, range(len(full)), strict=True))
                digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                halves = [np.frombuffer(d, np.int64).tolist() if d else (None, None) for d in digests]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids[at : at + 256], pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([h[0] for h in halves], pa.int64()),
                        pa.array([h[1] for h in halves], pa.int64()),
                        pa.array([small[rows[i]].tobytes() if i in rows else None for i in range(len(sets))], pa.binary()),
                        pa.array([bands[rows[i]].view(np.int64) if i in rows else None for i in range(len(sets))], pa.list_(pa.int64())),
                    ],
                    names=["doc_id", "n_shingles", "h1", "h2", "sketch", "bands"],
                )

    return docs.select(F.col("doc_id").cast("long"), text_bytes("text").alias("text")).mapInArrow(run, SETS)


def run_hashes_of_rows(m: np.ndarray) -> np.ndarray:
    """A hash of each row of a matrix."""
    h = np.zeros(len(m), np.uint64)
    for k in range(m.shape[1]):
        h = mixed(h ^ m[:, k], k + 1)
    return h


@cache
def least_equal(size: int, percent: int = PERCENT, miss: float = MISS) -> tuple[int, ...]:
    """For each batch: the least number of equal values so far with which P(similarity >= threshold) >= miss.

    That posterior is the chance that a binomial of n + 1 draws at the threshold has at most m successes."""
    t, out = percent / 100, []
    for n in range(BATCH, size + 1, BATCH):
        total, m = 0.0, -1
        while total < miss:
            m += 1
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return tuple(out)


def survivors(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of signature rows: which survive all batches, and their numbers of equal values."""
    alive, equal = np.arange(len(a)), np.zeros(len(a), np.int32)
    for i, least in enumerate(least_equal(a.shape[1], percent)):
        part = slice(i * BATCH, (i + 1) * BATCH)
        equal[alive] += (a[alive, part] == b[alive, part]).sum(axis=1, dtype=np.int32)
        alive = alive[equal[alive] >= least]
    return alive, equal[alive]


def as_matrix(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def compare(pairs: DataFrame, sketches: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b, equal of the pairs that survive the sequential comparison. One sketch is looked up per pair and side."""
    x, y = (sketches.select(F.col("node").alias(n), F.col("size").alias("size_" + n), F.col("sketch").alias(side)) for n, side in (("a", "left"), ("b", "right")))
    both = pairs.join(x, "a").join(y, "b").where(100 * F.least("size_a", "size_b") >= percent * F.greatest("size_a", "size_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                alive, equal = survivors(as_matrix(batch.column(2), len(FACTORS)), as_matrix(batch.column(3), len(FACTORS)), percent)
                kept = batch.take(pa.array(alive))
                yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array(equal)], names=["a", "b", "equal"])

    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long, equal int")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    both = pairs.select("a", "b").join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("left")), "a").join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("right")), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(left.as_buffer(), np.uint64), np.frombuffer(right.as_buffer(), np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * shared >= percent * (len(x) + len(y) - shared))
            kept = batch.filter(pa.array(good, pa.bool_()))
            yield pa.RecordBatch.from_arrays(kept.columns[:2], names=["a", "b"])

    return both.select("a", "b", "left", "right").mapInArrow(run, "a long, b long").distinct()


def across(partners: int | None, percent: int = PERCENT):
    """Survivors between different components of two blocks of a bucket; per member and other component the best `partners`. If there are
    more, a row without a pair names the blocks.

    Whether a pair shares an earlier band is decided from the bands' keys, by which the buckets are made. The sketches would not do:
    in a near-duplicate pair six of a band's seven values are often equal, and the seventh's byte agrees by chance with 1/256."""

    def run(group: pa.Table) -> pa.Table:
        node, comp, half, size = (group[c].to_numpy() for c in ("node", "component", "half", "size"))
        signs = as_matrix(group["sketch"], len(FACTORS))
        keys = group["bands"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        names, sizes = np.unique(comp, return_counts=True)
        most = names[sizes.argmax()]
        same, band = group["i"][0] == group["j"][0], group["band"][0].as_py()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        least = least_equal(len(FACTORS), percent)
        # Members of the most common component need no row of their own: their partners' rows meet them.
        rows, held_back = np.flatnonzero(comp != most), False
        for r in rows:
            other = (comp != comp[r]) & ((comp == most) | (node > node[r])) if same else (comp != comp[r]) & (half != half[r]) & ((comp == most) | (node > node[r]))
            other &= (100 * np.minimum(size, size[r]) >= percent * np.maximum(size, size[r]))  # sets of other sizes can't be similar enough
            alive = np.flatnonzero(other)
            equal = np.zeros(len(alive), np.int32)
            for i, m in enumerate(least):
                part = slice(i * BATCH, (i + 1) * BATCH)
                equal = equal + (signs[alive, part] == signs[r, part]).sum(axis=1, dtype=np.int32)
                stay = equal >= m
                alive, equal = alive[stay], equal[stay]
                if not len(alive):
                    break
            if len(alive):  # a pair that shares several bands leaves the first one's bucket only
                first = (keys[alive] == keys[r]).argmax(axis=1) == band
                alive, equal = alive[first], equal[first]
            if len(alive) and partners is not None:
                order = np.lexsort((-equal, comp[alive]))
                alive, equal = alive[order], equal[order]
                begins = np.flatnonzero(np.r_[True, comp[alive][1:] != comp[alive][:-1]])
                nth = np.arange(len(alive)) - np.repeat(begins, np.diff(np.r_[begins, len(alive)]))
                held_back |= bool((nth >= partners).any())
                alive, equal = alive[nth < partners], equal[nth < partners]
            if len(alive):
                found.append((np.minimum(node[r], node[alive]), np.maximum(node[r], node[alive]), equal))
        a, b, equal = (np.concatenate(x) for x in zip(*found, strict=True)) if found else [np.empty(0, np.int64)] * 3
        pairs = pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "equal": pa.array(equal, pa.int32())})
        rest = group.slice(0, int(held_back)).select(["key", "i", "j"])
        return pa.concat_tables([pairs, rest], promote_options="default").select(["a", "b", "equal", "key", "i", "j"])

    return run


def cross_pairs(members: DataFrame, nodes: DataFrame, labels: DataFrame, partners: int | None, block: int, percent: int = PERCENT, only: DataFrame | None = None) -> DataFrame:
    """a, b, equal: surviving pairs of different components that share a bucket; and key, i, j, without a pair: blocks of a bucket in which
    partners were kept back. only: such blocks; no others are compared."""
    held = members.join(labels, "node", "left").select("key", "band", "node", F.coalesce("component", "node").alias("component"))
    mixed_buckets = held.groupBy("key").agg(F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    held = held.join(mixed_buckets.select("key", F.ceil(F.col("n") / block).cast("int").alias("blocks")), "key")
    if only is not None:
        held = held.join(only.select("key").distinct(), "key", "left_semi")
    held = held.join(nodes, "node")
    held = held.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = held.select("key", "band", "node", "component", "size", "sketch", "bands", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), (F.col("own") > F.col("other")).cast("int").alias("half"))
    if only is not None:
        dealt = dealt.join(only, ["key", "i", "j"], "left_semi").select(*dealt.columns)
    return dealt.groupBy("key", "i", "j").applyInArrow(across(partners, percent), "a long, b long, equal int, key long, i int, j int")


def link(docs: DataFrame, *, block: int = BLOCK, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(documents: doc_id, n_shingles, node; labels: node, component for nodes with links)."""
    bounded_batches(docs.sparkSession)
    rows = as_table(sketch(docs, bands_for(percent)), "sketches")
    held = rows.where("doc_id is not null and h1 is not null")
    # Tables of their own: the joins back may then split a set, or a bucket, that very many documents have.
    equal = as_table(held.groupBy("h1", "h2").agg(F.min("doc_id").alias("node")), "equal")
    documents = as_table(rows.select("doc_id", "n_shingles", "h1", "h2").join(equal, ["h1", "h2"], "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("node")).alias("node"), "h1"), "nodes")
    nodes = held.join(documents.where("doc_id = node").select("doc_id", "h1").distinct(), ["doc_id", "h1"], "left_semi").dropDuplicates(["doc_id", "h1"]).select(F.col("doc_id").alias("node"), F.col("n_shingles").alias("size"), "sketch", "bands")
    nodes = as_table(nodes, "signatures")
    sketches = nodes.select("node", "size", "sketch")

    dealt = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    leaders = dealt.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")).where("leader < last").select("key", "leader")
    members = as_table(join_counted(dealt, as_table(leaders, "leaders"), ["key"], "inner"), "buckets")

    wanted = as_table(members.select(F.col("node").alias("doc_id")).distinct(), "wanted")
    texts = docs.select(F.col("doc_id").cast("long"), text_bytes("text").alias("text"))
    sets = as_table(full_sets(once_each(join_counted(texts, wanted, ["doc_id"], "left_semi"), documents)), "sets")

    star = as_table(compare(members.where("node > leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), sketches, percent), "pairs")
    best = Window.partitionBy("b").orderBy(F.desc("equal"), "a")  # at most one row per band and member
    first = star.withColumn("nth", F.row_number().over(best)).where("nth = 1").select("a", "b")
    several = documents.where("node is not null").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("last")).where("a < last")
    same_id = several.select("doc_id", "a").join(documents.select("doc_id", F.col("node").alias("b")), "doc_id").where("a < b").select("a", "b").distinct()
    links = as_table(confirm(first, sets, percent).select("a", "b").union(same_id.select("a", "b")), "links")
    tested, only = first, None
    labels = as_table(components(links), "labels")
    for partners in (0, *PARTNERS):
        if partners == 0:
            pairs = star.select("a", "b")
        else:
            found = as_table(cross_pairs(members, nodes, labels, partners, block, percent, only), "across")
            pairs, only = found.where("a is not null").select("a", "b").distinct(), found.where("a is null").select("key", "i", "j")
        pairs = as_table(open_pairs(pairs, labels).join(tested, ["a", "b"], "left_anti"), "pairs")
        if not pairs.isEmpty():
            new = as_table(confirm(pairs, sets, percent), "links")
            tested = tested.union(pairs)
            if not new.isEmpty():
                links = links.union(new)
                labels = as_table(components(links), "labels")
        if only is not None and only.isEmpty():
            break
    return documents, labels


def open_pairs(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs whose ends aren't in one component yet."""
    x, y = (labels.select(F.col("node").alias(n), F.col("component").alias("c" + n)) for n in ("a", "b"))
    return pairs.join(x, "a", "left").join(y, "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def once_each(texts: DataFrame, documents: DataFrame) -> DataFrame:
    """Each text of an id once, so that n repeated rows and m of a partner don't meet n * m times. Only ids on several rows are shuffled."""
    repeated = as_table(documents.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id"), "repeated")
    if repeated.isEmpty():
        return texts
    single = join_counted(texts, repeated, ["doc_id"], "left_anti")
    return single.union(join_counted(texts, repeated, ["doc_id"], "left_semi").withColumn("h", F.xxhash64("text")).dropDuplicates(["doc_id", "h"]).select("doc_id", "text"))


def full_sets(docs: DataFrame) -> DataFrame:
    """node and its sorted shingle hashes (uint64 bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter("words")
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for at in range(0, len(ids), 512):
                yield pa.RecordBatch.from_arrays([pa.array(ids[at : at + 512], pa.int64()), pa.array([shingle_set(t).tobytes() for t in texts[at : at + 512]], pa.binary())], names=["node", "shingles"])

    return docs.select("doc_id", "text").mapInArrow(run, "node long, shingles binary")


def near_duplicates(docs: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per row of docs."""
    documents, labels = link(docs, percent=percent)
    out = documents.join(labels, "node", "left").select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "node", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, *, percent: int = PERCENT) -> DataFrame:
    """The rows of docs that stay: one document of each group, columns unchanged."""
    gone = as_table(near_duplicates(docs, percent=percent).where("not kept").select(F.col("doc_id").alias("id")).distinct(), "gone")
    rows = docs.select(struct_of_all(docs).alias("row"), F.col("doc_id").cast("long").alias("id"))
    return join_counted(rows, gone, ["id"], "left_anti").select("row.*")
