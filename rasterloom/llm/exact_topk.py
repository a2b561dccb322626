"""Exact top-k search by inner product.

Queries are dealt into blocks and all other rows into shards, both of bounded size. Each row is sent once for every block and each
query once for every shard, so where there are many tiles both grow, up to TILE_BYTES a side. A (block, shard) pair is a tile: the
matrix product of its queries and its rows, computed a few queries at a time, from which each query's k best are selected
without sorting the rest. A query thus leaves k rows per shard; these lists are merged in a tree, `fan_in` lists at a time,
so no task ever holds more than fan_in * k entries of a query.

Vectors are integers; a product is computed in doubles only while the bound max|q| * max|c| * dimension, times the number
of rows for the tie-break, stays under 2**53, else in Python integers. Scores beyond 64 bits are cut to that range.

Cases: rows that are null, hold null or non-finite components, or lack an id take no part. Vectors are compared only with
vectors of their own dimension. A candidate row that is there n times counts n times; a query id on several rows asks once,
with the smallest of its vectors; rows with the query's id are its own and no candidates. Ties go to the smaller id. No
queries or no candidates give an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_table

K = 20
#: Rows of a block and of a shard to begin with. Both are doubled while there are more than TILES tiles and a side's vectors hold in TILE_BYTES.
BLOCK = 4096
SHARD = 8192
TILES = 4096
TILE_BYTES = 32 << 20
#: Scores computed at once.
SCORES = 1 << 20
FAN_IN = 16
EXACT = 1 << 53


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = 64.0) -> DataFrame:
    """id and the vector of floor(scale * x), for rows that take part."""
    v, real = F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & v.isNotNull() & F.forall(v, real)).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"))


def matrix(column: pa.ChunkedArray, n: int) -> np.ndarray:
    flat = pa.chunked_array([c.flatten() for c in column.chunks], pa.int64()).to_numpy()
    return flat.reshape(n, -1) if n else flat.reshape(0, 0)


def largest(m: np.ndarray) -> int:
    """The largest absolute value, as a Python integer."""
    return max(int(m.max(initial=0)), -int(m.min(initial=0)))


def best_of_tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of each query's k best candidates with another id; equal scores go to the smaller id."""
    order = np.argsort(c_ids, kind="stable")
    c_ids, c, n = c_ids[order], c[order], len(order)
    most = largest(q) * largest(c) * max(1, q.shape[1])
    kind = np.float64 if (most + 1) * (n + 1) < EXACT else object
    q, c, place = q.astype(kind), c.astype(kind).T, np.arange(n, dtype=np.int64)[::-1].astype(kind)
    out, step = [], max(1, SCORES // max(1, n))
    for i in range(0, len(q), step):
        own = q_ids[i : i + step]
        score = q[i : i + step] @ c
        key = score * n + place  # unique, and greater for a smaller id at equal scores
        low = -(most + 1) * n
        key[own[:, None] == c_ids[None, :]] = low
        if n > k:
            top = np.argpartition(key, n - k, axis=1)[:, n - k :] if kind is np.float64 else np.argsort(key, axis=1)[:, n - k :]
        else:
            top = np.tile(np.arange(n), (len(own), 1))
        picked = np.take_along_axis(key, top, 1) != low
        rows, columns = np.nonzero(picked)[0], top[picked]
        out.append((own[rows], c_ids[columns], score[rows, columns]))
    if not out:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    ids, found, scores = (np.concatenate(x) for x in zip(*out, strict=True))
    return ids, found, np.array([max(-(1 << 63), min((1 << 63) - 1, int(s))) for s in scores], np.int64) if kind is object else scores.astype(np.int64)


def tile(k: int):
    def run(queries: pa.Table, rows: pa.Table) -> pa.Table:
        made: list[tuple] = []
        rows = rows.rename_columns(["id", "v", "n", "shard", "block"])
        q_size, c_size = (t["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False) if len(t) else np.empty(0, np.int64) for t in (queries, rows))
        node = int(rows["shard"][0].as_py()) if len(rows) else 0
        for size in np.intersect1d(q_size, c_size):
            q, c = queries.filter(pa.array(q_size == size)), rows.filter(pa.array(c_size == size))
            copies = np.minimum(c["n"].to_numpy(), k)  # more than k copies of one row can't all be among the k best
            made.append(best_of_tile(q["id"].to_numpy(), matrix(q["v"], len(q)), np.repeat(c["id"].to_numpy(), copies), np.repeat(matrix(c["v"], len(c)), copies, axis=0), k))
        ids, found, scores = (np.concatenate(x) for x in zip(*made, strict=True)) if made else [np.empty(0, np.int64)] * 3
        return pa.table({"query_id": pa.array(ids, pa.int64()), "vec_id": pa.array(found, pa.int64()), "score": pa.array(scores, pa.int64()), "node": pa.array(np.full(len(ids), node), pa.int64())})

    return run


def merge(lists: DataFrame, k: int, fan_in: int) -> DataFrame:
    """One level of the tree: the k best of fan_in neighbouring lists of each query."""
    up = lists.withColumn("node", F.floor(F.col("node") / fan_in).cast("long"))
    best = Window.partitionBy("query_id", "node").orderBy(F.desc("score"), "vec_id")
    return up.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def tile_sizes(rows: int, queries: int, dimensions: int) -> tuple[int, int]:
    """Rows of a block and of a shard."""
    block, shard = BLOCK, SHARD
    while -(-rows // shard) * -(-queries // block) > TILES and 16 * block * dimensions <= TILE_BYTES:
        block, shard = 2 * block, max(shard, 2 * block)
    return block, shard


def search(vectors: DataFrame, is_query: Column, k: int = K, *, block: int | None = None, shard: int | None = None, fan_in: int = FAN_IN) -> DataFrame:
    """query_id, rank, vec_id, score. vectors: id, v (integers); is_query: a condition on id. block and shard: as tile_sizes has them."""
    rows = as_table(vectors.groupBy("id", "v").agg(F.count("*").alias("n")), "vectors")
    asked = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    n, dimensions = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    many = asked.count()
    sizes = tile_sizes(n, many, dimensions or 0)
    shards, blocks = max(1, -(-n // (shard or sizes[1]))), max(1, -(-many // (block or sizes[0])))
    # Copies of one row count once here; the hash of the id alone would do, the vector spreads ids with many vectors.
    dealt = rows.select(F.col("id").alias("c_id"), F.col("v").alias("c_v"), F.col("n").alias("c_n"), F.pmod(F.xxhash64("id", "v"), F.lit(shards)).alias("c_shard"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("c_block"))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<long>")))
    tiles = asked.groupBy("block", "shard").cogroup(dealt.groupBy("c_block", "c_shard")).applyInArrow(tile(k), "query_id long, vec_id long, score long, node long")
    lists, width = merge(tiles, k, fan_in), -(-shards // fan_in)
    while width > 1:
        lists, width = merge(lists.drop("rank"), k, fan_in), -(-width // fan_in)
    return lists.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def top_k(embeddings: DataFrame) -> DataFrame:
    """The 20 best of every vec_id divisible by 20."""
    return search(quantised(embeddings), F.col("id") % 20 == 0)
