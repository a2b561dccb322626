"""Whitening of embedding vectors by their principal components.

Vectors become whole numbers x = floor(scale * c). The model is fitted on each distinct x once: exact sums by dimension, then one
aggregation whose expressions are generated, one for each pair of the covariance matrix's upper triangle, sum((x_i - m_i) * (x_j - m_j)).
Only those d * (d + 1) / 2 numbers reach the driver, which assembles the matrix and decomposes it by LAPACK. The rows are then projected
where they are, with the model as constants in the plan; no join. Beyond PAIRS_AT_ONCE pairs (90 dimensions) the triangle is summed
in several aggregations of that many.

Cases: rows whose vector is null or holds null or non-finite entries are dropped; a null id stays null. Repeated rows come out as often
as they are there and count once in the fit. Vectors of another length have a model of their own; vectors of no entries have no
components, so no rows. A component without variance (one distinct vector, or fewer directions than components) has a null `whitened`
and explains 0; identity_error is then taken over the others, 0.0 if there are none. A deviation beyond 64 bits is null. Other columns are
not looked at. An empty table gives an empty result."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from itertools import combinations_with_replacement, islice

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_table

SCALE = 256.0
COMPONENTS = 4
PAIRS_AT_ONCE = 4096
#: Components with less than this share of the trace, by dimension, are rounding only.
NO_VARIANCE = np.finfo(float).eps
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def quantised(embeddings: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: float = SCALE) -> DataFrame:
    """id and x, for rows that take part."""
    v = F.col(vector_col)
    real = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    return embeddings.where(v.isNotNull() & F.forall(v, real)).select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda c: F.floor(F.lit(scale) * c.cast("double"))).alias("x"))


def in_blocks(pairs: Iterator[tuple[int, int]], size: int) -> Iterator[list[tuple[int, int]]]:
    while block := list(islice(pairs, size)):
        yield block


def covariance(rows: DataFrame, columns: list[Column], means: list[float], n: int, at_once: int = PAIRS_AT_ONCE) -> np.ndarray:
    """The covariance (divisor n) of double columns whose means are known. Entries are centred in a projection, and the sums of the upper
    triangle's products are one aggregation's expressions."""
    centred = rows.select(*((c - F.lit(m)).alias(f"c{i}") for i, (c, m) in enumerate(zip(columns, means, strict=True))))
    out = np.zeros((len(columns), len(columns)))
    for block in in_blocks(combinations_with_replacement(range(len(columns)), 2), at_once):
        sums = centred.agg(*(F.expr(f"sum(c{i} * c{j}) AS s{i}_{j}") for i, j in block)).first()
        for (i, j), s in zip(block, sums, strict=True):
            out[i, j] = out[j, i] = s / n
    return out


@dataclass(frozen=True)
class Model:
    """Of vectors of one length: how many were fitted, their sums, unit components in rows with their variances, and the total variance."""

    n: int
    sums: list[int]
    largest: int
    components: np.ndarray
    variances: np.ndarray
    trace: float

    @property
    def means(self) -> list[float]:
        return [s / self.n for s in self.sums]

    def has_variance(self, k: int) -> bool:
        return bool(self.variances[k] > self.trace * NO_VARIANCE * len(self.sums))

    def deviation(self, x: Column) -> Column:
        """Sum of (n * x - S)^2: in 64 bits if nothing fitted can leave them, else in 38 digits."""
        most = self.n * self.largest + max(map(abs, self.sums))
        if len(self.sums) * most * most < 1 << 63:
            off = F.zip_with(x, F.array(*map(F.lit, self.sums)), lambda c, s: F.lit(self.n) * c - s)
            return F.aggregate(off, F.lit(0).cast("long"), lambda a, o: a + o * o)
        wide = lambda k: F.lit(Decimal(k)).cast("decimal(38,0)")
        off = F.zip_with(x, F.array(*map(wide, self.sums)), lambda c, s: F.try_subtract(F.try_multiply(c.cast("decimal(38,0)"), wide(self.n)), s).cast("decimal(38,0)"))
        square = lambda o: F.try_multiply(o, o).cast("decimal(38,0)")
        return F.aggregate(off, wide(0), lambda a, o: F.try_add(a, square(o)).cast("decimal(38,0)")).try_cast("long")

    def whitened(self, x: Column, k: int) -> Column:
        """The k-th coordinate, in units of its deviation."""
        if not self.has_variance(k):
            return F.lit(None).cast("double")
        weights = self.components[k] / np.sqrt(self.variances[k])
        centred = F.zip_with(x, F.array(*map(F.lit, self.means)), lambda c, m: c - m)
        return F.aggregate(F.zip_with(centred, F.array(*(F.lit(float(w)) for w in weights)), lambda c, w: c * w), F.lit(0.0), lambda a, p: a + p)

    def explained(self, k: int) -> float:
        return float(self.variances[k] / self.trace) if self.has_variance(k) else 0.0


def fit_one(vectors: DataFrame, size: int, n: int, at_once: int = PAIRS_AT_ONCE) -> Model:
    """The model of n vectors x, all of one length."""
    places = range(size)
    *sums, high, low = vectors.agg(*(F.sum(F.col("x")[i].cast("decimal(19,0)")) for i in places), F.max(F.array_max("x")), F.min(F.array_min("x"))).first()
    sums = list(map(int, sums))
    v = covariance(vectors, [F.col("x")[i].cast("double") for i in places], [s / n for s in sums], n, at_once)
    variances, components = np.linalg.eigh(v)
    return Model(n, sums, max(abs(high), abs(low)), components.T[::-1], np.maximum(variances[::-1], 0.0), float(np.trace(v)))


def fit(vectors: DataFrame, at_once: int = PAIRS_AT_ONCE) -> tuple[DataFrame, dict[int, Model]]:
    """The list of distinct x, as a table, and a model for each length."""
    distinct = as_table(vectors.where(F.size("x") > 0).select("x").distinct(), "vectors")
    sizes = distinct.groupBy(F.size("x")).count().collect()  # a row for each length
    return distinct, {size: fit_one(distinct.where(F.size("x") == size), size, n, at_once) for size, n in sorted(sizes)}


def identity_error(vectors: DataFrame, model: Model, components: int) -> float:
    """The largest entry of the fitted vectors' whitened covariance less the identity, measured on them."""
    real = [k for k in range(components) if model.has_variance(k)]
    if not real:
        return 0.0
    rows = vectors.select(*(model.whitened(F.col("x"), k).alias(f"w{k}") for k in real))
    means = rows.agg(*(F.avg(f"w{k}") for k in real)).first()
    found = covariance(rows, [F.col(f"w{k}") for k in real], list(means), model.n)
    return float(np.abs(found - np.eye(len(real))).max())


def whiten(embeddings: DataFrame, components: int = COMPONENTS, *, scale: float = SCALE, at_once: int = PAIRS_AT_ONCE) -> DataFrame:
    """A row for each row that takes part and each of the first components: RESULT."""
    rows = quantised(embeddings, scale=scale)
    distinct, models = fit(rows, at_once)
    out = None
    for size, model in models.items():
        own = rows.where(F.size("x") == size)
        count = min(components, size)
        error = identity_error(distinct.where(F.size("x") == size), model, count)
        made = own.select("id", model.deviation(F.col("x")).alias("deviation"), F.posexplode(F.array(*(F.struct(model.whitened(F.col("x"), k).alias("whitened"), F.lit(model.explained(k)).alias("explained")) for k in range(count)))).alias("place", "c"))
        made = made.select(F.col("id").alias("vec_id"), (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "c.whitened", "c.explained", F.lit(error).alias("identity_error"))
        out = made if out is None else out.unionByName(made)
    return embeddings.sparkSession.createDataFrame([], RESULT) if out is None else out
