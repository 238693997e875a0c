"""Whitening of embeddings by a weighted covariance over their distinct vectors.

A vector's entries become whole numbers x. Identical x vectors are grouped, and their counts,
or one for each, are the weights of the fit. Every sum runs over the distinct vectors only: the
weighted sums per dimension, exact; then, with the mean taken off first, the weighted products
of all pairs of dimensions, a matrix product per Arrow batch that tasks add up. What reaches
the driver has a row for each pair of dimensions, whatever the input. Each distinct vector is
whitened once, and the result is joined back to the rows by x. That join reads both sides
straight from their exchange, and a vector has one row on one of them, so adaptive execution
splits the partition of a vector that very many rows hold.

Rows are dropped whose vector is null, or holds null or non-finite entries, or entries whose x
does not fit 62 bits, or has another length than most vectors have (of equally common
lengths the larger). Null ids stay, repeated rows each count and each return. Components
without variance (below ``LEAST_SHARE`` of the largest) have no whitened value: null. A deviation
beyond 63 bits is null. An empty table, or one of empty vectors, gives no rows. Further columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.llm import common
from kindred.session import stage

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
LEAST_SHARE = 1e-12
HALF = 31  # bits of a whole number that are summed apart from the rest, so that sums fit

COUNTS, ONES = "counts", "ones"


@dataclass(frozen=True)
class Whitening:
    """A fit: ``floor`` and ``rest`` make the mean (floor + rest / n, exact), components are
    columns, by falling eigenvalue."""

    n: int
    floor: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    components: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.floor).astype(np.float64) - self.rest.astype(np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.centred(x) @ self.components) / np.sqrt(self.values)

    @property
    def usable(self) -> int:
        """Components with variance: the others divide by nothing."""
        return int((self.values > LEAST_SHARE * max(self.values[:1], default=0)).sum())

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum over dimensions of (n x - S)^2, exact."""
        off = x - self.floor
        if len(off) and len(self.floor) * ((int(np.abs(off).max()) + 1) * self.n) ** 2 < 1 << 63:
            return ((off * self.n - self.rest) ** 2).sum(1).tolist()
        rest = self.rest.tolist()
        found = [sum((v * self.n - r) ** 2 for v, r in zip(row, rest)) for row in off.tolist()]
        return [v if v < 1 << 63 else None for v in found]


def whole_numbers(vector: Column, scale: int = SCALE, shift: int = SHIFT) -> Column:
    """floor(scale * entry) + shift for every entry; null if an entry has none."""
    limit = float(1 << 61)
    fits = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double") * scale) < limit))
    return F.when(fits, F.transform(vector, lambda c: F.floor(c.cast("double") * scale) + shift))


def numbered(rows: DataFrame, vector: str = "embedding", key: str = "vec_id") -> tuple[DataFrame, int]:
    """``(key, x)`` of the rows that stay, and the number of dimensions."""
    x = rows.select(F.col(key).cast("long").alias(key), whole_numbers(F.col(vector)).alias("x")).where("x IS NOT NULL")
    lengths = x.groupBy(F.size("x").alias("dims")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    dims = most[0]["dims"] if most else 0
    return x.where(F.size("x") == dims) if dims else x.limit(0), dims


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(distinct: DataFrame, dims: int) -> tuple[int, list[int]]:
    """The weights' total and the weighted sums per dimension, as whole numbers of any size."""

    def run(batches):
        high, low, total = np.zeros(dims, object), np.zeros(dims, object), 0
        for batch in batches:
            x, w = matrix(batch.column("x"), dims), batch.column("weight").to_numpy()
            high += w @ (x >> HALF)
            low += w @ (x & ((1 << HALF) - 1))
            total += int(w.sum())
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims + 1), pa.int32())]
            + [pa.array(list(map(int, [*side, end])), pa.int64()) for side, end in ((high, 0), (low, total))],
            names=["dim", "high", "low"],
        )

    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    found = distinct.mapInArrow(run, "dim int, high long, low long").groupBy("dim").agg(exact("high"), exact("low")).collect()
    sums = {r["dim"]: (int(r["high"]) << HALF) + int(r["low"]) for r in found}
    return sums.pop(dims, 0), [sums.get(k, 0) for k in range(dims)]


def _products(table: DataFrame, dims: int, centred, *columns: str) -> np.ndarray:
    """The weighted sum of products of all pairs of dimensions of ``centred(batch)``."""
    upper = np.triu_indices(dims)

    def run(batches):
        gram = np.zeros((dims, dims))
        for batch in batches:
            c = centred(batch)
            gram += (c * batch.column("weight").to_numpy()[:, None]).T @ c
        yield pa.RecordBatch.from_arrays(
            [pa.array(upper[0], pa.int32()), pa.array(upper[1], pa.int32()), pa.array(gram[upper])], names=["i", "j", "v"]
        )

    parts = table.select("weight", *columns).mapInArrow(run, "i int, j int, v double")
    total = np.zeros((dims, dims))
    for r in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():  # one row for each pair
        total[r["i"], r["j"]] = total[r["j"], r["i"]] = r["v"]
    return total


def distinct_vectors(x: DataFrame, weights: str = COUNTS) -> DataFrame:
    """Every x vector once, with its weight, written once for the passes that read it."""
    weight = F.count("*") if weights == COUNTS else F.first(F.lit(1)).cast("long")
    return stage(x.groupBy("x").agg(weight.alias("weight")), "vectors")


def fit(distinct: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening:
    """Mean, covariance and its largest eigenvalues over weighted distinct vectors."""
    n, sums = _sums(distinct, dims)
    floor = np.array([s // max(n, 1) for s in sums], np.int64)
    rest = np.array([s - n * int(f) for s, f in zip(sums, floor)], np.int64)
    mean = Whitening(max(n, 1), floor, rest, np.empty(0), np.empty((dims, 0)), 0.0)
    covariance = _products(distinct, dims, lambda b: mean.centred(matrix(b.column("x"), dims)), "x") / max(n, 1)
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    chosen = vectors[:, order]
    largest = chosen[np.abs(chosen).argmax(0), np.arange(len(order))]
    signed = chosen * np.where(largest < 0, -1.0, 1.0)
    return Whitening(n, floor, rest, np.maximum(values[order], 0), signed, float(np.trace(covariance)))


def whiten(distinct: DataFrame, dims: int, model: Whitening) -> DataFrame:
    """``distinct`` with ``deviation`` and ``whitened``, the values of all components."""
    kept, usable = len(model.values), model.usable

    def run(batches):
        for batch in batches:
            x = matrix(batch.column("x"), dims)
            z = np.full((len(x), kept), np.nan)
            with np.errstate(divide="ignore", invalid="ignore"):
                z[:, :usable] = model.whitened(x)[:, :usable]
            flat = pa.array(z.reshape(-1), mask=np.isnan(z.reshape(-1)))
            offsets = pa.array(np.arange(len(x) + 1) * kept, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("x"), batch.column("weight"), pa.array(model.deviations(x), pa.int64()),
                    pa.ListArray.from_arrays(offsets, flat),
                ],
                names=["x", "weight", "deviation", "whitened"],
            )

    return distinct.mapInArrow(run, "x array<long>, weight long, deviation long, whitened array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float | None:
    """The largest entry of the whitened values' covariance minus the identity, measured."""
    kept, usable = len(model.values), model.usable
    if not usable:
        return None
    mean = F.sum(F.col("z") * F.col("weight")) / model.n
    sums = whitened.select("weight", F.posexplode(F.slice("whitened", 1, usable)).alias("k", "z")).groupBy("k").agg(mean.alias("m"))
    means = np.zeros(usable)
    for r in sums.collect():  # one row for each component
        means[r["k"]] = r["m"]

    def centred(batch):
        return matrix(batch.column("whitened"), kept)[:, :usable].astype(np.float64) - means

    covariance = _products(whitened, usable, centred, "whitened") / model.n
    return float(np.abs(covariance - np.eye(usable)).max())


def whitened_rows(
    rows: DataFrame, vector: str = "embedding", key: str = "vec_id", weights: str = COUNTS, components: int = COMPONENTS
) -> tuple[DataFrame, Whitening | None, float | None]:
    """``(key, deviation, whitened)`` of the rows that stay, the fit and its identity error."""
    x, dims = numbered(rows, vector, key)
    schema = f"{key} long, deviation long, whitened array<double>"
    if not dims:
        return rows.sparkSession.createDataFrame([], schema), None, None
    distinct = distinct_vectors(x, weights)
    model = fit(distinct, dims, components)
    table = stage(whiten(distinct, dims, model), "whitened")
    joined = x.join(table.select("x", "deviation", "whitened"), "x").select(key, "deviation", "whitened")
    return joined, model, identity_error(table, model)


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    rows, model, error = whitened_rows(common.table(spark, sf_dir, "embeddings"))
    shares = [] if model is None else (model.values / model.trace if model.trace > 0 else np.zeros(len(model.values))).tolist()
    explained = F.array(*map(F.lit, shares)).cast("array<double>")
    return rows.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(0 if model is None else model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("k")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
