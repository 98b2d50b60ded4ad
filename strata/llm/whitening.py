"""Embedding whitening over the distinct vectors, each weighted by how often it occurs.

Entries are fixed to integers, x = floor(scale * entry) + shift, so equal vectors are
found exactly: they are grouped with their counts, and all that follows works on a
group once.

* **Fit.**  A group weighs its count (``weights="counts"``) or one (``"one"``).  The
  sums of all dimensions are taken exactly, in integers.  Vectors are then centred
  before anything is multiplied (the shift is much larger than the spread): x - S/n is
  the difference from the whole part of the mean, less the rest.  Each task forms the
  weighted product of its centred block, dims x dims in one matrix product, and only
  those partial matrices are shuffled and summed.
* **Components** are unit eigenvectors of the covariance (divisor n), by falling
  eigenvalue; the entry of greatest size is positive.  The driver holds this one
  matrix of dims x dims, whatever the number of rows.
* **Whitening.**  Each distinct vector is centred, projected and divided by the square
  roots of the eigenvalues once, and joined back to its rows.  Groups that hold more
  than one in ``HOT_SHARE`` of all rows are at most that many, so they are
  broadcast; the others are joined by shuffling, and none of those is large.

Defined cases: rows whose vector is null, has no entry, or has a null or non-finite
entry are dropped, and so are those with fewer entries than the longest kept vector
(what it lacks counts as null).  An empty table gives an empty result, of the same
columns.  Equal vectors get equal results; repeated rows stay.  A component
without variance (eigenvalue under ``TINY`` of the greatest) cannot be whitened: its
``whitened`` is null, and the identity check leaves it out.  An entry whose x is
beyond 2^53 fails the job.  ``deviation`` is exact, up to 38 digits.  Other columns
pass through, and the result's own names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import stored, workers_import
from strata.llm.hot_groups import HOT_SHARE, join_groups

#: Of the greatest eigenvalue: what lies below is rounding, not variance.
TINY = 1e-13
#: x and all differences stay exact in doubles below this.
EXACT = 1 << 53
ADDED = ("component", "n", "deviation", "whitened", "explained", "identity_error")


def fixed(vector: str, scale: int, shift: int) -> Column:
    """The vector as integers; null if it has no entry, or one that is null or not finite."""
    good = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(vector, lambda c: F.floor(F.lit(scale) * c.cast("double")) + F.lit(shift))
    return F.when((F.size(vector) > 0) & good, x)


def distinct_vectors(rows: DataFrame, x: str = "x") -> DataFrame:
    """Distinct vectors with their counts: ``x``, ``count``, written once."""
    return stored(rows.groupBy(x).agg(F.count(F.lit(1)).alias("count")), "vectors")


@dataclass
class Whitening:
    """A fitted whitening: n, sums S, components by row, their eigenvalues, and the trace of the covariance."""
    n: int
    sums: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def alive(self) -> np.ndarray:
        """Components that have variance."""
        return self.eigenvalues > TINY * max(self.eigenvalues[0], 0.0) if len(self.eigenvalues) else np.zeros(0, bool)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _blocks(batches: Iterator[pa.RecordBatch], dims: int, weights: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(vectors, weights) of each batch; weights are the counts, or ones."""
    for batch in batches:
        if batch.num_rows:
            w = batch.column(1).to_numpy(zero_copy_only=False)
            yield _matrix(batch.column(0), dims), w if weights == "counts" else np.ones_like(w)


def _sums(vectors: DataFrame, dims: int, weights: str) -> list[int]:
    """Weighted sum of each dimension, exactly."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dims
        for x, w in _blocks(batches, dims, weights):
            if int(np.abs(x).max()) * int(w.sum()) < 1 << 62:
                part = (w @ x).tolist()
            else:
                part = (w.astype(object) @ x.astype(object)).tolist()
            total = [a + b for a, b in zip(total, part)]
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(dims), pa.int32()),
                                          "s": pa.array(map(Decimal, total), pa.decimal128(38, 0))})

    parts = vectors.select("x", "count").mapInArrow(partial, "i int, s decimal(38,0)")
    found = {r["i"]: int(r["s"]) for r in parts.groupBy("i").agg(F.sum("s").cast("decimal(38,0)").alias("s")).collect()}
    return [found[i] for i in range(dims)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - S/n, by the whole and the remaining part of the mean."""
    whole, rest = np.array([s // n for s in sums], np.int64), np.array([s % n / n for s in sums])
    return (x - whole) - rest


def _products(vectors: DataFrame, columns: list[str], width: int, block) -> np.ndarray:
    """Sum over all rows of block(batch)'s weighted product, width x width: partial matrices per task, summed by entry."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                y, w = block(batch)
                total += (y * w[:, None]).T @ y
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(width * width), pa.int32()), "v": pa.array(total.ravel(), pa.float64())})

    parts = vectors.select(*columns).mapInArrow(partial, "i int, v double")
    out = np.zeros(width * width)
    for r in parts.groupBy("i").agg(F.sum("v").alias("v")).collect():
        out[r["i"]] = r["v"]
    return out.reshape(width, width)


def fit(vectors: DataFrame, weights: str = "counts") -> Whitening:
    """The whitening of stored distinct ``vectors`` (x, count)."""
    if weights not in ("counts", "one"):
        raise ValueError("weights must be 'counts' or 'one'")
    workers_import(vectors.sparkSession)
    size = F.col("count") if weights == "counts" else F.lit(1).cast("long")
    n, dims, most = vectors.agg(F.sum(size), F.max(F.size("x")), F.max(F.array_max(F.transform("x", F.abs)))).first()
    if not n:
        return Whitening(0, [], np.zeros((0, 0)), np.zeros(0), 0.0)
    if most >= EXACT:
        raise ValueError(f"an entry of size {most} is too large to be exact")
    sums = _sums(vectors, dims, weights)

    def block(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        w = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        return centred(_matrix(batch.column(0), dims), n, sums), w if weights == "counts" else np.ones_like(w)

    covariance = _products(vectors, ["x", "count"], dims, block) / n
    values, directions = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(-values, kind="stable")
    components = directions.T[order]
    largest = np.abs(components).argmax(1)
    components *= np.where(components[np.arange(dims), largest] < 0, -1.0, 1.0)[:, None]
    return Whitening(int(n), sums, components, np.maximum(values[order], 0.0), float(np.trace(covariance)))


def whiten(vectors: DataFrame, model: Whitening, k: int) -> DataFrame:
    """Each distinct vector with ``deviation`` and ``whitened``, the values of the first k components, written once."""
    n, sums, alive = model.n, model.sums, model.alive[:k]
    dims = len(sums)
    scaled = model.components[:k][alive] / np.sqrt(model.eigenvalues[:k][alive])[:, None]
    width = len(alive)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = np.array([s // n for s in sums], np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            values = np.full((len(x), width), np.nan)
            values[:, alive] = centred(x, n, sums) @ scaled.T
            if len(x) and (int(np.abs(x - low).max()) + 1) ** 2 * n * n * dims < 1 << 62:
                # n * x - S = n * (x - low) - (S - n * low), both small
                deviation = ((n * (x - low) - np.array([s % n for s in sums], np.int64)) ** 2).sum(1).tolist()
            else:
                deviation = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
            flat = pa.array(values.ravel(), pa.float64(), from_pandas=True)  # NaN: null
            yield pa.RecordBatch.from_arrays([
                batch.column(0), batch.column(1), pa.array(map(Decimal, deviation), pa.decimal128(38, 0)),
                pa.ListArray.from_arrays(pa.array(range(0, len(x) * width + 1, width), pa.int32()), flat)],
                names=["x", "count", "deviation", "whitened"])

    return stored(vectors.select("x", "count").mapInArrow(
        project, "x array<bigint>, count bigint, deviation decimal(38,0), whitened array<double>"), "whitened")


def identity_error(whitened: DataFrame, model: Whitening, k: int, weights: str = "counts") -> float:
    """Largest entry of the whitened values' covariance minus the identity, over the components that have variance."""
    alive = np.flatnonzero(model.alive[:k])
    if not len(alive):
        return 0.0
    width = len(model.eigenvalues[:k])

    def block(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        w = batch.column(1).to_numpy(zero_copy_only=False).astype(float)
        return _matrix(batch.column(0).cast(pa.list_(pa.float64())), width)[:, alive], w if weights == "counts" else np.ones_like(w)

    products = _products(whitened, ["whitened", "count"], len(alive), block) / model.n
    return float(np.abs(products - np.eye(len(alive))).max())


def transform(docs: DataFrame, vector: str = "embedding", k: int = 32, weights: str = "counts",
              scale: int = 64, shift: int = 1_000_000) -> DataFrame:
    """A row of ``docs`` and component up to ``k``: component, n, deviation, whitened, explained, identity_error."""
    kept = [c for c in docs.columns if c not in ADDED]
    rows = docs.select(F.struct(*kept).alias("_doc"), fixed(vector, scale, shift).alias("x")).where("x is not null")
    groups = distinct_vectors(rows)
    dims = groups.agg(F.max(F.size("x"))).first()[0]
    if dims is None:
        return docs.limit(0).select(*kept, F.lit(0).alias("component"), F.lit(0).cast("long").alias("n"),
                                    F.lit(0).cast("decimal(38,0)").alias("deviation"),
                                    *[F.lit(0.0).alias(c) for c in ("whitened", "explained", "identity_error")])
    groups = groups.where(F.size("x") == dims)
    model = fit(groups, weights)
    found = whiten(groups, model, k)
    error = identity_error(found, model, k, weights)
    share = model.eigenvalues / model.trace if model.trace > 0 else np.full(dims, np.nan)
    explained = F.array(*[F.lit(float(v)) if v == v else F.lit(None).cast("double") for v in share[:k]])
    joined = join_groups(rows, found, "x", "count", ["deviation", "whitened"])
    each = joined.select("_doc", "deviation", F.posexplode("whitened").alias("_i", "whitened"))
    return each.select(
        *[f"_doc.{c}" for c in kept], (F.col("_i") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", "whitened", F.get(explained, F.col("_i")).alias("explained"), F.lit(error).alias("identity_error"))
