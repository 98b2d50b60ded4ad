"""Correlation of many columns from partial Gram matrices.

``stats.corr_matrix`` keeps k(k+1)/2 aggregate buffers, which suits tens of columns.
Here each task adds up k x k products of its rows by matrix multiplication, and what
leaves it is one row per column, with arrays; the JVM sums these by pair of columns.
No plan node holds more than six sums a pair, and a task holds six matrices
of k x k doubles (2 MB for 200 columns, 200 MB for 2,000), whatever the number of rows.

Values are shifted by the column's mean first (by its value if it is constant), so that
nothing is lost to cancellation when a column's spread is small against its size.
Two passes over the columns in all, and a shuffle of tasks x k^2 / 2 sums.

NULL policies are those of ``stats.corr_matrix``: ``zero`` takes NULL as 0, ``pairwise``
uses the rows where both columns are present.  A pair without variance, or without a
row, gives NULL; NaN in a column gives NaN for its pairs; no rows give NULL throughout.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Doubles of a task's block of rows.
BLOCK = 1 << 21
#: Of the sum of squares about the column's mean: what is left below that is rounding.
NO_VARIANCE = 1e-13
SUMS = ("n", "sx", "sy", "sxx", "syy", "sxy")


def _block(batch: pa.RecordBatch, zero: bool) -> tuple[np.ndarray, np.ndarray]:
    """(values with 0 where absent, where present) of a batch of double columns."""
    values = np.empty((batch.num_rows, batch.num_columns))
    present = np.ones(values.shape, bool)
    for j, column in enumerate(batch.columns):
        if column.null_count:
            present[:, j] = column.is_valid().to_numpy(zero_copy_only=False)
            column = column.fill_null(0.0)
        values[:, j] = column.to_numpy(zero_copy_only=False)
    if zero:
        present[:] = True
    return values, present


def _blocks(batches: Iterator[pa.RecordBatch], k: int, zero: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    rows = max(1, BLOCK // k)
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield _block(batch.slice(start, rows), zero)


def _shifts(columns: DataFrame, k: int, zero: bool) -> np.ndarray:
    """Mean of each column, or its value if it has only one."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, low, high = np.zeros(k), np.zeros(k), np.full(k, np.inf), np.full(k, -np.inf)
        for values, present in _blocks(batches, k, zero):
            n += present.sum(0)
            total += values.sum(0)
            low = np.fmin(low, np.where(present, values, np.inf).min(0))
            high = np.fmax(high, np.where(present, values, -np.inf).max(0))
        yield pa.RecordBatch.from_pydict({"i": pa.array(range(k), pa.int32()), "n": n, "total": total, "low": low, "high": high})

    seen = columns.mapInArrow(partial, "i int, n double, total double, low double, high double").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total"), F.min("low").alias("low"), F.max("high").alias("high"))
    out = np.zeros(k)
    for r in seen.collect():  # a row a column
        if r["n"]:
            mean = r["low"] if r["low"] == r["high"] else r["total"] / r["n"]
            out[r["i"]] = mean if np.isfinite(mean) else 0.0
    return out


def pair_sums(df: DataFrame, cols: Sequence[str], nulls: str = "zero") -> DataFrame:
    """i, j (places in ``cols``, i <= j) and the sums n, sx, sy, sxx, syy, sxy of their shifted values, over the rows that count for the pair."""
    if nulls not in ("zero", "pairwise"):
        raise ValueError("nulls must be 'zero' or 'pairwise'")
    k, zero = len(cols), nulls == "zero"
    columns = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    shifts = _shifts(columns, k, zero)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares, products = (np.zeros((k, k)) for _ in range(4))
        for values, present in _blocks(batches, k, zero):
            x = np.where(present, values - shifts, 0.0)
            products += x.T @ x
            if present.all():  # the sums over a pair's rows are those of the column
                n += len(x)
                sums += x.sum(0)[:, None]
                squares += (x * x).sum(0)[:, None]
            else:
                m = present.astype(float)
                n += m.T @ m
                sums += x.T @ m
                squares += (x * x).T @ m
        of = {"n": n, "sx": sums, "sy": sums.T, "sxx": squares, "syy": squares.T, "sxy": products}
        for i in range(k):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), *[pa.array([of[s][i, i:]]) for s in SUMS]], names=["i", *SUMS])

    parts = columns.mapInArrow(partial, "i int, " + ", ".join(f"{s} array<double>" for s in SUMS))
    each = parts.select("i", F.posexplode(F.arrays_zip(*SUMS)).alias("at", "s")).select("i", (F.col("i") + F.col("at")).alias("j"), "s.*")
    # every pair has a row, also where no task had any
    none = df.sparkSession.range(k).select(F.col("id").cast("int").alias("i")).select(
        "i", F.explode(F.sequence(F.col("i"), F.lit(k - 1))).alias("j"), *[F.lit(0.0).alias(s) for s in SUMS])
    return each.unionByName(none).groupBy("i", "j").agg(*[F.sum(s).alias(s) for s in SUMS])


def corr_matrix(df: DataFrame, cols: Sequence[str], nulls: str = "zero", digits: int | None = None) -> DataFrame:
    """Rows (x, y, r) for all ordered pairs of ``cols``, as ``stats.corr_matrix``."""
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "x string, y string, r double")
    sums = pair_sums(df, cols, nulls)
    spread = lambda s, ss: F.col(ss) - F.try_divide(F.col(s) * F.col(s), F.col("n"))
    alive = lambda s, ss: F.when(F.isnan(ss) | (spread(s, ss) > NO_VARIANCE * F.col(ss)), spread(s, ss))
    r = F.try_divide(F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), F.col("n")),
                     F.sqrt(alive("sx", "sxx")) * F.sqrt(alive("sy", "syy")))
    # rounding can carry a perfect correlation beyond 1; a NaN stays
    r = F.when(r > 1, F.when(F.isnan(r), r).otherwise(F.lit(1.0))).when(r < -1, F.lit(-1.0)).otherwise(r)
    if digits is not None:
        r = F.round(r, digits) + F.lit(0.0)
    names = F.array(*map(F.lit, cols))
    both = F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    pairs = F.when(F.col("i") == F.col("j"), F.slice(both, 1, 1)).otherwise(both)
    return sums.select(r.alias("r"), F.explode(pairs).alias("p")).select(
        F.get(names, F.col("p.i")).alias("x"), F.get(names, F.col("p.j")).alias("y"), "r")
