"""Statistics over the gold fact, all as cluster-side aggregations.

* ``corr_matrix``: every pair of a k-column matrix in ONE aggregation (the
  reference issued one job per cell, k^2 jobs), then unpivoted to (x, y, r).
* ``quantiles``: exact linear-interpolated quantiles per group, by one method at
  every size: brackets around the wanted ranks are narrowed with sketches and exact
  counts until a bracket holds few values, and only those are read.
* ``sketch`` / ``merge_sketches``: the mergeable alternative for batches, asked for by an
  explicit argument, with a known rank error.
* ``quantile_bucket``: equal-frequency buckets from such edges, right-closed,
  lowest value included.
* ``box_summary`` / ``median_by_bucket``: quartiles and whiskers per bucket.
* ``log_density``: 2-D histogram (log10 x-bin, y-bin) -> count, in place of a
  scatter plot of collected points.

What reaches the driver is bounded by the number of wanted ranks (buckets x quantiles).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The size-bucket labels of the reference's analysis.
SIZE_LABELS = ["Q1 (smallest)", "Q2", "Q3", "Q4", "Q5 (largest)"]

#: dtype strings the reference's column reflection accepts.  ``decimal``,
#: ``long`` and ``short`` never equal a Spark dtype string (``decimal(18,2)``,
#: ``bigint``, ``smallint``), so decimals are skipped unless asked for.
REFERENCE_NUMERIC_DTYPES = ("int", "bigint", "double", "float", "decimal", "long", "short")

#: Distinct values of a bracket that are read to the driver, and the cuts that narrow a larger one.
BRACKET_VALUES, CUTS = 2_000, 200
#: Parameter of stored quantile sketches: a rank error of 0.13 % in about 100 KB a group.
SKETCH_K = 4000
#: Groups (buckets) that quantiles are asked for at once: their brackets are held by the driver.
MOST_GROUPS = 10_000


def numeric_columns(df: DataFrame, include_decimal: bool = False) -> list[str]:
    out = []
    for name, dtype in df.dtypes:
        if dtype in REFERENCE_NUMERIC_DTYPES:
            out.append(name)
        elif include_decimal and (dtype.startswith("decimal") or dtype in ("smallint", "tinyint")):
            out.append(name)
    return out


def numeric_projection(df: DataFrame, include_decimal: bool = False) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in numeric_columns(df, include_decimal)])


def _pair(x: Column, y: Column, nulls: str) -> tuple[Column, Column]:
    """Two columns as doubles, by the policy for NULLs."""
    x, y = x.cast("double"), y.cast("double")
    if nulls == "zero":
        return F.coalesce(x, F.lit(0.0)), F.coalesce(y, F.lit(0.0))
    if nulls == "pairwise":
        both = x.isNotNull() & y.isNotNull()
        return F.when(both, x), F.when(both, y)
    raise ValueError("nulls must be 'zero' or 'pairwise'")


def _pearson(x: Column, y: Column) -> Column:
    """Pearson r of a ``_pair`` as one aggregate expression; zero variance gives NULL (not an error)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def corr(df: DataFrame, a: str, b: str, nulls: str = "zero", digits: int | None = None) -> DataFrame:
    """One row ``r``: Pearson correlation of two columns.

    ``nulls="zero"`` treats NULL as 0 (the reference's ``DataFrame.stat.corr``);
    ``"pairwise"`` uses the rows where both are present.
    """
    r = _pearson(*_pair(F.col(a), F.col(b), nulls))
    return df.agg((F.round(r, digits) if digits is not None else r).alias("r"))


def corr_matrix(df: DataFrame, cols: Sequence[str], nulls: str = "zero", digits: int | None = None) -> DataFrame:
    """Rows (x, y, r) for all ordered pairs of ``cols``, from a single aggregation.

    Each row is laid out as its k(k+1)/2 pairs, which are aggregated by pair: one small
    aggregate whatever k is.  All pairs side by side would be one of some hundred
    buffers, whose generated code is too large to be compiled.  Beyond some tens of
    columns ``gram.corr_matrix`` is the tool.
    """
    cols = list(cols)
    if not cols:
        return df.sparkSession.createDataFrame([], "x string, y string, r double")
    places = [(i, j) for i in range(len(cols)) for j in range(i, len(cols))]
    laid = F.array(*[F.struct(F.lit(p).alias("p"), *[v.alias(n) for n, v in zip("xy", _pair(F.col(cols[i]), F.col(cols[j]), nulls))])
                     for p, (i, j) in enumerate(places)])
    each = df.select(F.explode(laid).alias("s")).select("s.*")
    # every pair has a row, also without rows; NULLs count for nothing
    none = df.sparkSession.range(len(places)).select(F.col("id").cast("int").alias("p"), *[F.lit(None).cast("double").alias(n) for n in "xy"])
    r = _pearson(F.col("x"), F.col("y"))
    found = each.unionByName(none).groupBy("p").agg((F.round(r, digits) if digits is not None else r).alias("r"))
    both = F.array(*[F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in dict.fromkeys(((cols[i], cols[j]), (cols[j], cols[i])))])
                     for i, j in places])
    return found.select(F.explode(F.get(both, F.col("p"))).alias("n"), "r").select("n.x", "n.y", "r")


def _inside(rows: DataFrame, brackets: list[tuple]) -> DataFrame:
    """``rows`` (g, v) once for each bracket (i, g, low, high) that holds them: i, v, and low and high.

    Brackets are bounded by the number of ranks, so they may be broadcast.
    """
    b = rows.sparkSession.createDataFrame(brackets, "i int, bg string, low double, high double")
    return rows.join(F.broadcast(b), F.col("g").eqNullSafe(F.col("bg")) & (F.col("v") >= F.col("low")) & (F.col("v") <= F.col("high")))


def _order_statistics(rows: DataFrame, ranks: list[tuple[str | None, int]]) -> dict[tuple[str | None, int], float]:
    """The value of each (group, rank from 0) in ``rows`` (g string, v double, no NULLs).

    Ranks that lie in one bracket share it, so the brackets never overlap: a row is in one at most.
    """
    out: dict[tuple[str | None, int], float] = {}
    # of each rank: bracket, and how many values of its group lie below it
    state = {r: (float("-inf"), float("inf"), 0) for r in ranks}
    while state:
        shared: dict[tuple, list] = {}  # (group, low, high, below): its ranks
        for r, bracket in state.items():
            shared.setdefault((r[0], *bracket), []).append(r)
        todo = list(shared)
        held = _inside(rows, [(i, *b[:3]) for i, b in enumerate(todo)])
        seen = held.groupBy("i").agg(F.count("*").alias("n"), F.approx_count_distinct("v").alias("d"),
                                     F.percentile_approx("v", [k / CUTS for k in range(CUTS + 1)], 50 * CUTS).alias("cuts"))
        few, many = [], {}
        for x in seen.collect():
            few.append(x["i"]) if x["d"] <= BRACKET_VALUES or len(set(x["cuts"])) <= 2 else many.update({x["i"]: x["cuts"]})
        if few:
            small = _inside(rows, [(i, *todo[i][:3]) for i in few]).groupBy("i", "v").count()
            values: dict[int, list] = {}
            for x in small.collect():
                values.setdefault(x["i"], []).append((x["v"], x["count"]))
            for i, found in values.items():
                below, wanted = todo[i][3], sorted(shared[todo[i]], key=lambda r: r[1])
                for v, n in sorted(found):
                    below += n
                    while wanted and below > wanted[0][1]:
                        out[wanted[0]] = v
                        del state[wanted.pop(0)]
        if many:
            # exact counts up to each cut say between which two a rank lies
            spots = F.create_map(*[x for i, c in many.items() for x in (F.lit(i), F.array(*map(F.lit, sorted(set(c)))))])
            counts = _inside(rows, [(i, *todo[i][:3]) for i in many]).withColumn("cuts", spots[F.col("i")]).withColumn(
                "k", F.size(F.filter("cuts", lambda c: c < F.col("v")))).groupBy("i", "k").count().collect()
            for i, c in many.items():
                _, low, high, at = todo[i]
                edges, wanted = sorted(set(c)), sorted(shared[todo[i]], key=lambda r: r[1])
                for k, n in sorted((x["k"], x["count"]) for x in counts if x["i"] == i):
                    # values over edges[k - 1] up to edges[k]
                    part = (max(low, math.nextafter(edges[k - 1], math.inf)) if k else low,
                            min(high, edges[k]) if k < len(edges) else high, at)
                    at += n
                    while wanted and at > wanted[0][1]:
                        state[wanted.pop(0)] = part
    return out


def _values(df: DataFrame, val: str, group: str | None) -> DataFrame:
    """g (the group as text) and v of the rows that have a value; NaN is none, as in ``qcut``."""
    g = F.col(group).cast("string") if group else F.lit(None).cast("string")
    return df.select(g.alias("g"), F.col(val).cast("double").alias("v")).where(_present("v"))


def _present(v: str) -> Column:
    return F.col(v).isNotNull() & ~F.isnan(v)


def quantiles(df: DataFrame, val: str, probs: Sequence[float], group: str | None = None) -> dict:
    """Exact linear-interpolated quantiles of the values that are not NULL or NaN: {group: (n, [q, ..])}; the group is None without one.

    Infinities are values; between a finite and an infinite one lies the infinite one.
    Every step is an aggregation over all rows; a bracket that still holds more
    than BRACKET_VALUES distinct values is cut in CUTS parts and counted again,
    so n rows take about log(n) / log(CUTS) steps of bounded memory.
    """
    rows = _values(df, val, group)
    sizes = {r["g"]: r["count"] for r in rows.groupBy("g").count().limit(MOST_GROUPS + 1).collect()}
    if len(sizes) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups")
    places = {(name, p): p * (n - 1) for name, n in sizes.items() for p in probs}
    ranks = {(name, r) for (name, _), h in places.items() for r in (math.floor(h), math.ceil(h))}
    at = _order_statistics(rows, sorted(ranks, key=lambda r: (r[0] is not None, r[0] or "", r[1])))

    def value(name, p) -> float:
        h = places[name, p]
        low, high = at[name, math.floor(h)], at[name, math.ceil(h)]
        return low if low == high or low == -math.inf else low + (high - low) * (h - math.floor(h))

    return {name: (n, [value(name, p) for p in probs]) for name, n in sizes.items()}


# --- sketches that can be stored and merged ------------------------------------------------

def sketch(df: DataFrame, val: str, group: str | None = None, k: int = SKETCH_K) -> DataFrame:
    """g (the group as text), n, sketch: a quantile sketch (KLL) of the values of each group.

    A row of some kilobytes a group, whatever the number of values.  Batches are
    sketched as they arrive, their rows are stored side by side, and ``merge_sketches``
    gives those of all batches together.  NULL and NaN are no values; a group without one has no row.
    """
    return _values(df, val, group).groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("v", k).alias("sketch"))


def merge_sketches(stored: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """One row a group from the rows of many batches; merged sketches may be stored and merged again."""
    return stored.groupBy("g").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def rank_error(k: int = SKETCH_K) -> float:
    """The share of a group's values by which a quantile's rank may be wrong, in 99 of 100 cases."""
    return 2.296 / k ** 0.9021  # of the KLL sketch with parameter k


def sketch_quantiles(sketches: DataFrame, probs: Sequence[float]) -> dict:
    """What ``quantiles`` gives, from merged sketches: values of the data whose ranks are right up to ``rank_error``."""
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    found = sketches.select("g", "n", F.kll_sketch_get_quantile_double("sketch", ranks).alias("q")).limit(MOST_GROUPS + 1).collect()
    if len(found) > MOST_GROUPS:
        raise ValueError(f"more than {MOST_GROUPS} groups")
    return {r["g"]: (r["n"], list(r["q"])) for r in found}


def quantile_edges(df: DataFrame, col: str, q: int = 5, sketches: DataFrame | None = None) -> list[float]:
    """The q+1 equal-frequency edges (min, interior quantiles, max) of ``col``; none without values.

    With ``sketches`` (of ``col``, without a group) they are read from those, and ``df`` is not.
    """
    probs = [i / q for i in range(q + 1)]
    found = sketch_quantiles(sketches, probs) if sketches is not None else quantiles(df, col, probs)
    return found[None][1] if found else []


def bucket_expr(col: str, edges: Sequence[float], labels: Sequence[str] | None = None) -> Column:
    """Right-closed bucket of ``col`` for the given edges; the lowest edge is included."""
    x = F.col(col).cast("double")
    n = len(edges) - 1
    labels = list(labels) if labels is not None else [str(i + 1) for i in range(n)]
    expr = F.when(x.isNull() | F.isnan(x) | (x < F.lit(edges[0])) | (x > F.lit(edges[-1])), F.lit(None).cast("string"))
    if not n:  # one value
        return expr.otherwise(F.lit(labels[0]))
    for i in range(n):
        expr = expr.when(x <= F.lit(edges[i + 1]), F.lit(labels[i]))
    return expr


def quantile_bucket(df: DataFrame, col: str, q: int = 5, labels: Sequence[str] | None = None,
                    out: str = "size_bucket", collapse: bool = False, sketches: DataFrame | None = None) -> DataFrame:
    """Add ``out``: the equal-frequency bucket of ``col`` (pandas ``qcut`` semantics).

    Ties stay in one bucket; NULL and NaN have none.  Duplicate edges raise unless ``collapse``, which
    drops the empty buckets (and their labels); a column of one value then has one bucket.
    ``sketches`` gives approximate edges without a pass over ``df`` (``quantile_edges``).
    """
    edges = quantile_edges(df, col, q, sketches)
    labels = list(labels) if labels is not None else [str(i + 1) for i in range(q)]
    if not edges:
        return df.withColumn(out, F.lit(None).cast("string"))
    if len(set(edges)) < len(edges):
        if not collapse:
            raise ValueError(f"bucket edges are not unique: {edges}")
        keep_e, keep_l = [edges[0]], []
        for e, lab in zip(edges[1:], labels):
            if e != keep_e[-1]:
                keep_e.append(e)
                keep_l.append(lab)
        edges, labels = keep_e, keep_l or labels[:1]
    return df.withColumn(out, bucket_expr(col, edges, labels))


def _quartile_table(base: DataFrame, bucket: str, sketches: DataFrame | None = None) -> DataFrame:
    """bucket, n, q1, median, q3: one row per bucket, at most MOST_GROUPS."""
    probs = [0.25, 0.5, 0.75]
    found = sketch_quantiles(sketches, probs) if sketches is not None else quantiles(base, "__v", probs, bucket)
    kind = base.schema[bucket].dataType
    return base.sparkSession.createDataFrame([(g, n, *q) for g, (n, q) in found.items()],
                                             "b string, n long, q1 double, median double, q3 double") \
        .select(F.col("b").cast(kind).alias(bucket), "n", "q1", "median", "q3")


def _rounded(name: str, digits: int | None) -> Column:
    return F.col(name) if digits is None else F.round(name, digits).alias(name)


def _bucketed(df: DataFrame, bucket: str, val: str) -> DataFrame:
    """The bucket and ``__v`` of rows that have both."""
    return df.select(F.col(bucket), F.col(val).cast("double").alias("__v")).where(F.col(bucket).isNotNull() & _present("__v"))


def box_summary(df: DataFrame, bucket: str, val: str, digits: int | None = None, sketches: DataFrame | None = None) -> DataFrame:
    """Per bucket: n, q1, median, q3, iqr, whiskers (furthest points within 1.5 IQR), outliers.

    The quartiles, a row per bucket, are broadcast to one pass for the whiskers.  With
    ``sketches`` (of ``val`` by ``bucket``) the quartiles are theirs; whiskers and outliers
    are exact for those quartiles.  NULL and NaN are left out.
    """
    base = _bucketed(df, bucket, val)
    quart = _quartile_table(base, bucket, sketches).withColumn("iqr", F.col("q3") - F.col("q1")).withColumns({
        "__lo": F.col("q1") - 1.5 * F.col("iqr"), "__hi": F.col("q3") + 1.5 * F.col("iqr")})
    x = F.col("__v")
    inside = (x >= F.col("__lo")) & (x <= F.col("__hi"))
    summary = base.join(F.broadcast(quart), bucket).groupBy(bucket, "n", "q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, x)).alias("lower_whisker"),
        F.max(F.when(inside, x)).alias("upper_whisker"),
        F.count_if(~inside).cast("bigint").alias("n_outliers"),
    )
    return summary.select(bucket, "n", *[_rounded(c, digits) for c in (
        "q1", "median", "q3", "iqr", "lower_whisker", "upper_whisker")], "n_outliers")


def median_by_bucket(df: DataFrame, bucket: str, val: str, out: str = "median_ratio", digits: int | None = None,
                     sketches: DataFrame | None = None) -> DataFrame:
    """Median per bucket, exact or from ``sketches`` (of ``val`` by ``bucket``)."""
    return _quartile_table(_bucketed(df, bucket, val), bucket, sketches).withColumn(out, F.col("median")).select(bucket, "n", _rounded(out, digits))


def log_density(df: DataFrame, x: str, y: str, y_bins_per_unit: int = 100) -> DataFrame:
    """Counts per (floor(log10 x), floor(y * y_bins_per_unit)); rows with x <= 0 or NULLs are skipped."""
    xv, yv = F.col(x).cast("double"), F.col(y).cast("double")
    pts = df.where(xv.isNotNull() & yv.isNotNull() & (xv > 0))
    return pts.groupBy(
        F.floor(F.log10(xv)).cast("int").alias("log10_x_bin"),
        F.floor(yv * y_bins_per_unit).cast("bigint").alias("y_bin"),
    ).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def points(df: DataFrame, x: str, y: str, cap: int | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Rows with both measures present; with ``cap``, the first ``cap`` by ``order`` (reproducible)."""
    pts = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    if cap is None:
        return pts
    return pts.orderBy(*[F.col(c).asc_nulls_first() for c in (list(order) or [x, y])]).limit(cap)
