"""Statistics and profiles: edge cases and single-pass plans."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strata.operators import profile, stats


def test_corr_policies_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, None), (None, 1.0), (4.0, 8.5)], "a double, b double")
    pdf = df.toPandas()
    pair = pdf.dropna()
    want_pair = np.corrcoef(pair.a, pair.b)[0, 1]
    z = pdf.fillna(0.0)
    want_zero = np.corrcoef(z.a, z.b)[0, 1]
    assert stats.corr(df, "a", "b", "pairwise").first().r == pytest.approx(want_pair)
    assert stats.corr(df, "a", "b", "zero").first().r == pytest.approx(want_zero)
    const = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0)], "a double, b double")
    assert stats.corr(const, "a", "b").first().r is None
    empty = spark.createDataFrame([], "a double, b double")
    assert stats.corr(empty, "a", "b").first().r is None


def test_corr_matrix_single_aggregation_and_symmetry(spark):
    df = spark.createDataFrame([(float(i), float(i * i), float(-i)) for i in range(10)], "x double, y double, z double")
    m = stats.corr_matrix(df, ["x", "y", "z"])
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # one aggregation, one single-partition exchange
    r = {(a, b): v for a, b, v in m.collect()}
    assert len(r) == 9 and r[("x", "x")] == 1.0 and r[("x", "z")] == -1.0
    assert all(r[(a, b)] == r[(b, a)] for a, b in r)


def test_quantile_bucket_matches_qcut(spark):
    vals = [1, 2, 2, 2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    got = [r.b for r in stats.quantile_bucket(df, "x", 5, out="b").orderBy("x").collect()]
    want = pd.qcut(pd.Series(vals, dtype=float), 5, labels=["1", "2", "3", "4", "5"]).astype(str).tolist()
    assert got == want


def test_quantile_bucket_duplicate_edges(spark):
    df = spark.createDataFrame([(1.0,)] * 8 + [(2.0,)], "x double")
    with pytest.raises(ValueError):
        stats.quantile_bucket(df, "x", 5)
    out = stats.quantile_bucket(df, "x", 5, collapse=True, out="b")
    assert out.where(F.col("b").isNull()).count() == 0


@pytest.mark.parametrize("partitions", [1, 7, 60])
def test_quantiles_are_exact_however_narrow_the_memory(spark, partitions, monkeypatch):
    """Brackets of a few values force several narrowing steps; ties and groups included."""
    monkeypatch.setattr(stats, "BRACKET_VALUES", 5)
    monkeypatch.setattr(stats, "CUTS", 8)
    rng = np.random.default_rng(1)
    rows = [("a", float(v)) for v in rng.normal(size=700)] + [("b", float(v % 9)) for v in range(300)] + [("c", 4.0)]
    df = spark.createDataFrame(rows + [("a", None), (None, 2.0)], "g string, v double").repartition(partitions)
    probs = [0.0, 0.2, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = stats.quantiles(df, "v", probs, "g")
    for g in ("a", "b", "c", None):
        own = [v for x, v in rows + [(None, 2.0)] if x == g]
        assert got[g][0] == len(own) and got[g][1] == pytest.approx(list(np.quantile(own, probs)), abs=1e-12)
    every = [v for _, v in rows] + [2.0]
    assert stats.quantile_edges(df, "v", 5) == pytest.approx(list(np.quantile(every, [0, 0.2, 0.4, 0.6, 0.8, 1])), abs=1e-12)
    assert stats.quantile_edges(df.limit(0), "v") == []


def test_box_summary_matches_numpy(spark):
    rng = np.random.default_rng(3)
    v = np.concatenate([rng.normal(0, 1, 200), [15.0, -12.0]])
    df = spark.createDataFrame([("g", float(x)) for x in v], "b string, v double")
    s = stats.box_summary(df, "b", "v").first()
    q1, med, q3 = np.percentile(v, [25, 50, 75])
    lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = v[(v >= lo) & (v <= hi)]
    assert s.n == len(v)
    assert (s.q1, s.median, s.q3) == pytest.approx((q1, med, q3), abs=1e-6)
    assert (s.lower_whisker, s.upper_whisker) == pytest.approx((inside.min(), inside.max()), abs=1e-6)
    assert s.n_outliers == len(v) - len(inside)


def test_log_density(spark):
    df = spark.createDataFrame([(1e6, 0.5), (2e6, 0.5), (1e7, 0.01), (0.0, 1.0), (None, 1.0)], "x double, y double")
    got = sorted(tuple(r) for r in stats.log_density(df, "x", "y").collect())
    assert got == [(6, 50, 2), (7, 1, 1)]


def test_numeric_columns_skip_decimals_like_reference(spark):
    df = spark.createDataFrame([(1, 2, 1.0, None)], "a int, b bigint, c double, d decimal(18,2)")
    assert stats.numeric_columns(df) == ["a", "b", "c"]
    assert stats.numeric_columns(df, include_decimal=True) == ["a", "b", "c", "d"]


def test_null_profile_values_and_single_pass(spark):
    pdf = pd.DataFrame({"a": [1, None, 3, None, 5, 6], "b": ["x", "y", None, "z", "w", "v"]})
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "a double, b string")
    prof = profile.nulls(df)
    got = {r.column_name: (r.null_count, r.null_pct) for r in prof.collect()}
    assert got == {"a": (2, 33.33), "b": (1, 16.67)}
    plan = profile.null_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2 and "Generate" in plan  # partial + final, then unpivot
    empty = spark.createDataFrame([], "a double")
    assert profile.null_counts(empty).first().null_pct is None


def test_pct_rounds_half_up(spark):
    df = spark.createDataFrame([(None,)] * 1 + [(1,)] * 7, "a int")  # 1/8 = 12.5 %
    assert profile.null_counts(df).first().null_pct == 12.5
    df2 = spark.createDataFrame([(None,)] * 1 + [(1,)] * 799, "a int")  # 0.125 % -> 0.13 (half-up)
    assert profile.null_counts(df2).first().null_pct == 0.13


def test_placeholder_profile_and_values(spark):
    df = spark.createDataFrame([(" Unknown", "a", 1), ("N/A", "tbd", 2), ("ok", "?", 3), ("unknown", None, 4)],
                               "c1 string, c2 string, n int")
    prof = [tuple(r) for r in profile.placeholders(df).collect()]
    assert prof == [("c1", 3), ("c2", 2)]
    vals = sorted(tuple(r) for r in profile.placeholder_values(df, "c1").collect())
    assert vals == [(" Unknown", "unknown", 1), ("N/A", "n/a", 1), ("unknown", "unknown", 1)]
    assert not math.isnan(profile.null_after_clean(df, "c2").first().nulls_after_clean)


def test_profiles_of_tables_without_matching_columns(spark):
    nums = spark.createDataFrame([(1,)], "a int")
    assert profile.placeholders(nums).count() == 0
    assert stats.corr_matrix(nums, []).count() == 0


def test_audit_run_and_gold_analyze(spark, sf_small):
    import __spark_entry__ as entry
    from strata.plans import audit, gold
    from strata.sources import fixtures as fx

    res = audit.run(fx.raw_incidents(spark, sf_small), "bronze", "incidents_master_raw", "attribution_confidence",
                    as_of="2001-01-01 00:00:00")
    assert res.nulls.count() == 34 and res.metrics.count() == 34
    assert res.nulls_after_clean.first().nulls_after_clean >= res.placeholder_values.agg(
        F.sum("count")).first()[0]
    parts = gold.analyze(entry.queries()["gold_incident_fact"](spark, sf_small))
    assert parts["correlation_matrix"].count() == 49
    assert parts["box_summary"].count() == 5


@pytest.mark.parametrize("nulls", ["zero", "pairwise"])
@pytest.mark.parametrize("parts", [1, 5])
def test_wide_matrix_equals_the_narrow_one(spark, nulls, parts, monkeypatch):
    from strata.operators import gram

    monkeypatch.setattr(gram, "BLOCK", 64)
    rng = np.random.default_rng(4)
    data = rng.normal(size=(80, 7)) * [1, 1e-6, 1e6, 1, 1, 1, 1] + [0, 1e6, 0, 5, 0, 0, 0]
    data[:, 4] = 0.1                      # constant, no binary fraction
    data[:, 5] = -3 * data[:, 0]          # perfectly correlated
    rows = [[None if (i * 7 + j) % 5 == 0 and j in (0, 2, 6) else float(v) for j, v in enumerate(r)] for i, r in enumerate(data)]
    names = [f"v {j}" for j in range(7)]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names)).repartition(parts)
    quoted = [f"`{n}`" for n in names]
    got = {(r.x, r.y): r.r for r in gram.corr_matrix(df, quoted, nulls).collect()}
    want = {(r.x, r.y): r.r for r in stats.corr_matrix(df, quoted, nulls).collect()}
    assert set(got) == set(want) and len(got) == 49
    place = {q: j for j, q in enumerate(quoted)}
    for pair, r in want.items():
        assert (got[pair] is None) == (r is None) and (r is None or abs(got[pair] - r) < 1e-4), pair
        if r is not None:  # the narrow one loses digits where the spread is small against the size
            x, y = (np.array([np.nan if row[place[q]] is None else row[place[q]] for row in rows]) for q in pair)
            x, y = (np.nan_to_num(x), np.nan_to_num(y)) if nulls == "zero" else (x[~np.isnan(x + y)], y[~np.isnan(x + y)])
            x, y = (v - np.mean(v.astype(np.longdouble)) for v in (x, y))
            assert abs(got[pair] - float(x @ y / np.sqrt((x @ x) * (y @ y)))) < 1e-8, pair
    assert all(got[quoted[4], q] is None for q in quoted)


def test_wide_matrix_of_odd_tables(spark):
    from strata.operators import gram

    df = spark.createDataFrame([(1.0, None, float("nan")), (2.0, None, 1.0)], "a double, b double, c double")
    got = {(r.x, r.y): r.r for r in gram.corr_matrix(df, ["a", "b", "c"], "pairwise").collect()}
    assert abs(got["a", "a"] - 1) < 1e-12 and got["a", "b"] is None and got["b", "b"] is None and math.isnan(got["a", "c"])
    empty = gram.corr_matrix(df.limit(0), ["a", "b"]).collect()
    assert len(empty) == 4 and all(r.r is None for r in empty)
    assert gram.corr_matrix(df, []).count() == 0
    with pytest.raises(ValueError):
        gram.corr_matrix(df, ["a"], "other")


def test_200_columns_without_k2_buffers(spark):
    import duckdb
    from strata.operators import gram

    rng = np.random.default_rng(9)
    data = (rng.normal(size=(60, 12)) @ rng.normal(size=(12, 200))).round(6)
    pdf = pd.DataFrame(data, columns=[f"c{i}" for i in range(200)])
    found = gram.corr_matrix(spark.createDataFrame(pdf).repartition(3), list(pdf.columns), digits=6)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("sum(") <= 4 * 6 and "corr(" not in plan
    got = {(r.x, r.y): r.r for r in found.collect()}
    want = duckdb.sql("""WITH long AS (UNPIVOT (SELECT row_number() OVER () AS id, * FROM pdf) ON COLUMNS(* EXCLUDE id))
        SELECT a.name, b.name, round(corr(a.value, b.value), 6) + 0.0 FROM long a JOIN long b USING (id) GROUP BY ALL""").fetchall()
    assert len(want) == 40_000 and all(abs(got[x, y] - r) < 2e-6 for x, y, r in want)


def test_sketches_of_batches_merge(spark):
    """Ranks stay within the stated error, however the rows are split over batches; few values are kept exactly."""
    rng = np.random.default_rng(8)
    values = {"a": rng.normal(size=20_000), "b": np.round(rng.exponential(size=5_000), 2), "c": np.array([3.0])}
    rows = [(g, float(v), i % 6) for g, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows + [("a", None, 0), ("d", None, 1), ("d", float("nan"), 2)], "g string, v double, batch int")
    k, probs = 200, [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
    stored = [stats.sketch(df.where(F.col("batch") == b), "v", "g", k) for b in range(6)]
    first = stats.merge_sketches(stored[0].unionByName(stored[1]), k)
    later = stats.merge_sketches(stored[2].unionByName(stored[3]).unionByName(stored[4]).unionByName(stored[5]), k)
    got = stats.sketch_quantiles(stats.merge_sketches(first.unionByName(later), k), probs)
    assert set(got) == {"a", "b", "c"}
    for g, vs in values.items():
        n, qs = got[g]
        assert n == len(vs) and (qs[0], qs[-1]) == (vs.min(), vs.max())
        for p, q in zip(probs, qs):
            assert np.mean(vs < q) - 3 * stats.rank_error(k) <= p <= np.mean(vs <= q) + 3 * stats.rank_error(k)
    size = stored[0].selectExpr("max(octet_length(sketch)) AS s").first().s
    assert size < 20_000 * 8 / 6 / 2


def test_sketched_buckets_and_boxes(spark):
    rows = [("g" if i % 2 else "h", float(i)) for i in range(101)]
    df = spark.createDataFrame(rows, "b string, v double")
    exact = {r.b: r for r in stats.box_summary(df, "b", "v").collect()}
    near = {r.b: r for r in stats.box_summary(df, "b", "v", sketches=stats.sketch(df, "v", "b")).collect()}
    for b, r in exact.items():
        assert near[b].n == r.n and abs(near[b].median - r.median) <= 2 and near[b].n_outliers == r.n_outliers == 0
    bucketed = stats.quantile_bucket(df, "v", 5, sketches=stats.sketch(df, "v"))
    counts = [r["count"] for r in bucketed.groupBy("size_bucket").count().collect()]
    assert sorted(counts)[0] >= 19 and sum(counts) == 101
    medians = {r.b: r.median_ratio for r in stats.median_by_bucket(df, "b", "v", sketches=stats.sketch(df, "v", "b")).collect()}
    assert abs(medians["g"] - 50) <= 2
    assert stats.sketch_quantiles(stats.sketch(df.limit(0), "v", "b"), [0.5]) == {}


@pytest.mark.parametrize("values", [[1.0, math.nan, 2.0, 3.0, None], [math.nan, None], [-math.inf, 1.0, 2.0, math.inf], [4.0], [4.0, math.nan],
                                    [math.inf, 5.0], [-math.inf, 5.0, 6.0, 7.0]])
def test_quantiles_leave_out_nan_and_keep_infinities(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    own = sorted(v for v in values if v is not None and v == v)
    got = stats.quantiles(df, "v", [0.0, 0.5, 1.0])
    if not own:
        assert got == {} and stats.quantile_bucket(df, "v").where("size_bucket is not null").count() == 0
        return
    n, (low, _, high) = got[None]
    assert (n, low, high) == (len(own), own[0], own[-1])
    assert not any(math.isnan(q) for q in got[None][1])
    bucketed = stats.quantile_bucket(df, "v", 2, collapse=True)
    assert bucketed.where("size_bucket is not null").count() == len(own)
    assert bucketed.where("size_bucket is null").count() == len(values) - len(own)
    box = stats.box_summary(bucketed, "size_bucket", "v").agg(F.sum("n")).first()[0]
    assert box == len(own)
    assert stats.quantile_bucket(df.where("not isnan(v)"), "v", 2, collapse=True).count() >= len(own)


def test_one_value_has_one_bucket(spark):
    df = spark.createDataFrame([(4.0,)] * 3, "v double")
    assert {r.size_bucket for r in stats.quantile_bucket(df, "v", 5, stats.SIZE_LABELS, collapse=True).collect()} == {"Q1 (smallest)"}
    with pytest.raises(ValueError):
        stats.quantile_bucket(df, "v")


def test_audit_reads_the_table_once(spark):
    """All results come from one pass, and equal those of the separate profiles."""
    from strata.plans import audit

    rows = [(" Unknown", "a", 1, None), ("N/A", "tbd", 2, 1.0), ("ok", "?", None, None), ("unknown", None, 4, 2.0), (None, " -- ", 5, 2.0), ("N/A", "x", 6, 1.0)]
    plain = spark.createDataFrame(rows, "`c 1` string, c2 string, n int, v double")
    read = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(n):
        read.add(1)
        return n

    got = audit.run(plain.withColumn("n", counted("n")), "bronze", "t", "c 1", as_of="2001-01-01 00:00:00")
    pairs = [(got.nulls, profile.nulls(plain)), (got.metrics, profile.metrics(plain, "bronze", "t", "2001-01-01 00:00:00")),
             (got.placeholders, profile.placeholders(plain)), (got.placeholder_values, profile.placeholder_values(plain, "`c 1`")),
             (got.nulls_after_clean, profile.null_after_clean(got.cleaned.drop("n"), "`c 1`"))]
    for a, b in pairs:
        assert a.columns == b.columns
        assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)
    assert read.value == len(rows)
    empty = audit.run(plain.limit(0), "bronze", "t", "c 1")
    assert [tuple(r) for r in empty.nulls_after_clean.collect()] == [(0, 0)]
    assert {(r.null_count, r.null_pct) for r in empty.nulls.collect()} == {(0, None)} and empty.nulls.count() == 4
    assert empty.placeholders.count() == 0 == empty.placeholder_values.count()
    numbers = audit.run(plain.select("n"), "bronze", "t", "n")
    assert [tuple(r) for r in numbers.nulls_after_clean.collect()] == [(6, 1)] and numbers.placeholders.count() == 0
