import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import whitening as w
from strata.llm.queries import queries

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k, weights="counts", scale=64, shift=1_000_000):
    """id -> (deviation, whitened, explained) over all rows one by one, in exact integers as far as they go."""
    rows = [(i, [int(np.floor(scale * float(c))) + shift for c in v]) for i, v in rows]
    fit = rows if weights == "counts" else [(0, list(v)) for v in {tuple(v) for _, v in rows}]
    n, dims = len(fit), len(rows[0][1])
    sums = [sum(v[j] for _, v in fit) for j in range(dims)]
    centre = lambda v: np.array([(n * v[j] - sums[j]) / n for j in range(dims)])
    data = np.array([centre(v) for _, v in fit])
    covariance = data.T @ data / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    out = {}
    for i, v in rows:
        with np.errstate(divide="ignore", invalid="ignore"):
            out[i] = sum((n * a - s) ** 2 for a, s in zip(v, sums)), centre(v) @ vectors / np.sqrt(values), values / np.trace(covariance)
    return n, out


def by_id(df):
    found = {}
    for r in df.collect():
        found.setdefault(r["vec_id"], {})[r["component"]] = r
    return found


def same(got, want, n, k):
    """Values agree up to the sign of each component, the same for all rows."""
    assert set(got) == set(want)
    signs = np.zeros(k)
    for i, rows in got.items():
        assert sorted(rows) == list(range(1, k + 1))
        deviation, whitened, explained = want[i]
        for c, r in rows.items():
            assert (r["n"], int(r["deviation"])) == (n, deviation)
            assert abs(r["explained"] - explained[c - 1]) <= 1e-9 * explained[c - 1]
            assert r["identity_error"] <= 1e-8
            assert abs(abs(r["whitened"]) - abs(whitened[c - 1])) < 1e-6
            if abs(whitened[c - 1]) > 1e-3:
                sign = np.sign(r["whitened"] * whitened[c - 1])
                assert signs[c - 1] in (0, sign)
                signs[c - 1] = sign


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=9).astype(np.float32) * np.arange(1, 10) + 3) for i in range(300)]
    rows += [(1000 + i, rows[7][1]) for i in range(200)] + [(2000 + i, rows[i][1]) for i in range(30)]
    return [(i, [float(c) for c in v]) for i, v in rows]


@pytest.mark.parametrize("weights,k", [("counts", 9), ("counts", 4), ("one", 9)])
def test_matches_plain_whitening(spark, vectors, weights, k):
    df = spark.createDataFrame(vectors, SCHEMA).repartition(7)
    got = by_id(w.transform(df, k=k, weights=weights))
    n, want = plain(vectors, k, weights)
    same(got, want, n, k)
    assert got[7][1]["whitened"] == got[1005][1]["whitened"]


def test_dropped_vectors_clashing_columns_and_repeated_rows(spark, vectors):
    bad = [(9000, None), (9001, [None] * 9), (9002, [1.0] * 8 + [None]), (9003, [float("nan")] * 9), (9004, [float("inf")] * 9),
           (9005, [1.0] * 8 + [float("-inf")]), (9006, []), (9007, [1.0] * 8)]
    df = spark.createDataFrame(vectors + bad, SCHEMA)
    for name in ("x", "count", "n", "whitened", "_i", "_doc", "component", "_key", "deviation"):
        df = df.withColumn(name, F.lit("own"))
    got = w.transform(df, k=3)
    assert {"x", "count", "_i", "_doc", "_key"} <= set(got.columns) and len(set(got.columns)) == len(got.columns)
    n, want = plain(vectors, 3)
    same(by_id(got), want, n, 3)
    twice = w.transform(df.unionByName(df.where("vec_id = 5")), k=3)
    assert twice.where("vec_id = 5").count() == 6 and twice.first()["n"] == len(vectors) + 1
    nameless = spark.createDataFrame([(None, [1.0, 2.0]), (None, [2.0, 1.0]), (3, [1.0, 1.0])], SCHEMA)
    assert w.transform(nameless, k=2).count() == 6


def test_empty_single_and_flat_tables(spark):
    empty = w.transform(spark.createDataFrame([(1, None), (2, [])], SCHEMA))
    assert empty.count() == 0
    one = w.transform(spark.createDataFrame([(1, [0.5, -2.0])] * 3, SCHEMA)).collect()
    assert len(one) == 6 and all(r["whitened"] is None and r["explained"] is None and r["deviation"] == 0 and r["n"] == 3 for r in one)
    assert empty.columns == w.transform(spark.createDataFrame([(1, [1.0])], SCHEMA)).columns
    flat = w.transform(spark.createDataFrame([(i, [float(i), 2.0 * i, 7.0]) for i in range(10)], SCHEMA), k=3).collect()
    assert {r["component"] for r in flat if r["whitened"] is None} == {2, 3}
    assert max(r["identity_error"] for r in flat) < 1e-8


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e9 * (i % 7) + i, -3e8 * i, float(i)]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = by_id(w.transform(df, k=2))
    n, want = plain(rows, 2)
    same(got, want, n, 2)
    with pytest.raises(Exception, match="too large to be exact"):
        w.transform(spark.createDataFrame([(1, [1e17])], SCHEMA))


def test_registered_query(spark):
    data = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, want = plain(data, 32)
    df = queries()["op12_whitening"](spark, SF)
    assert dict(df.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                               "explained": "double", "identity_error": "double"}
    same(by_id(df), want, n, 32)
