"""What the feeds and the analysis shuffle and write must grow no faster than their input."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from strata import registry, session
from strata.operators import stats
from strata.sources import fixtures as fx
from strata.sources import io


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def lineitem(spark, tmp_path):
    spark.range(200).selectExpr(
        "id div 4 AS l_orderkey", "id AS l_partkey", "id % 10 AS l_suppkey", "CAST(id % 4 AS INT) AS l_linenumber",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "CAST(id AS DOUBLE) AS l_extendedprice", "0.06D AS l_discount", "'R' AS l_returnflag",
        "'F' AS l_linestatus", "timestamp_seconds(id * 86400) AS l_shipdate").coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    for name in ("orders", "events", "nation"):
        spark.range(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_a_large_file_is_not_shuffled_to_spread_it(spark, lineitem, monkeypatch):
    df = fx.table(spark, lineitem, "lineitem")
    assert session.spread(df, 4).rdd.getNumPartitions() == 4  # small: one task would do all the work
    monkeypatch.setattr(session, "SPREAD_BYTES", 1)
    assert "Exchange" not in plan(session.spread(df, 4)) and session.spread(df, 4).count() == 200


def test_raw_views_are_derived_where_they_are_read(spark, lineitem):
    raw = fx.raw_financial(spark, lineitem)
    assert all("lineitem.parquet" in f for f in raw.inputFiles())
    narrow = plan(raw.select("legal_fees_usd"))
    assert "l_suppkey" in narrow and "l_shipdate" not in narrow
    assert raw.count() == fx.bronze(spark, lineitem, "raw_financial").count() == 200


def test_files_of_a_feed_are_compressed_and_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(io, "CSV_ROWS", 10)
    rows = [(f" a,{i} ", None if i % 3 else 'say "x"') for i in range(25)]
    path = str(tmp_path / "feed")
    io.write_csv(spark.createDataFrame(rows, "a string, b string").coalesce(1), path)
    files = [f for f in os.listdir(path) if f.startswith("part-")]
    assert len(files) == 3 and all(f.endswith(".csv.gz") for f in files)
    assert sorted(map(tuple, io.read_csv(spark, path).collect()), key=str) == sorted(rows, key=str)


def test_a_typed_scan_is_stored_without_sorting_it(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n1,x\nno,y\n2,z\n")
    found = io.read_csv_typed(spark, str(tmp_path / "f.csv"), spark.range(0).selectExpr("1 AS a", "'' AS b").schema, str(tmp_path / "typed"))
    assert not [f for f in os.listdir(tmp_path / "typed") if f.startswith("refused=")]
    assert sorted(r.a for r in found.good.collect()) == [1, 2] and [r.record for r in found.refused.collect()] == ["no,y"]


@pytest.mark.parametrize("nulls", ["zero", "pairwise"])
def test_correlations_are_one_small_aggregate(spark, nulls):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 8))
    df = spark.createDataFrame([[None if i % 7 == j else float(v) for j, v in enumerate(r)] for i, r in enumerate(x)],
                               ", ".join(f"c{j} double" for j in range(8)))
    found = stats.corr_matrix(df, df.columns, nulls)
    assert found._jdf.queryExecution().optimizedPlan().toString().count("covar_pop") <= 2
    got = {(r.x, r.y): r.r for r in found.collect()}
    absent = np.array([[i % 7 == j for j in range(8)] for i in range(60)])
    for a in range(8):
        for b in range(8):
            rows = ~(absent[:, a] | absent[:, b]) if nulls == "pairwise" else np.ones(60, bool)
            own = np.where(absent, 0.0, x)
            assert got[f"c{a}", f"c{b}"] == pytest.approx(np.corrcoef(own[rows, a], own[rows, b])[0, 1], abs=1e-9)
    empty = stats.corr_matrix(df.where("false"), df.columns, nulls).collect()
    assert len(got) == len(empty) == 64 and all(r.r is None for r in empty)


def test_ranks_share_their_brackets(spark, monkeypatch):
    asked, inside = [], stats._inside
    monkeypatch.setattr(stats, "_inside", lambda rows, brackets: asked.append(len(brackets)) or inside(rows, brackets))
    df = spark.range(9001).select(((F.col("id") * 7919) % 9001).cast("double").alias("v"))
    (n, q), = stats.quantiles(df, "v", [i / 5 for i in range(6)]).values()
    assert (n, q) == (9001, [0.0, 1800.0, 3600.0, 5400.0, 7200.0, 9000.0])
    assert asked[0] == 1


def test_merge_sides_are_stored_as_columns(spark, lineitem):
    target, source = registry._financial_merge(spark, lineitem)
    assert "ExistingRDD" not in plan(source) and source.inputFiles()[0].endswith(".parquet")
    assert target.count() > 0 and source.select("incident_id").distinct().count() == source.count() > 0


def test_tables_and_files_are_written_by_compiled_methods(spark, tmp_path, monkeypatch):
    """Sessions whose Java leaves long methods to its interpreter get short ones, while the library writes, and others are left as they are."""
    from pyspark.sql.readwriter import DataFrameWriter

    from strata import session
    from strata.sources import io

    seen, before = [], spark.conf.get(session.METHOD_LIMIT, None)
    for name in ("csv", "saveAsTable"):
        def spied(self, *args, _real=getattr(DataFrameWriter, name), **options):
            seen.append(spark.conf.get(session.METHOD_LIMIT, None))
            return _real(self, *args, **options)
        monkeypatch.setattr(DataFrameWriter, name, spied)
    df, flag = spark.range(10).selectExpr("CAST(id AS STRING) AS a"), session.JIT_FLAG
    for own in (flag, "-XX:-NoSuchFlag"):
        monkeypatch.setattr(session, "JIT_FLAG", own)
        io.write_csv(df, str(tmp_path / "csv"))
        assert io.read_csv(spark, str(tmp_path / "csv")).count() == 10
        assert io.write_table(df, "compiled_test", "overwrite", str(tmp_path / "table")).count() == 10
    assert seen == [before, before, "8000", "8000"]
    assert spark.conf.get(session.METHOD_LIMIT, None) == before
