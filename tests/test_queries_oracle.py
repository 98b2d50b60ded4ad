"""Every registered query against its DuckDB oracle on the smallest scale factor."""

import os
import sys
from collections import Counter

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
from strata import oracle, registry  # noqa: E402
from check_oracle import TABLES, compare  # noqa: E402

SF = "/root/testdata/sf0.001"
KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


#: SQL over the tables does not know the folder they lie in.
WITHOUT_SQL = {"folder_listing"}


def test_every_key_has_an_oracle():
    assert len(KEYS) == 86
    assert set(KEYS) - WITHOUT_SQL == set(oracle.oracle_sql())


def test_folder_listing_against_the_file_system(spark):
    got = {r.file_name: r["length"] for r in registry.queries()["folder_listing"](spark, SF).collect()}
    assert got == {n: os.path.getsize(f"{SF}/{n}") for n in os.listdir(SF)} and len(got) == 14


@pytest.mark.parametrize("key", [k for k in KEYS if k not in WITHOUT_SQL])
def test_query_matches_oracle(spark, duck, key):
    df = registry.queries()[key](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = duck.execute(oracle.oracle_sql()[key])
    drows = cur.fetchall()
    strict, loose, msg = compare(srows, df.columns, drows, [d[0] for d in cur.description])
    assert strict, msg


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "total_loss_revenue_ratio" in df.columns
    assert Counter(df.columns)["incident_id"] == 1


PY_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
            "CartesianProduct", "BroadcastNestedLoopJoin")


#: Keys whose work is matrix products in tasks.
IN_NUMPY = {"correlation_matrix_wide"}


@pytest.mark.parametrize("key", KEYS)
def test_plans_stay_in_the_jvm(spark, key):
    """No Python UDF, no cartesian or nested-loop join in any registered query."""
    plan = registry.queries()[key](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [n for n in PY_NODES if n in plan]
    assert ("MapInArrow" in plan) == (key in IN_NUMPY)
