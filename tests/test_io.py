"""Sources and sinks: CSV round trip, lineage, table overwrite / replace / append, describe, inventory."""

import datetime as dt
import os
import tempfile

from strata import schemas
from strata.sources import io


def test_csv_round_trip_keeps_whitespace_and_nulls(spark):
    path = os.path.join(tempfile.mkdtemp(prefix="strata-csv-"), "f")
    df = spark.createDataFrame([(" a ", None), ("b,c", "  ")], "x string, y string")
    io.write_csv(df, path)
    back = io.read_csv(spark, path)
    assert back.dtypes == [("x", "string"), ("y", "string")]
    assert sorted(tuple(r) for r in back.collect()) == [(" a ", None), ("b,c", "  ")]


def test_lineage_columns(spark):
    df = io.add_lineage(spark.range(2), "file.csv", as_of="2026-01-01 00:00:00")
    r = df.first()
    assert r.source_file == "file.csv" and r.ingestion_timestamp == dt.datetime(2026, 1, 1)


def test_overwrite_is_idempotent_and_append_adds(spark):
    io.ensure_schemas(spark, ["bronze", "audit"])
    assert spark.catalog.databaseExists("bronze") and spark.catalog.databaseExists("audit")
    loc = io.table_location(spark, "bronze.t_idem", "test")
    df = spark.range(5)
    io.write_table(df, "bronze.t_idem", "overwrite", loc)
    assert io.write_table(df, "bronze.t_idem", "overwrite", loc).count() == 5
    assert io.write_table(df, "bronze.t_idem", "append", loc).count() == 10


def test_create_table_replace_vs_if_absent(spark):
    io.ensure_schemas(spark, ["audit"])
    loc = io.table_location(spark, "audit.m", "test")
    io.create_table(spark, "audit.m", schemas.METRICS, replace=True, path=loc)
    row = spark.createDataFrame([("bronze", "t", "c", 1, 50.0, 2, dt.datetime(2026, 1, 1))], schemas.METRICS)
    io.write_table(row, "audit.m", "append", loc)
    assert io.create_table(spark, "audit.m", schemas.METRICS).count() == 1       # exists: kept
    assert io.create_table(spark, "audit.m", schemas.METRICS, replace=True, path=loc).count() == 0


def test_describe_and_inventory(spark, sf_small):
    df = spark.createDataFrame([(1, "a")], "id bigint, s string")
    assert [tuple(r) for r in io.describe(df).collect()] == [("id", "bigint", 1), ("s", "string", 2)]
    inv = io.file_inventory(spark.read.parquet(f"{sf_small}/nation.parquet")).collect()
    assert [(r.file_name, r.rows) for r in inv] == [("nation.parquet", 25)]


def test_conform_fills_and_orders(spark):
    df = spark.createDataFrame([("x", 1)], "incident_id string, dq_issue_count bigint")
    out = schemas.conform(df, schemas.FINANCIAL)
    assert out.columns == [f.name for f in schemas.FINANCIAL.fields]
    assert dict(out.dtypes)["dq_issue_count"] == "int"


def test_scale_conf():
    from strata.session import scale_conf

    c = scale_conf(100 * 2 ** 40, 8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 16384
    assert int(scale_conf(1, 8)["spark.sql.shuffle.partitions"]) == 16


def test_bucketed_silvers_make_gold_joins_shuffle_free(spark, sf_small):
    from strata.plans import gold, silver_financial, silver_incidents, silver_market
    from strata.sources import fixtures as fx

    io.ensure_schemas(spark, ["silver"])
    built = {
        "silver.incidents_master": silver_incidents.build(fx.raw_incidents(spark, sf_small), as_of="2001-01-01"),
        "silver.financial_impact": silver_financial.build(fx.raw_financial(spark, sf_small), as_of="2001-01-01"),
        "silver.market_impact": silver_market.build_table(fx.raw_market(spark, sf_small), as_of="2001-01-01"),
    }
    tables = {n: io.write_table(df, n, "overwrite", io.table_location(spark, n, "bucketed"),
                                bucket_by=(8, ["incident_id"]), sort_by=["incident_id"])
              for n, df in built.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = gold.build(tables["silver.incidents_master"], fx.dim_country(spark, sf_small),
                          tables["silver.financial_impact"], tables["silver.market_impact"])
        plan = fact._jdf.queryExecution().executedPlan().toString()
        n = fact.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert "Exchange hashpartitioning" not in plan
    assert n == built["silver.incidents_master"].count()


def test_stamp_literals_and_clock(spark):
    from strata.functions import clean

    out = clean.stamp(spark.range(1), as_of="2026-01-01 00:00:00", layer="bronze", profiled_at=None).first()
    assert out.layer == "bronze" and out.profiled_at == dt.datetime(2026, 1, 1)


def test_left_lookup_broadcasts_only_within_bound(spark):
    from strata.operators import joins

    facts = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("z", 4)], "k string, v int")
    dim = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "code string, name string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        small = joins.left_lookup(facts, dim, "k", "code", ["name"], max_bytes=1000)
        big = joins.left_lookup(facts, dim, "k", "code", ["name"], max_bytes=3)
        p_small = small._jdf.queryExecution().executedPlan().toString()
        p_big = big._jdf.queryExecution().executedPlan().toString()
        got_small, got_big = sorted(map(tuple, small.collect()), key=repr), sorted(map(tuple, big.collect()), key=repr)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastExchange" in p_small and "BroadcastExchange" not in p_big
    assert got_small == got_big == sorted([("a", 1, "A"), ("b", 2, "B"), (None, 3, None), ("z", 4, None)], key=repr)


def test_session_leaves_the_master_to_spark_submit(monkeypatch):
    """Without a master none is set; local sessions get the JIT flag beside the caller's options."""
    from strata import session

    seen = {}

    class Builder:
        def appName(self, name):
            return self

        def master(self, m):
            seen["master"] = m
            return self

        def config(self, k, v):
            seen[k] = v
            return self

        def getOrCreate(self):
            class S:
                class sparkContext:  # noqa: N801
                    @staticmethod
                    def setLogLevel(level):
                        pass
            return S()

    class Fake:
        builder = Builder()

    monkeypatch.setattr(session, "SparkSession", Fake)
    session.get_session()
    assert "master" not in seen and "spark.driver.extraJavaOptions" not in seen
    session.get_session(master="local[2]", extra={"spark.driver.extraJavaOptions": "-Xss8m"})
    assert seen["master"] == "local[2]" and seen["spark.driver.extraJavaOptions"] == f"-Xss8m {session.JIT_FLAG}"


def test_drop_shared_keeps_to_the_shared_folder(spark):
    import pytest

    from strata.session import drop_shared, shared_dir

    path = shared_dir(spark, "drop", "me")
    spark.range(3).write.parquet(path)
    assert drop_shared(spark, path) and not drop_shared(spark, path)
    with pytest.raises(ValueError):
        drop_shared(spark, "/elsewhere")
