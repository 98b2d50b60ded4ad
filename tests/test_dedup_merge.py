"""Winner per key and upsert semantics."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators import dedup, merge


def _winners(spark, parts):
    data = [("a", 1.0, 1, "x1"), ("a", 2.0, 1, "x2"), ("a", 2.0, 2, "x3"),   # tie on score -> 2nd key decides
            ("b", None, 9, "y1"), ("b", 0.5, 1, "y2"),                       # NULL score sorts last on DESC
            (None, 1.0, 1, "n1"), (None, 3.0, 1, "n2"),                      # NULL keys form one group
            ("c", 1.0, 1, "z2"), ("c", 1.0, 1, "z1")]                        # full tie -> tiebreak column
    df = spark.createDataFrame(data, "k string, score double, upd int, note string").repartition(parts)
    order = [F.col("score").desc_nulls_last(), F.col("upd").desc_nulls_last()]
    return sorted((r.k or "", r.note) for r in dedup.winner(df, "k", order, tiebreak=["note"]).collect())


def test_winner_semantics_and_partition_independence(spark):
    expect = [("", "n2"), ("a", "x3"), ("b", "y2"), ("c", "z1")]
    assert _winners(spark, 1) == expect
    assert _winners(spark, 7) == expect


def test_winner_default_tiebreak_is_reproducible(spark):
    df = spark.createDataFrame([("k", i % 2, f"v{i}") for i in range(50)], "k string, s int, v string")
    a = dedup.winner(df.repartition(3), "k", [F.col("s").desc()]).collect()
    b = dedup.winner(df.repartition(11), "k", [F.col("s").desc()]).collect()
    assert a == b


def test_winner_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedup.winner(df, "k", [F.col("v").desc()], tiebreak=["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert plan.count("WindowGroupLimit") >= 2  # partial (map side) + final


T0 = dt.datetime(2026, 1, 1)


def _merge_frames(spark):
    schema = "incident_id string, v string, ts timestamp, stamp timestamp"
    target = spark.createDataFrame([
        ("old", "t-old", T0, T0),                            # source newer -> update
        ("newer", "t-newer", T0 + dt.timedelta(days=5), T0),  # target newer -> keep
        ("nullts", "t-nullts", None, T0),                    # target time NULL -> update
        ("srcnull", "t-srcnull", T0, T0),                    # source time NULL -> keep
        ("only_t", "t-only", T0, T0),                        # no source row -> keep
        (None, "t-nullkey", T0, T0),                         # NULL key never matches -> keep
    ], schema)
    source = spark.createDataFrame([
        ("old", "s-old", T0 + dt.timedelta(days=1)),
        ("newer", "s-newer", T0 + dt.timedelta(days=1)),
        ("nullts", "s-nullts", T0),
        ("srcnull", "s-srcnull", None),
        ("only_s", "s-only", T0),                            # new key -> insert
        (None, "s-nullkey", T0),                             # NULL key -> insert
    ], "incident_id string, v string, ts timestamp")
    return target, source


def test_upsert_newer_only(spark):
    target, source = _merge_frames(spark)
    as_of = "2026-02-01 00:00:00"
    out = merge.upsert(target, source, "incident_id", when=merge.newer_only("ts"), stamp_col="stamp", as_of=as_of)
    got = {(r.incident_id, r.v, r.stamp == dt.datetime(2026, 2, 1)) for r in out.collect()}
    assert got == {("old", "s-old", True), ("newer", "t-newer", False), ("nullts", "s-nullts", True),
                   ("srcnull", "t-srcnull", False), ("only_t", "t-only", False), (None, "t-nullkey", False),
                   ("only_s", "s-only", True), (None, "s-nullkey", True)}


def test_upsert_unconditional_keeps_missing_columns(spark):
    target = spark.createDataFrame([("a", "t", 7)], "incident_id string, v string, extra int")
    source = spark.createDataFrame([("a", "s"), ("b", "s2")], "incident_id string, v string")
    got = sorted(tuple(r) for r in merge.upsert(target, source, "incident_id").collect())
    assert got == [("a", "s", 7), ("b", "s2", None)]


def test_metrics_partition_the_output(spark):
    target, source = _merge_frames(spark)
    m = merge.metrics(target, source, "incident_id", when=merge.newer_only("ts")).first()
    assert (m.num_updated_rows, m.num_inserted_rows, m.num_unchanged_rows) == (2, 2, 4)
    assert m.num_updated_rows + m.num_inserted_rows + m.num_unchanged_rows == m.num_output_rows == 8


def test_counts_are_taken_while_the_merge_is_written(spark, tmp_path):
    """One action: every source row is read once, and the counts are those of a join of its own."""
    target, source = _merge_frames(spark)
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(v):
        read.add(1)
        return v

    def sink(df):
        df.write.parquet(str(tmp_path / "merged"))
        return spark.read.parquet(str(tmp_path / "merged"))

    how = {"when": merge.newer_only("ts")}
    # both branches of the merge (with and without a key) read the source: each of its rows goes through one of them
    noted = source.select("incident_id", counted("v").alias("v"), "ts")
    done = merge.write(target, noted, "incident_id", sink, stamp_col="stamp", as_of="2026-02-01 00:00:00", unique=False, **how)
    assert read.value == source.count()
    assert done.counts == merge.metrics(target, source, "incident_id", **how).first().asDict()
    want = merge.upsert(target, source, "incident_id", stamp_col="stamp", as_of="2026-02-01 00:00:00", **how)
    assert sorted(map(tuple, done.table.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert done.counts["num_output_rows"] == done.table.count() == 8


def test_counts_of_bucketed_and_empty_merges(spark):
    from strata.sources import io

    target, source = _merge_frames(spark)
    io.ensure_schemas(spark, ["silver"])
    loc = io.table_location(spark, "silver.observed", "merge-test")
    sink = lambda df: io.write_table(df, "silver.observed", "overwrite", loc, bucket_by=(4, ["incident_id"]), sort_by=["incident_id"])
    done = merge.write(target, source, "incident_id", sink)
    assert done.counts == merge.metrics(target, source, "incident_id").first().asDict()
    none = merge.write(target, source.limit(0), "incident_id", sink)
    assert none.counts == {"num_updated_rows": 0, "num_inserted_rows": 0, "num_unchanged_rows": 6, "num_affected_rows": 0, "num_output_rows": 6}
    with pytest.raises(Exception, match="duplicate key"):
        merge.write(target, source.unionByName(source), "incident_id", sink)


def test_rerun_changes_nothing(spark):
    target, source = _merge_frames(spark)
    source = source.where(F.col("ts").isNotNull())
    once = merge.upsert(target, source, "incident_id", when=merge.newer_only("ts"), stamp_col="stamp",
                        as_of="2026-02-01 00:00:00")
    once = spark.createDataFrame(once.collect(), once.schema)
    twice = merge.upsert(once, source.where(F.col("incident_id").isNotNull()), "incident_id",
                         when=merge.newer_only("ts"), stamp_col="stamp", as_of="2026-03-01 00:00:00")
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)


def _exchanges(df) -> int:
    spark = df.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("unique", [True, False])
def test_winners_are_shuffled_once_each(spark, unique):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target, source = (dedup.winner(df.where("incident_id is not null"), "incident_id", [F.col("ts").desc()], tiebreak=["v"])
                          for df in _merge_frames(spark))
        assert _exchanges(merge.upsert(target, source, "incident_id", unique=unique)) <= 4  # two joined, two for NULL keys
        keyed = merge._rows(target, source, "incident_id", None, unique)
        plan = keyed._jdf.queryExecution().executedPlan().toString()
        assert "Cartesian" not in plan and "NestedLoop" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_duplicate_source_keys_are_refused(spark):
    target = spark.createDataFrame([("a", "t")], "incident_id string, v string")
    source = spark.createDataFrame([("a", "s1"), ("a", "s2"), (None, "n1"), (None, "n2")], "incident_id string, v string")
    with pytest.raises(Exception, match="duplicate key a"):
        merge.upsert(target, source, "incident_id").collect()
    with pytest.raises(Exception, match="duplicate key a"):
        merge.metrics(target, source, "incident_id").collect()
    one = source.where("v <> 's2'")
    assert sorted(r.v for r in merge.upsert(target, one, "incident_id").collect()) == ["n1", "n2", "s1"]


def test_assert_unique(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,)], "incident_id string")
    with pytest.raises(ValueError):
        merge.assert_unique(df, "incident_id")
    merge.assert_unique(df.where("incident_id IS NULL"), "incident_id")


def test_silver_build_independent_of_partitioning(spark, sf_small):
    """Same rows whatever the input partitioning and shuffle width (default hash tie-break)."""
    from strata.plans import silver_financial
    from strata.sources import fixtures as fx

    raw = fx.raw_financial(spark, sf_small)
    results = []
    for parts, shuffle in ((1, 3), (7, 8), (13, 17)):
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle))
        out = silver_financial.build(raw.repartition(parts), as_of="2001-01-01 00:00:00")
        results.append(sorted(map(tuple, out.collect()), key=repr))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert results[0] == results[1] == results[2]


def test_every_silver_has_one_row_per_key(spark, sf_small):
    from strata.plans import silver_financial, silver_incidents, silver_market
    from strata.sources import fixtures as fx

    builds = [silver_incidents.build(fx.raw_incidents(spark, sf_small), as_of="2001-01-01 00:00:00"),
              silver_financial.build(fx.raw_financial(spark, sf_small), as_of="2001-01-01 00:00:00"),
              silver_market.build(fx.raw_market(spark, sf_small))]
    for df in builds:
        per_key = df.groupBy("incident_id").count()
        assert per_key.where("count > 1").count() == 0
        assert df.count() == per_key.count()


def test_hot_key_third_of_rows(spark):
    """One key holds a third of the rows: the winner is still exact, and the
    plan limits rows per key before the shuffle (partial WindowGroupLimit)."""
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 1000).cast("string")).alias("k"),
        F.col("id").alias("v")).repartition(16)
    w = dedup.winner(df, "k", [F.col("v").desc()], tiebreak=["v"])
    got = {r.k: r.v for r in w.collect()}
    assert got["HOT"] == max(i for i in range(n) if i % 3 == 0)
    assert len(got) == 1 + len({str(i % 1000) for i in range(n) if i % 3})
    plan = w._jdf.queryExecution().executedPlan().toString()
    exch = plan.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in plan[exch:]  # a limit below (map side of) the exchange
