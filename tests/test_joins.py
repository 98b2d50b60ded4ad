"""Lookups beyond the broadcast bound: hot keys salted."""

import pytest
from pyspark.sql import functions as F

from strata.operators import joins

N, PARTS = 60_000, 16


@pytest.fixture(scope="module")
def facts(spark):
    """A third of the rows on one key, a sixth without a key, a tenth on a second key, the rest spread over 3,000 keys."""
    i = F.col("id")
    key = F.when(i % 3 == 0, "hot").when(i % 6 == 1, None).when(i % 10 == 2, "warm").otherwise(F.concat(F.lit("k"), i % 3000))
    return spark.range(N, numPartitions=8).select("id", key.alias("k"), (i % 7).alias("v"))


@pytest.fixture(scope="module")
def dim(spark):
    codes = ["hot", "warm", *[f"k{i}" for i in range(0, 3000, 2)], "unused"]
    return spark.createDataFrame([(c, f"name of {c}", None) for c in codes] + [(None, "no key", 1)], "code string, name string, extra int")


@pytest.fixture
def wide(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(PARTS))
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    for k, v in before.items():
        spark.conf.set(k, v)


def test_a_third_of_the_rows_on_one_key(facts, dim, wide):
    looked = joins.left_lookup(facts, dim, "k", "code", ["name", "extra"], max_bytes=0, least_hot_rows=100)
    assert looked.columns == ["id", "k", "v", "name", "extra"]
    plan = looked._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("Exchange hashpartitioning") == 2
    sizes = [r["n"] for r in looked.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == N and max(sizes) < 2 * N / PARTS  # unsalted, the hot key alone is 5.3 times the share of a task
    assert looked.where("NOT (name <=> CASE WHEN k IN ('hot', 'warm') OR substr(k, 2) % 2 = 0 THEN 'name of ' || k END)"
                        " AND k IN ('hot', 'warm')").count() == 0
    plain = joins.left_lookup(facts, dim, "k", "code", ["name", "extra"])
    assert looked.exceptAll(plain).count() == 0 == plain.exceptAll(looked).count()


def test_hot_keys_are_bounded_and_their_parts_fit(facts):
    hashed = F.when(F.col("k").isNotNull(), F.xxhash64("k"))
    slots = 4 * PARTS
    found = joins.hot_keys(facts, hashed, slots, least_rows=100)
    parts = {h: n for n, hs in found.items() for h in hs}
    counts = {r["h"]: r["n"] for r in facts.where("k is not null").groupBy(F.xxhash64("k").alias("h")).agg(F.count(F.lit(1)).alias("n")).collect()}
    share = sum(counts.values()) / slots
    assert set(parts) == {h for h, n in counts.items() if n > share} and len(parts) == 2
    assert all(counts[h] / n <= share for h, n in parts.items()) and sum(parts.values()) <= 2 * slots
    assert joins.hot_keys(facts, hashed, slots, least_rows=N) == {}
    assert joins.hot_keys(facts.limit(0), hashed, slots) == {}


def test_many_columns_in_the_key_and_columns_to_salt_by(spark, facts, wide):
    two = facts.select("id", F.col("v").alias("a"), F.when(F.col("k") == "hot", 1).otherwise(F.col("id") % 50).alias("b"))
    dim = spark.createDataFrame([(a, b, f"{a}/{b}") for a in range(7) for b in range(0, 50, 3)] + [(None, 1, "x")], "x long, y long, name string")
    looked = joins.salted_lookup(two, dim, ["a", "b"], ["x", "y"], ["name"], salt_by=["id"], least_rows=10)
    assert looked.count() == N
    assert looked.where("NOT (name <=> if(b % 3 = 0, a || '/' || b, NULL))").count() == 0
    empty = joins.left_lookup(two, dim.limit(0), ["a", "b"], ["x", "y"], ["name"], max_bytes=-1, least_hot_rows=10)
    assert empty.where("name is not null").count() == 0 and empty.count() == N
    assert joins.left_lookup(two.limit(0), dim, ["a", "b"], ["x", "y"], ["name"], max_bytes=0).count() == 0
