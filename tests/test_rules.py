"""Data-quality rules: NULL policies, first-match status, issue counts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.functions import rules
from strata.plans import silver_financial, silver_incidents, silver_market


def test_rule_null_policies(spark):
    df = spark.createDataFrame([("2021-0001-001",), (" 2021-0001-001",), ("BAD7",), (None,)], "v string")
    got = [r[0] for r in df.select(rules.matches("v", rules.INCIDENT_ID_PATTERN)).collect()]
    assert got == [0, 1, 1, 1]
    df2 = spark.createDataFrame([(-1.0,), (5.0,), (9000.0,), (None,)], "v double")
    assert [r[0] for r in df2.select(rules.between("v", 0, 8760)).collect()] == [1, 0, 1, 0]
    assert [r[0] for r in df2.select(rules.between("v", 0, 8760, null_issue=True)).collect()] == [1, 0, 1, 1]


def test_country_and_industry(spark):
    df = spark.createDataFrame([("US",), ("USA",), ("UNITED STATES",), ("UNKNOWN",), (None,)], "country_hq string")
    r = silver_incidents.issue_rules()["country_format"]
    assert [x[0] for x in df.select(r).collect()] == [0, 0, 0, 1, 1]
    df2 = spark.createDataFrame([("52",), ("44-45",), ("5",), (None,)], "industry_primary string")
    r2 = silver_incidents.issue_rules()["industry_format"]
    assert [x[0] for x in df2.select(r2).collect()] == [0, 0, 1, 1]


def test_date_flag_first_match(spark):
    d = dt.date
    data = [
        (None, d(2020, 1, 1), d(2020, 1, 1)),            # invalid incident date
        (d(2020, 1, 10), d(2020, 1, 1), d(2019, 1, 1)),  # discovery before incident wins
        (d(2020, 1, 1), d(2020, 1, 10), d(2020, 1, 5)),  # disclosure before discovery
        (d(2030, 1, 1), None, None),                     # future vs as_of
        (d(2020, 1, 10), None, d(2020, 1, 1)),           # disclosure before incident, no discovery: OK
    ]
    df = spark.createDataFrame(data, "incident_date date, discovery_date date, disclosure_date date")
    got = [r[0] for r in df.select(silver_incidents.date_flag("2025-01-01 00:00:00")).collect()]
    assert got == ["INVALID_INCIDENT_DATE", "DISCOVERY_BEFORE_INCIDENT", "DISCLOSURE_BEFORE_DISCOVERY",
                   "INCIDENT_IN_FUTURE", "OK"]


def test_issue_count_is_sum_of_rules(spark, sf_small):
    from strata.sources import fixtures as fx

    typed = silver_financial.typed(fx.raw_financial(spark, sf_small))
    r = silver_financial.issue_rules()
    out = typed.select(silver_financial.dq_issue_count().alias("n"), *[c.alias(k) for k, c in r.items()])
    bad = out.where(F.col("n") != sum(F.col(k) for k in r)).count()
    assert bad == 0


def test_loss_range_and_cpi_pair(spark):
    df = spark.createDataFrame([(5.0, 1.0, 2021, 1.0), (1.0, None, None, 1.0), (1.0, 5.0, None, None)],
                               "total_loss_lower_bound double, total_loss_upper_bound double, cpi_year int, "
                               "cpi_value double")
    r = silver_financial.issue_rules()
    got = [tuple(x) for x in df.select(r["loss_range"], r["cpi_pair"]).collect()]
    assert got == [(1, 0), (0, 1), (0, 0)]


def test_p_value_flags(spark):
    df = spark.createDataFrame([(-0.1,), (0.0,), (1.0,), (1.1,), (None,)], "p_value_1d double")
    flag = silver_market.flag_rules()["dq_invalid_p_value_1d"]
    assert [x[0] for x in df.select(flag).collect()] == [1, 0, 0, 1, 0]


def test_key_case_unifies_feeds(spark, sf_small):
    from strata.sources import fixtures as fx

    fin = silver_financial.typed(fx.raw_financial(spark, sf_small), key_case="lower")
    assert fin.where(F.col("incident_id") == "unknown").count() > 0          # hot key kept, folded
    default = silver_financial.typed(fx.raw_financial(spark, sf_small))
    assert default.where(F.col("incident_id") == "UNKNOWN").count() > 0      # reference policy


def test_market_lenient_int(spark):
    raw = spark.createDataFrame([("2021-0000-001", "12.0", "7.0")],
                                "incident_id string, volume_avg_30d_baseline string, days_to_price_recovery string")
    for c in silver_market.NUMERIC_TYPES:
        if c not in raw.columns:
            raw = raw.withColumn(c, F.lit(None).cast("string"))
    for c in ("stock_ticker", "sector_index", "earnings_announcement_within_7d", "notes", "created_at", "updated_at",
              "ingestion_timestamp", "source_file"):
        raw = raw.withColumn(c, F.lit(None).cast("string"))
    strict = silver_market.typed(raw).first()
    lenient = silver_market.typed(raw, lenient_int=True).first()
    assert (strict.volume_avg_30d_baseline, strict.days_to_price_recovery) == (None, None)
    assert (lenient.volume_avg_30d_baseline, lenient.days_to_price_recovery) == (12, 7)


@pytest.mark.parametrize("engine", ["spark", "duckdb"])
def test_incident_ids_are_injective(spark, engine):
    """Distinct ids for distinct keys around the lengths at which a cut would show."""
    import duckdb

    from strata.sources import fixtures as fx

    starts = (0, 10 ** 7 - 50, 10 ** 10 - 50, 10 ** 11 - 50, 10 ** 12)
    keys = [a + i for a in starts for i in range(100)]
    if engine == "spark":
        df = spark.createDataFrame([(k,) for k in keys], "k long").selectExpr(f"{fx._incident_id(fx.SPARK, 'k')} AS id")
        ids = [r.id for r in df.collect()]
    else:
        duckdb_keys = ", ".join(f"({k})" for k in keys)
        ids = [r[0] for r in duckdb.sql(f"SELECT {fx._incident_id(fx.DUCK, 'k')} FROM (VALUES {duckdb_keys}) t(k)").fetchall()]
    assert len(set(ids)) == len(keys) and sorted(int(i.replace("-", "")) for i in ids) == sorted(keys)
    assert all(len(i) == 13 for i, k in zip(ids, keys) if k < 10 ** 11)
