"""Raw (bronze-shaped) views derived from the driver's TPC-H-ish tables.

The reference reads three CSV files about security incidents; no such data
ships with it.  These views rebuild inputs of the same shape from ``orders``,
``lineitem``, ``events`` and ``nation`` so that every query scales with those
tables.  Every raw column is STRING (bronze types are data dependent), plus the
two lineage columns ``ingestion_timestamp`` (TIMESTAMP) and ``source_file``.

Each column is one SQL expression written once and rendered for two dialects:
Spark (evaluated with ``DataFrame.selectExpr``) and DuckDB (used by the oracle
SQL).  Only constructs with identical results in both engines are used: integer
arithmetic, exact decimals, ``||`` on non-NULL text, ``lpad``, ``chr``, CASE,
fixed-format date/time rendering.  Dirty values (padding, case, NULL tokens,
thousands commas, bad formats, out-of-range numbers, duplicates per key) are
injected at fixed residues of the row keys.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strata.session import shared_dir, spread


@dataclass(frozen=True)
class Dialect:
    name: str

    @property
    def spark(self) -> bool:
        return self.name == "spark"

    def s(self, x: str) -> str:
        return f"CAST({x} AS STRING)"

    def idiv(self, a: str, b: int | str) -> str:
        return f"({a} div {b})" if self.spark else f"({a} // {b})"

    def add_days(self, d: str, n: str) -> str:
        if self.spark:
            return f"date_add(CAST({d} AS DATE), CAST({n} AS INT))"
        return f"(CAST({d} AS DATE) + CAST({n} AS INTEGER))"

    def add_secs(self, ts: str, n: str) -> str:
        if self.spark:
            return f"timestampadd(SECOND, CAST({n} AS BIGINT), {ts})"
        return f"({ts} + to_seconds(CAST({n} AS BIGINT)))"

    def fmt_date(self, d: str) -> str:
        if self.spark:
            return f"date_format({d}, 'yyyy-MM-dd')"
        return f"strftime({d}, '%Y-%m-%d')"

    def fmt_ts(self, ts: str, iso: bool = False) -> str:
        if self.spark:
            pat = "yyyy-MM-dd'T'HH:mm:ss" if iso else "yyyy-MM-dd HH:mm:ss"
            return f"date_format({ts}, \"{pat}\")"
        pat = "%Y-%m-%dT%H:%M:%S" if iso else "%Y-%m-%d %H:%M:%S"
        return f"strftime({ts}, '{pat}')"

    def ts_lit(self, text: str) -> str:
        return f"TIMESTAMP '{text}'"


SPARK = Dialect("spark")
DUCK = Dialect("duckdb")


def _incident_id(D: Dialect, k: str) -> str:
    """``dddd-dddd-ddd`` text of a non-negative integer key: its 11 digits.

    A longer key gives a longer last part (which then fails the format rule), so
    the text is injective for every key.
    """
    digits = f"CASE WHEN {k} < 100000000000 THEN lpad({D.s(k)}, 11, '0') ELSE {D.s(k)} END"
    return f"(substr({digits}, 1, 4) || '-' || substr({digits}, 5, 4) || '-' || substr({digits}, 9))"


def _money(D: Dialect, cents: str, comma: str = "FALSE") -> str:
    """Text of a non-negative amount in cents, optionally with a thousands comma."""
    whole = D.idiv(cents, 100)
    frac = f"lpad({D.s(f'{cents} % 100')}, 2, '0')"
    grouped = (
        f"{D.s(D.idiv(cents, 100000))} || ',' || lpad({D.s(f'{whole} % 1000')}, 3, '0')"
        f" || '.' || {frac}"
    )
    return f"CASE WHEN ({comma}) AND {whole} >= 1000 THEN {grouped} ELSE {D.s(whole)} || '.' || {frac} END"


def _dec6(D: Dialect, n: str) -> str:
    """Text of the signed integer ``n`` scaled by 1e-6 (six decimals)."""
    a = f"abs({n})"
    return (
        f"CASE WHEN {n} < 0 THEN '-' ELSE '' END || {D.s(D.idiv(a, 1000000))} || '.'"
        f" || lpad({D.s(f'{a} % 1000000')}, 6, '0')"
    )


# ---------------------------------------------------------------------------
# raw_incidents: one row per order, plus an older copy of every 10th order.
# ---------------------------------------------------------------------------

def incidents_columns(D: Dialect) -> list[tuple[str, str]]:
    k, c = "o_orderkey", "o_custkey"
    idk = _incident_id(D, k)
    S = D.s
    score = f"lpad({S(f'({k} * 7919) % 10000')}, 4, '0')"
    minute = f"({k} % 1440) * 60"
    return [
        ("incident_id", f"CASE WHEN {k} % 499 = 0 THEN NULL WHEN {k} % 211 = 0 THEN 'INC' || {S(k)}"
                        f" WHEN {k} % 7 = 0 THEN '  ' || {idk} || ' ' ELSE {idk} END"),
        ("company_name", f"' company ' || {S(c)} || ' '"),
        ("company_revenue_usd", f"CASE WHEN {c} % 61 = 0 THEN NULL WHEN {c} % 71 = 0 THEN '0'"
                                f" WHEN {c} % 67 = 0 THEN '2e13' WHEN {c} % 53 = 0 THEN '-' || {S(f'{c} * 1000000')}"
                                f" ELSE {S(f'({c} + 1) * 1000000')} END"),
        ("country_hq", f"CASE WHEN {c} % 89 = 0 THEN NULL WHEN {c} % 37 = 0 THEN 'Unknown'"
                       f" WHEN {c} % 25 = 24 THEN ' usa' WHEN {c} % 25 = 23 THEN 'United States '"
                       f" ELSE ' n' || chr(CAST(97 + {c} % 25 AS INT)) END"),
        ("industry_primary", f"CASE WHEN {c} % 47 = 0 THEN NULL WHEN {c} % 43 = 0 THEN '5'"
                             f" WHEN {k} % 3 = 0 THEN {S(f'10 + {c} % 90')} || '-' || {S(f'10 + {k} % 90')}"
                             f" ELSE ' ' || {S(f'10 + {c} % 90')} END"),
        ("industry_secondary", f"CASE WHEN {k} % 6 = 0 THEN NULL ELSE {S(f'10 + {k} % 90')} || ' ' END"),
        ("employee_count", f"CASE WHEN {c} % 73 = 0 THEN NULL WHEN {c} % 59 = 0 THEN '0'"
                           f" WHEN {c} % 79 = 0 THEN '20000000' ELSE {S(f'10 * ({c} + 1)')} END"),
        ("is_public_company", f"CASE WHEN {c} % 83 = 0 THEN NULL WHEN {c} % 2 = 0 THEN 'true' ELSE 'false' END"),
        ("stock_ticker", f"' t' || {S(c)}"),
        ("incident_date", f"CASE WHEN {k} % 113 = 0 THEN NULL ELSE {D.fmt_date('o_orderdate')} END"),
        ("incident_date_estimated", f"CASE WHEN {k} % 4 = 0 THEN 'true' ELSE 'false' END"),
        ("discovery_date", f"CASE WHEN {k} % 19 = 0 THEN NULL"
                           f" WHEN {k} % 17 = 0 THEN {D.fmt_date(D.add_days('o_orderdate', '-3'))}"
                           f" ELSE {D.fmt_date(D.add_days('o_orderdate', f'{k} % 40'))} END"),
        ("disclosure_date", f"CASE WHEN {k} % 23 = 0 THEN NULL"
                            f" ELSE {D.fmt_date(D.add_days('o_orderdate', f'{k} % 90'))} END"),
        ("attack_vector_primary", f"CASE {k} % 4 WHEN 0 THEN 'Phishing' WHEN 1 THEN ' RANSOMWARE '"
                                  f" WHEN 2 THEN 'Credential Stuffing' ELSE 'supply chain ' END"),
        ("attack_vector_secondary", f"CASE WHEN {k} % 3 = 0 THEN NULL ELSE ' Malware ' END"),
        ("attack_chain", "' recon>exploit>exfil '"),
        ("attributed_group", f"' apt' || {S(f'{c} % 30')}"),
        ("attribution_confidence", f"CASE WHEN {k} % 31 = 0 THEN NULL ELSE CASE {k} % 5 WHEN 0 THEN 'Confirmed'"
                                   f" WHEN 1 THEN ' probable ' WHEN 2 THEN 'SUSPECTED' WHEN 3 THEN ' Unknown'"
                                   f" ELSE 'maybe' END END"),
        ("data_compromised_records", f"CASE WHEN {k} % 37 = 0 THEN NULL WHEN {k} % 41 = 0 THEN '0'"
                                     f" ELSE {S(f'{k} * 100 + 7')} END"),
        ("data_type", f"CASE WHEN {k} % 2 = 0 THEN ' pii ' ELSE 'Phi' END"),
        ("systems_affected", "' ERP, CRM '"),
        ("downtime_hours", f"CASE WHEN {k} % 29 = 0 THEN NULL WHEN {k} % 101 = 0 THEN '9000'"
                           f" WHEN {k} % 500 = 0 THEN '0' ELSE {S(f'({k} % 500) * 3')} || '.5' END"),
        ("data_source_primary", f"' source_' || {S(f'{k} % 3')}"),
        ("data_source_secondary", f"CASE WHEN {k} % 2 = 0 THEN NULL ELSE 'registry ' END"),
        ("data_source_type", "' NEWS '"),
        ("confidence_tier", f"CASE WHEN {k} % 59 = 0 THEN NULL WHEN {k} % 53 = 0 THEN '7'"
                            f" ELSE substr(o_orderpriority, 1, 1) END"),
        ("quality_score", f"CASE WHEN copy = 0 AND {k} % 43 = 0 THEN NULL"
                          f" WHEN copy = 1 AND {k} % 20 = 0 THEN '1.' || {score} ELSE '0.' || {score} END"),
        ("quality_grade", f"CASE WHEN {k} % 71 = 0 THEN NULL WHEN {k} % 67 = 0 THEN 'platinum'"
                          f" ELSE CASE o_orderstatus WHEN 'F' THEN ' gold' WHEN 'O' THEN 'Silver ' ELSE 'bronze' END END"),
        ("review_flag", f"CASE WHEN {k} % 2 = 0 THEN ' YES ' ELSE 'No' END"),
        ("notes", f"'incident note ' || {S(k)} || '/' || {S('copy')} || ' '"),
        ("created_at", D.fmt_ts(D.add_secs("o_orderdate", minute))),
        ("updated_at", f"CASE WHEN {k} % 47 = 0 THEN NULL ELSE "
                       f"{D.fmt_ts(D.add_secs('o_orderdate', f'{minute} + ({k} % 30) * 86400 - copy * 86400'))} END"),
        ("ingestion_timestamp", f"CASE WHEN copy = 1 THEN {D.ts_lit('2026-01-01 06:00:00')}"
                                f" ELSE {D.ts_lit('2026-01-02 06:00:00')} END"),
        ("source_file", "CASE WHEN copy = 1 THEN 'Incidents_Master_v0.csv' ELSE ' INCIDENTS_MASTER.csv ' END"),
    ]


# ---------------------------------------------------------------------------
# raw_financial: one row per lineitem, several per incident (= order).
# ---------------------------------------------------------------------------

def financial_columns(D: Dialect) -> list[tuple[str, str]]:
    k = "l_orderkey"
    S = D.s
    idk = _incident_id(D, k)
    q = "CAST(l_quantity AS BIGINT)"
    ep = "CAST(l_extendedprice AS DECIMAL(18,2))"
    cpi_val = f"{S('250 + l_partkey % 50')} || '.' || lpad({S('l_suppkey % 100')}, 2, '0')"
    total = f"{S(f'{ep} * 2 + {q}')}"
    return [
        ("incident_id", f"CASE WHEN l_partkey % 97 = 0 THEN 'N/A' WHEN l_partkey % 89 = 0 THEN ' null '"
                        f" WHEN l_partkey % 83 = 0 THEN '' WHEN l_partkey % 79 = 0 THEN 'unknown'"
                        f" WHEN l_linenumber % 3 = 0 THEN ' ' || {idk} || ' ' ELSE {idk} END"),
        ("direct_loss_method", "CASE l_linenumber % 3 WHEN 0 THEN ' estimated ' WHEN 1 THEN 'n/a' ELSE 'Reported' END"),
        ("total_loss_method", "CASE WHEN l_suppkey % 4 = 0 THEN 'NULL' ELSE ' modelled' END"),
        ("ransom_source", "CASE WHEN l_linenumber % 2 = 0 THEN '   ' ELSE ' Court Filing ' END"),
        ("notes", f"'fin ' || {S(k)} || '-' || {S('l_linenumber')} || '-' || {S('l_partkey')} || '-'"
                  f" || {S('l_suppkey')} || '-' || {S(q)} || '-' || {S(ep)}"),
        ("source_file", f"' Financial_Impact_' || {S('l_linenumber % 2')} || '.CSV '"),
        ("direct_loss_usd", f"CASE WHEN l_partkey % 37 = 0 THEN ' ' || {S(ep)} || ' ' ELSE {S(ep)} END"),
        ("ransom_demanded_usd", f"CASE WHEN l_discount > 0.05 THEN {S(f'{ep} * 2')} ELSE '' END"),
        ("ransom_paid_usd", f"CASE WHEN l_discount >= 0.08 THEN {S(ep)} ELSE '0' END"),
        ("recovery_cost_usd", f"CASE WHEN l_linenumber = 2 THEN {S(q)} || ',000.50' ELSE {S(f'{q} * 1000')} || '.50' END"),
        ("legal_fees_usd", f"CASE WHEN l_suppkey % 17 = 0 THEN '-' || {S(f'{q} * 10')} ELSE {S(f'{q} * 10')} END"),
        ("regulatory_fine_usd", f"CASE WHEN l_returnflag = 'R' THEN {S(f'{q} * 100')} ELSE '0' END"),
        ("insurance_payout_usd", f"CASE WHEN l_partkey % 7 = 0 THEN 'N/A'"
                                 f" WHEN l_linestatus = 'F' THEN {S(f'{q} * 500')} || '.25' ELSE NULL END"),
        ("total_loss_usd", f"CASE WHEN l_partkey % 29 = 0 THEN 'unknown' WHEN l_partkey % 31 = 0 THEN ''"
                           f" WHEN l_suppkey % 19 = 0 THEN '-' || {total} ELSE {total} END"),
        ("total_loss_lower_bound", S(ep)),
        ("total_loss_upper_bound", f"CASE WHEN l_partkey % 11 = 0 THEN NULL WHEN l_linenumber % 5 = 0 THEN '1.00'"
                                   f" ELSE {S(f'{ep} * 3')} END"),
        ("inflation_adjusted_usd", f"CASE WHEN l_suppkey % 3 = 0 THEN NULL ELSE {S(f'{ep} * 3')} END"),
        ("cpi_index_used", f"CASE WHEN l_partkey % 19 = 0 THEN NULL"
                           f" WHEN l_partkey % 13 = 0 THEN 'CPI-U ' || {S('year(l_shipdate)')}"
                           f" WHEN l_partkey % 17 = 0 THEN '(' || {cpi_val} || ')'"
                           f" ELSE 'CPI-U ' || {S('year(l_shipdate)')} || ' (' || {cpi_val} || ')' END"),
        ("created_at", D.fmt_ts("l_shipdate")),
        ("updated_at", f"CASE WHEN l_partkey % 23 = 0 THEN NULL"
                       f" ELSE {D.fmt_ts(D.add_secs('l_shipdate', 'l_linenumber * 86400'))} END"),
        ("ingestion_timestamp", D.add_secs(D.ts_lit("2026-02-01 00:00:00"), "(l_linenumber % 3) * 3600")),
    ]


# ---------------------------------------------------------------------------
# raw_market: two events per incident key (event_id div 2).
# ---------------------------------------------------------------------------

def market_columns(D: Dialect) -> list[tuple[str, str]]:
    e, u = "event_id", "user_id"
    S = D.s
    k = D.idiv(e, 2)
    idk = _incident_id(D, k)
    b = "CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT)"
    comma = f"{e} % 7 = 0"

    def signed(n: str, neg: str) -> str:
        return f"CASE WHEN {neg} THEN -({n}) ELSE {n} END"

    return [
        ("incident_id", f"CASE WHEN {e} % 97 = 0 THEN 'NA' WHEN {e} % 89 = 0 THEN ' null'"
                        f" WHEN {e} % 2 = 0 THEN ' ' || {idk} ELSE {idk} || '  ' END"),
        ("stock_ticker", f"CASE WHEN {u} % 23 = 0 THEN 'n/a' WHEN {u} % 29 = 0 THEN 'bad ticker!'"
                         f" ELSE ' T' || {S(u)} END"),
        ("price_7d_before", _money(D, f"{b} * 10", comma)),
        ("price_disclosure_day", _money(D, f"{b} * 9", comma)),
        ("price_1d_after", f"CASE WHEN event_type = 'error' AND {e} % 5 = 0 THEN '-' ELSE '' END"
                           f" || {_money(D, f'{b} * 8', comma)}"),
        ("price_7d_after", _money(D, f"{b} * 11", comma)),
        ("price_30d_after", f"CASE WHEN {e} % 9 = 0 THEN 'N/A' ELSE {_money(D, f'{b} * 12', comma)} END"),
        ("volume_avg_30d_baseline", f"CASE WHEN {e} % 13 = 0 THEN {S(u)} || '.0'"
                                    f" WHEN {e} % 11 = 0 AND {u} >= 1 THEN {S(u)} || ',' || lpad({S(f'{e} % 1000')}, 3, '0')"
                                    f" ELSE {S(f'{u} * 1000 + {e} % 1000')} END"),
        ("volume_disclosure_day", f"CASE WHEN {u} % 31 = 0 THEN '-5' ELSE {S(f'{e} % 5000')} END"),
        ("sector_index", f"CASE {e} % 4 WHEN 0 THEN ' S&P 500 ' WHEN 1 THEN 'N/A' WHEN 2 THEN 'nasdaq' ELSE NULL END"),
        ("sector_return_same_period", _dec6(D, f"({e} * 37) % 200000 - 100000")),
        ("abnormal_return_1d", _dec6(D, f"({e} * 41 + 1) % 200000 - 100000")),
        ("abnormal_return_7d", _dec6(D, f"({e} * 43 + 2) % 400000 - 200000")),
        ("abnormal_return_30d", _dec6(D, f"({e} * 47 + 3) % 600000 - 300000")),
        ("car_neg1_to_pos1", _dec6(D, f"({e} * 53 + 4) % 200000 - 100000")),
        ("car_0_to_7", _dec6(D, f"({e} * 59 + 5) % 300000 - 150000")),
        ("car_0_to_30", _dec6(D, f"({e} * 61 + 6) % 500000 - 250000")),
        ("car_0_to_90", f"CASE WHEN {e} % 12 = 0 THEN 'na' ELSE {_dec6(D, f'({e} * 67 + 7) % 900000 - 450000')} END"),
        ("t_statistic_1d", _dec6(D, f"({e} * 71) % 8000000 - 4000000")),
        ("p_value_1d", _dec6(D, signed(f"({e} * 73) % 1100000", f"{e} % 17 = 0"))),
        ("t_statistic_30d", _dec6(D, f"({e} * 79) % 8000000 - 4000000")),
        ("p_value_30d", _dec6(D, f"({e} * 83) % 1050000")),
        ("earnings_announcement_within_7d", "CASE event_type WHEN 'view' THEN 'Yes' WHEN 'signup' THEN ' 0 '"
                                            " WHEN 'purchase' THEN 'maybe' WHEN 'click' THEN 'n/a' ELSE NULL END"),
        ("market_cap_at_disclosure", _money(D, f"{b} * 1000000", comma)),
        ("volume_ratio_disclosure", _dec6(D, signed(f"({e} * 89) % 3000000", f"{u} % 37 = 0"))),
        ("pre_incident_volatility_30d", _dec6(D, f"({e} * 97) % 500000")),
        ("post_incident_volatility_30d", _dec6(D, signed(f"({e} * 101) % 500000", f"{e} % 19 = 0"))),
        ("days_to_price_recovery", f"CASE WHEN {e} % 8 = 0 THEN {S(f'{e} % 90')} || '.0'"
                                   f" WHEN {e} % 15 = 0 THEN '-' || {S(f'{e} % 10 + 1')}"
                                   f" WHEN {e} % 16 = 1 THEN '1,2' ELSE {S(f'{e} % 120')} END"),
        ("notes", f"' mkt note ' || {S(e)}"),
        ("created_at", f"CASE WHEN {e} % 25 = 0 THEN 'n/a' WHEN {e} % 27 = 0 THEN {D.fmt_ts('ts', iso=True)} || 'Z'"
                       f" WHEN {e} % 3 = 0 THEN {D.fmt_ts('ts')} ELSE {D.fmt_ts('ts', iso=True)} END"),
        ("updated_at", f"CASE WHEN {e} % 10 = 7 THEN {D.fmt_ts(D.add_secs('ts', '-3600'), iso=True)}"
                       f" ELSE {D.fmt_ts(D.add_secs('ts', f'({e} % 48) * 3600'), iso=True)} END"),
        ("ingestion_timestamp", f"CASE WHEN {e} % 22 = 1 THEN NULL"
                                f" ELSE {D.add_secs(D.ts_lit('2026-03-01 00:00:00'), f'({e} % 2) * 3600')} END"),
        ("source_file", f"CASE WHEN {e} % 50 = 0 THEN 'n/a' ELSE ' Market_Impact.csv' END"),
    ]


def dim_country_columns(D: Dialect) -> list[tuple[str, str]]:
    return [
        ("country_iso2", "'N' || chr(CAST(65 + n_nationkey AS INT))"),
        ("country_name", "n_name"),
    ]


# ---------------------------------------------------------------------------
# Spark side
# ---------------------------------------------------------------------------

def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _select(df: DataFrame, cols: list[tuple[str, str]], spread_input: bool = True) -> DataFrame:
    return (spread(df) if spread_input else df).selectExpr(*[f"{expr} AS {name}" for name, expr in cols])


def derive_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    base = orders.selectExpr("*", "0 AS copy").unionByName(
        orders.where("o_orderkey % 10 = 0").selectExpr("*", "1 AS copy"))
    return _select(base, incidents_columns(SPARK))


def derive_financial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_table(spark, sf_dir, "lineitem"), financial_columns(SPARK))


def derive_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_table(spark, sf_dir, "events"), market_columns(SPARK))


# ---------------------------------------------------------------------------
# The raw views are derived where they are read: a reader derives only the columns
# it asks for, and no wide text is written.  ``bronze`` stores a view as Parquet in the
# shared folder, once per session, for jobs that read all of it several times.  Keyed by
# input folder and by a digest of the expressions, so a changed derivation never reads
# stale files.
# ---------------------------------------------------------------------------
_DERIVE = {"raw_incidents": derive_incidents, "raw_financial": derive_financial, "raw_market": derive_market}
_STORED: dict[tuple, str] = {}


def digest() -> str:
    text = repr([incidents_columns(SPARK), financial_columns(SPARK), market_columns(SPARK)])
    return hashlib.sha1(text.encode()).hexdigest()[:12]


def input_state(spark: SparkSession, sf_dir: str, names=("orders", "lineitem", "events", "nation")) -> tuple:
    """Name, size and time of the input tables' files: what is stored of other files is not read again."""
    found = []
    for name in names:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        found += [(f.getPath().getName(), f.getLen(), f.getModificationTime())
                  for f in path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)]
    return tuple(sorted(found))


def bronze(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir), name, digest(), input_state(spark, sf_dir))
    path = _STORED.get(key)
    if path is None:
        path = shared_dir(spark, "bronze", uuid.uuid4().hex[:12], name)
        _DERIVE[name](spark, sf_dir).write.mode("overwrite").parquet(path)
        _STORED[key] = path
    return spark.read.parquet(path)


def forget() -> None:
    """Store the raw feeds anew when they are next asked for."""
    _STORED.clear()


def raw_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_incidents(spark, sf_dir)


def raw_financial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_financial(spark, sf_dir)


def raw_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive_market(spark, sf_dir)


def dim_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_table(spark, sf_dir, "nation"), dim_country_columns(SPARK), spread_input=False)


DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
                 "benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table by name (``orders``, ``lineitem``, ...)."""
    return _table(spark, sf_dir, name)


# ---------------------------------------------------------------------------
# DuckDB side (oracle): SELECT statements over the pre-registered views.
# ---------------------------------------------------------------------------

def _sql(cols: list[tuple[str, str]], source: str) -> str:
    body = ",\n    ".join(f"{expr} AS {name}" for name, expr in cols)
    return f"SELECT\n    {body}\n  FROM {source}"


RAW_SQL = {
    "raw_incidents": _sql(
        incidents_columns(DUCK),
        "(SELECT *, 0 AS copy FROM orders UNION ALL SELECT *, 1 AS copy FROM orders WHERE o_orderkey % 10 = 0) o"),
    "raw_financial": _sql(financial_columns(DUCK), "lineitem"),
    "raw_market": _sql(market_columns(DUCK), "events"),
    "dim_country": _sql(dim_country_columns(DUCK), "nation"),
}

