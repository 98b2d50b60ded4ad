"""Gold incident fact: incidents LEFT JOIN country, financial, market; four safe ratios.

Plan: the country dimension is broadcast (size-checked); financial and market
are joined on ``incident_id``, the same key both times, so the exchange done
for the first join is reused by the second (one hash partitioning of the
incidents side, one of each silver).  Silver guarantees one row per key on the
right, so nothing fans out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import clean
from strata.operators import joins, stats
from strata.session import materialize

KEY = "incident_id"

INCIDENT_COLS = ["incident_id", "company_name", "company_revenue_usd", "employee_count", "is_public_company",
                 "incident_date", "discovery_date", "disclosure_date", "attack_vector_primary",
                 "attack_vector_secondary", "data_compromised_records", "data_type", "systems_affected",
                 "downtime_hours", "country_hq"]
FINANCIAL_COLS = ["direct_loss_usd", "ransom_demanded_usd", "recovery_cost_usd", "legal_fees_usd",
                  "regulatory_fine_usd", "insurance_payout_usd", "total_loss_usd"]
MARKET_COLS = ["price_7d_after", "price_7d_before", "days_to_price_recovery"]

FACT_COLS = ["incident_id", "company_name", "company_revenue_usd", "country_name", "employee_count",
             "is_public_company", "incident_date", "discovery_date", "disclosure_date", "attack_vector_primary",
             "attack_vector_secondary", "data_compromised_records", "data_type", "systems_affected",
             "downtime_hours", *FINANCIAL_COLS, *MARKET_COLS]


def ratios() -> list[Column]:
    total = F.col("total_loss_usd")
    return [
        clean.safe_ratio(total, F.col("company_revenue_usd"), 4).alias("total_loss_revenue_ratio"),
        clean.safe_ratio(total, F.col("employee_count"), 2).alias("total_loss_employee_ratio"),
        clean.safe_ratio(total, F.col("downtime_hours"), 2).alias("total_loss_downtime_ratio"),
        clean.safe_ratio(total, F.col("data_compromised_records"), 6).alias(
            "total_loss_data_compromised_records_ratio"),
    ]


def with_country(incidents: DataFrame, dim_country: DataFrame, **how) -> DataFrame:
    """The country's name by its code; ``how`` bounds the broadcast and the salting (``joins.left_lookup``)."""
    return joins.left_lookup(incidents, dim_country, "country_hq", "country_iso2", ["country_name"], **how)


def joined(incidents: DataFrame, dim_country: DataFrame, financial: DataFrame, market: DataFrame) -> DataFrame:
    """The three left joins, carried columns only."""
    inc = with_country(incidents.select(*INCIDENT_COLS), dim_country)
    fin = financial.select(KEY, *FINANCIAL_COLS)
    mkt = market.select(KEY, *MARKET_COLS)
    return inc.join(fin, KEY, "left").join(mkt, KEY, "left")


def build(incidents: DataFrame, dim_country: DataFrame, financial: DataFrame, market: DataFrame) -> DataFrame:
    """Silver tables + country dimension -> gold fact (25 carried columns + 4 ratios)."""
    j = joined(incidents, dim_country, financial, market)
    return j.select(*FACT_COLS, *ratios())


def analyze(fact: DataFrame, x: str = "company_revenue_usd", y: str = "total_loss_revenue_ratio",
            q: int = 5, labels=stats.SIZE_LABELS) -> dict[str, DataFrame]:
    """The analysis leg over a gold fact: correlation matrix of the numeric
    columns, size buckets, box summary and median ratio per bucket, 2-D density.

    The points with both measures are stored once (checkpoint) because bucket
    edges, quartiles and whiskers each read them.
    """
    pts = materialize(stats.points(fact.select(KEY, x, y), x, y, cap=None))
    bucketed = stats.quantile_bucket(pts, x, q, labels)
    return {
        "correlation_matrix": stats.corr_matrix(fact, stats.numeric_columns(fact), nulls="zero"),
        "size_buckets": bucketed,
        "box_summary": stats.box_summary(bucketed, "size_bucket", y),
        "median_by_size": stats.median_by_bucket(bucketed, "size_bucket", y),
        "density": stats.log_density(fact, x, y),
    }
