"""Silver build of the incident master: clean -> winner per id -> score -> stamp.

One projection of cleaning expressions, one shuffle (the window on
``incident_id``), then narrow scoring.  Scores are computed after the winner
filter: none of them is an order key, so the result is the same as scoring
every row first, with less work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import clean, rules
from strata.operators import dedup

KEY = "incident_id"


def typed(raw: DataFrame, on_error: str = "null", key_case: str | None = None) -> DataFrame:
    """Cleaning and typing of every raw column (the ``base`` step).

    The key is trimmed only (its case kept) unless ``key_case`` folds it.
    """
    n, cast = clean.norm, clean.cast
    c = F.col
    spec = [
        ("incident_id", clean.key_case(n("incident_id"), key_case)),
        ("company_name", n("company_name", "upper")),
        ("company_revenue_usd", cast("company_revenue_usd", "double", on_error)),
        ("country_hq", n("country_hq", "upper")),
        ("industry_primary", n("industry_primary")),
        ("industry_secondary", n("industry_secondary")),
        ("employee_count", cast("employee_count", "int", on_error)),
        ("is_public_company", cast("is_public_company", "boolean", on_error)),
        ("stock_ticker", n("stock_ticker", "upper")),
        ("incident_date", cast("incident_date", "date", on_error)),
        ("incident_date_estimated", cast("incident_date_estimated", "boolean", on_error)),
        ("discovery_date", cast("discovery_date", "date", on_error)),
        ("disclosure_date", cast("disclosure_date", "date", on_error)),
        ("attack_vector_primary", n("attack_vector_primary", "lower")),
        ("attack_vector_secondary", n("attack_vector_secondary", "lower")),
        ("attack_chain", n("attack_chain")),
        ("attributed_group", n("attributed_group", "upper")),
        ("attribution_confidence", clean.tokens_to_null("attribution_confidence", clean.INCIDENT_SENTINELS, "lower")),
        ("data_compromised_records", cast("data_compromised_records", "bigint", on_error)),
        ("data_type", n("data_type", "upper")),
        ("systems_affected", n("systems_affected", "lower")),
        ("downtime_hours", cast("downtime_hours", "double", on_error)),
        ("data_source_primary", n("data_source_primary")),
        ("data_source_secondary", n("data_source_secondary")),
        ("data_source_type", n("data_source_type", "lower")),
        ("confidence_tier", cast("confidence_tier", "int", on_error)),
        ("quality_score", cast("quality_score", "double", on_error)),
        ("quality_grade", n("quality_grade", "upper")),
        ("review_flag", n("review_flag", "lower")),
        ("notes", n("notes")),
        ("created_at_bronze", cast("created_at", "timestamp", on_error)),
        ("updated_at_bronze", cast("updated_at", "timestamp", on_error)),
        ("ingestion_timestamp_bronze", cast(c("ingestion_timestamp"), "timestamp", on_error)),
        ("source_file", n("source_file", "lower")),
    ]
    return clean.select_cleaned(raw, spec)


def date_flag(as_of=None) -> Column:
    """First-match status of the three incident dates."""
    inc, disc, discl = F.col("incident_date"), F.col("discovery_date"), F.col("disclosure_date")
    return rules.first_match([
        (inc.isNull(), "INVALID_INCIDENT_DATE"),
        (disc.isNotNull() & (disc < inc), "DISCOVERY_BEFORE_INCIDENT"),
        (discl.isNotNull() & disc.isNotNull() & (discl < disc), "DISCLOSURE_BEFORE_DISCOVERY"),
        (inc > clean.today(as_of), "INCIDENT_IN_FUTURE"),
    ])


def issue_rules() -> dict[str, Column]:
    """The ten scored rules (0 = pass, 1 = issue)."""
    return {
        "incident_id_format": rules.matches("incident_id", rules.INCIDENT_ID_PATTERN, null_issue=True),
        "country_format": rules.matches("country_hq", rules.COUNTRY_PATTERN, null_issue=True,
                                        also=rules.COUNTRY_ALIASES),
        "industry_format": rules.matches("industry_primary", rules.INDUSTRY_PATTERN, null_issue=True),
        "revenue_range": rules.between("company_revenue_usd", 0, 1e13, null_issue=True),
        "employee_range": rules.between("employee_count", 0, 10000000, null_issue=True),
        "downtime_range": rules.between("downtime_hours", 0, 8760, null_issue=False),
        "confidence_domain": rules.in_set("attribution_confidence", rules.CONFIDENCE_DOMAIN, null_issue=False),
        "tier_domain": rules.in_set("confidence_tier", rules.TIER_DOMAIN, null_issue=True),
        "grade_domain": rules.in_set("quality_grade", rules.GRADE_DOMAIN, null_issue=True),
        "public_required": rules.required("is_public_company"),
    }


def dq_issue_count() -> Column:
    return rules.issue_count(issue_rules()).cast("int")


def order() -> list[Column]:
    """Sort keys of the winner, best first."""
    return [
        F.col("quality_score").desc_nulls_last(),
        F.col("updated_at_bronze").desc_nulls_last(),
        F.col("ingestion_timestamp_bronze").desc_nulls_last(),
    ]


def winners(df: DataFrame, tiebreak=None, drop_null_key: bool = False) -> DataFrame:
    return dedup.winner(df, KEY, order(), tiebreak=tiebreak, drop_null_key=drop_null_key)


def build(raw: DataFrame, as_of=None, tiebreak=None, drop_null_key: bool = False,
          on_error: str = "null", key_case: str | None = None) -> DataFrame:
    """Raw incidents -> silver rows (37 columns, one per incident_id)."""
    return finish(winners(typed(raw, on_error, key_case), tiebreak, drop_null_key), as_of)


def finish(w: DataFrame, as_of=None) -> DataFrame:
    """Score and stamp winner rows; conform to the silver schema."""
    scored = w.withColumns({
        "date_quality_flag": date_flag(as_of),
        "dq_issue_count": dq_issue_count(),
        "ingestion_timestamp_silver": clean.now(as_of),
    })
    return schemas.conform(scored, schemas.INCIDENTS)
