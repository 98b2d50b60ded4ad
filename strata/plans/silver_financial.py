"""Silver build of financial impact: clean -> drop NULL ids -> winner -> derive -> score.

The completeness score is the only derived order key; it is computed before
the window as a plain column.  Flags, net loss, status and issue count are
computed on the winners only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import clean, rules
from strata.operators import dedup

KEY = "incident_id"

MONEY = ["direct_loss_usd", "ransom_demanded_usd", "ransom_paid_usd", "recovery_cost_usd", "legal_fees_usd",
         "regulatory_fine_usd", "insurance_payout_usd", "total_loss_usd", "total_loss_lower_bound",
         "total_loss_upper_bound", "inflation_adjusted_usd"]


def typed(raw: DataFrame, key_case: str | None = "upper", on_error: str = "null") -> DataFrame:
    """Cleaning and typing; the key is upper-cased (the reference's policy) unless ``key_case`` says otherwise.

    ``on_error="fail"`` makes a malformed time fail the job, as the reference's plain casts do.
    """
    tok = clean.FINANCIAL_NULL_TOKENS
    raw = raw.withColumn("__cpi_value_text", clean.cpi_value_text("cpi_index_used"))
    year, value = clean.cpi("cpi_index_used", "__cpi_value_text")
    spec = [
        ("incident_id", clean.key_case(clean.tokens_to_null("incident_id", tok, None), key_case or None)),
        ("direct_loss_method", clean.tokens_to_null("direct_loss_method", tok, "upper")),
        ("total_loss_method", clean.tokens_to_null("total_loss_method", tok, "upper")),
        ("ransom_source", clean.blank_to_null("ransom_source")),
        ("notes", clean.blank_to_null("notes")),
        ("source_file", clean.norm("source_file", "lower")),
        *[(m, clean.money(m)) for m in MONEY],
        ("cpi_year", year),
        ("cpi_value", value),
        ("created_at_bronze", clean.cast("created_at", "timestamp", on_error)),
        ("updated_at_bronze", clean.cast("updated_at", "timestamp", on_error)),
        ("ingestion_timestamp_bronze", clean.cast("ingestion_timestamp", "timestamp", on_error)),
    ]
    return clean.select_cleaned(raw, spec)


def completeness() -> Column:
    return rules.completeness(MONEY)


def quality_flag() -> Column:
    lo, hi = F.col("total_loss_lower_bound"), F.col("total_loss_upper_bound")
    yr, val = F.col("cpi_year"), F.col("cpi_value")
    return rules.first_match([
        (F.col("incident_id").isNull(), "MISSING_INCIDENT_ID"),
        (lo.isNotNull() & hi.isNotNull() & (lo > hi), "INVALID_LOSS_RANGE"),
        (yr.isNull() & val.isNotNull(), "CPI_YEAR_MISSING"),
        (val.isNull() & yr.isNotNull(), "CPI_VALUE_MISSING"),
    ])


def issue_rules() -> dict[str, Column]:
    return {
        "incident_id_format": rules.matches("incident_id", rules.INCIDENT_ID_PATTERN, null_issue=True),
        "loss_range": rules.ordered("total_loss_lower_bound", "total_loss_upper_bound"),
        "direct_negative": rules.negative("direct_loss_usd"),
        "recovery_negative": rules.negative("recovery_cost_usd"),
        "legal_negative": rules.negative("legal_fees_usd"),
        "fine_negative": rules.negative("regulatory_fine_usd"),
        "insurance_negative": rules.negative("insurance_payout_usd"),
        "total_negative_or_missing": rules.negative("total_loss_usd", null_issue=True),
        "cpi_pair": rules.both_or_neither("cpi_year", "cpi_value"),
    }


def dq_issue_count() -> Column:
    return rules.issue_count(issue_rules()).cast("int")


def net_loss() -> Column:
    return F.col("total_loss_usd") - F.coalesce(F.col("insurance_payout_usd"), F.lit(0))


def order() -> list[Column]:
    """Sort keys of the winner, best first."""
    return [
        F.col("ingestion_timestamp_bronze").desc_nulls_last(),
        F.col("updated_at_bronze").desc_nulls_last(),
        F.col("created_at_bronze").desc_nulls_last(),
        F.col("completeness_score").desc_nulls_last(),
        F.col("source_file").asc_nulls_first(),
    ]


def winners(df: DataFrame, tiebreak=None) -> DataFrame:
    scored = df.where(F.col(KEY).isNotNull()).withColumn("completeness_score", completeness())
    return dedup.winner(scored, KEY, order(), tiebreak=tiebreak).drop("completeness_score")


def derive(w: DataFrame, as_of=None) -> DataFrame:
    return w.withColumns({
        "ransom_paid_flag": clean.flag_positive("ransom_paid_usd"),
        "insured_flag": clean.flag_positive("insurance_payout_usd"),
        "regulatory_penalty_flag": clean.flag_positive("regulatory_fine_usd"),
        "net_loss_after_insurance": net_loss(),
        "financial_quality_flag": quality_flag(),
        "dq_issue_count": dq_issue_count(),
        "ingestion_timestamp_silver": clean.now(as_of),
    })


def build(raw: DataFrame, as_of=None, tiebreak=None, key_case: str | None = "upper", on_error: str = "null") -> DataFrame:
    """Raw financial rows -> silver rows (31 columns; the two never-filled ones are NULL)."""
    return schemas.conform(derive(winners(typed(raw, key_case, on_error), tiebreak), as_of), schemas.FINANCIAL)
