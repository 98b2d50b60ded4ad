"""Silver build of market impact: type -> drop NULL ids -> winner -> 18 flags + roll-up.

The market feed re-reads every field as text (bronze types vary), removes
thousands commas and parses tolerantly.  A raw copy of the boolean column is
kept beside its parsed form so that unparsable tokens can be flagged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata import schemas
from strata.functions import clean, rules
from strata.operators import dedup

KEY = "incident_id"

DEC_18_2 = ["price_7d_before", "price_disclosure_day", "price_1d_after", "price_7d_after", "price_30d_after"]
BIGINTS = ["volume_avg_30d_baseline", "volume_disclosure_day"]
DEC_18_6_A = ["sector_return_same_period", "abnormal_return_1d", "abnormal_return_7d", "abnormal_return_30d",
              "car_neg1_to_pos1", "car_0_to_7", "car_0_to_30", "car_0_to_90", "t_statistic_1d", "p_value_1d",
              "t_statistic_30d", "p_value_30d"]
DEC_18_6_B = ["volume_ratio_disclosure", "pre_incident_volatility_30d", "post_incident_volatility_30d"]
RAW_BOOL = "_raw_earnings_announcement_within_7d"

#: The six flags the reference's roll-up looks at (the other twelve are ignored).
ROLLUP_FLAGS = ["dq_invalid_incident_id", "dq_invalid_stock_ticker", "dq_invalid_p_value_1d",
                "dq_invalid_p_value_30d", "dq_invalid_updated_before_created", "dq_invalid_boolean_token"]


NUMERIC_TYPES = {**{m: "decimal(18,2)" for m in DEC_18_2}, **{m: "bigint" for m in BIGINTS},
                 **{m: "decimal(18,6)" for m in DEC_18_6_A}, "market_cap_at_disclosure": "decimal(20,2)",
                 **{m: "decimal(18,6)" for m in DEC_18_6_B}, "days_to_price_recovery": "int"}


def typed(raw: DataFrame, key_case: str | None = "lower", lenient_int: bool = False) -> DataFrame:
    """Two projections: cleaned text of every numeric field, then the tolerant casts.

    The key is lower-cased (the reference's policy) unless ``key_case`` says
    otherwise.  ``lenient_int`` parses integer fields written as ``12.0`` (a
    float-typed CSV export) instead of giving NULL.
    """
    tok = clean.MARKET_NULL_TOKENS
    s = lambda name: F.col(name).cast("string")
    text = raw.select(
        *[clean.number_text(m, strip=None if m == "days_to_price_recovery" else ",").alias(m)
          for m in NUMERIC_TYPES],
        *[c for c in ("incident_id", "stock_ticker", "sector_index", "earnings_announcement_within_7d", "notes",
                      "created_at", "updated_at", "ingestion_timestamp", "source_file")])
    spec = [
        ("incident_id", clean.key_case(clean.tokens_to_null(s("incident_id"), tok, None), key_case or None)),
        ("stock_ticker", clean.tokens_to_null(s("stock_ticker"), tok, "lower")),
        *[(m, clean.parse_number_text(m, NUMERIC_TYPES[m])) for m in DEC_18_2],
        *[(m, clean.parse_number_text(m, NUMERIC_TYPES[m], lenient_int)) for m in BIGINTS],
        ("sector_index", clean.tokens_to_null(s("sector_index"), tok, None)),
        *[(m, clean.parse_number_text(m, NUMERIC_TYPES[m])) for m in DEC_18_6_A],
        ("earnings_announcement_within_7d", clean.boolean("earnings_announcement_within_7d")),
        ("market_cap_at_disclosure", clean.parse_number_text("market_cap_at_disclosure", "decimal(20,2)")),
        *[(m, clean.parse_number_text(m, NUMERIC_TYPES[m])) for m in DEC_18_6_B],
        ("days_to_price_recovery", clean.parse_number_text("days_to_price_recovery", "int", lenient_int)),
        ("notes", clean.tokens_to_null(s("notes"), tok, None)),
        ("created_at", clean.timestamp("created_at")),
        ("updated_at", clean.timestamp("updated_at")),
        ("bronze_ingestion_timestamp", clean.timestamp("ingestion_timestamp")),
        ("source_file", clean.tokens_to_null(s("source_file"), tok, None)),
        (RAW_BOOL, F.trim(s("earnings_announcement_within_7d"))),
    ]
    return clean.select_cleaned(text, spec)


def boolean_token_flag() -> Column:
    """Raw value present and not a NULL token, yet not parsed as a boolean."""
    raw = F.col(RAW_BOOL)
    return (F.when(raw.isNull(), F.lit(0))
            .when(F.lower(F.trim(raw)).isin(clean.MARKET_NULL_TOKENS), F.lit(0))
            .when(F.col("earnings_announcement_within_7d").isNull(), F.lit(1))
            .otherwise(F.lit(0)))


def flag_rules() -> dict[str, Column]:
    def p_value(c):
        v = F.col(c)
        return F.when(v.isNotNull() & ((v < 0) | (v > 1)), F.lit(1)).otherwise(F.lit(0))

    return {
        "dq_invalid_incident_id": rules.required("incident_id"),
        "dq_invalid_stock_ticker": rules.matches(F.upper(F.col("stock_ticker")), rules.TICKER_PATTERN, True),
        **{f"dq_invalid_{m}": rules.negative(m) for m in DEC_18_2},
        **{f"dq_invalid_{m}": rules.negative(m) for m in BIGINTS},
        "dq_invalid_p_value_1d": p_value("p_value_1d"),
        "dq_invalid_p_value_30d": p_value("p_value_30d"),
        "dq_invalid_volume_ratio_disclosure": rules.negative("volume_ratio_disclosure"),
        "dq_invalid_pre_volatility_30d": rules.negative("pre_incident_volatility_30d"),
        "dq_invalid_post_volatility_30d": rules.negative("post_incident_volatility_30d"),
        "dq_invalid_days_to_price_recovery": rules.negative("days_to_price_recovery"),
        "dq_invalid_updated_before_created": rules.not_before("updated_at", "created_at"),
        "dq_invalid_boolean_token": boolean_token_flag(),
        "dq_missing_bronze_ingestion_timestamp": rules.required("bronze_ingestion_timestamp"),
    }


def with_flags(df: DataFrame, rollup: list[str] = ROLLUP_FLAGS) -> DataFrame:
    flagged = df.withColumns(flag_rules())
    return flagged.withColumn("dq_has_issues", rules.any_issue([F.col(f) for f in rollup]))


def order() -> list[Column]:
    """Sort keys of the winner, best first."""
    return [
        F.col("bronze_ingestion_timestamp").desc_nulls_last(),
        F.col("updated_at").desc_nulls_last(),
        F.col("created_at").desc_nulls_last(),
        F.col("has_ticker").desc_nulls_last(),
        F.col("source_file").desc_nulls_last(),
    ]


def winners(df: DataFrame, tiebreak=None) -> DataFrame:
    keyed = df.where(F.col(KEY).isNotNull()).withColumn(
        "has_ticker", F.when(F.col("stock_ticker").isNotNull(), F.lit(1)).otherwise(F.lit(0)))
    return dedup.winner(keyed, KEY, order(), tiebreak=tiebreak).drop("has_ticker")


SOURCE_COLUMNS = [f.name for f in schemas.MARKET.fields if f.name != "silver_ingestion_timestamp"]


def build(raw: DataFrame, tiebreak=None, key_case: str | None = "lower", lenient_int: bool = False) -> DataFrame:
    """Raw market rows -> merge source (52 columns, one per incident_id, no silver stamp)."""
    w = with_flags(winners(typed(raw, key_case, lenient_int), tiebreak))
    return w.select(*SOURCE_COLUMNS)


def build_table(raw: DataFrame, as_of=None, tiebreak=None) -> DataFrame:
    """Silver rows as first inserted into an empty table (53 columns, stamped)."""
    return schemas.conform(build(raw, tiebreak).withColumn("silver_ingestion_timestamp", clean.now(as_of)),
                           schemas.MARKET)
