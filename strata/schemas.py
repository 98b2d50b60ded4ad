"""Fixed table schemas of the silver / audit layers (column order = table order)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, IntegerType,
                               LongType, StringType, StructField, StructType, TimestampType)

# Names, types and order of the table.
INCIDENTS_DDL = """
  incident_id STRING, company_name STRING, company_revenue_usd DOUBLE, country_hq STRING,
  industry_primary STRING, industry_secondary STRING, employee_count INT, is_public_company BOOLEAN,
  stock_ticker STRING, incident_date DATE, incident_date_estimated BOOLEAN, discovery_date DATE,
  disclosure_date DATE, attack_vector_primary STRING, attack_vector_secondary STRING, attack_chain STRING,
  attributed_group STRING, attribution_confidence STRING, data_compromised_records BIGINT, data_type STRING,
  systems_affected STRING, downtime_hours DOUBLE, data_source_primary STRING, data_source_secondary STRING,
  data_source_type STRING, confidence_tier INT, quality_score DOUBLE, quality_grade STRING, review_flag STRING,
  notes STRING, created_at_bronze TIMESTAMP, updated_at_bronze TIMESTAMP, ingestion_timestamp_bronze TIMESTAMP,
  source_file STRING, date_quality_flag STRING, dq_issue_count INT, ingestion_timestamp_silver TIMESTAMP
"""

# Names, types and order of the table.
FINANCIAL_DDL = """
  incident_id STRING, direct_loss_method STRING, total_loss_method STRING, ransom_source STRING, notes STRING,
  source_file STRING, direct_loss_usd DECIMAL(18,2), ransom_demanded_usd DECIMAL(18,2),
  ransom_paid_usd DECIMAL(18,2), recovery_cost_usd DECIMAL(18,2), legal_fees_usd DECIMAL(18,2),
  regulatory_fine_usd DECIMAL(18,2), insurance_payout_usd DECIMAL(18,2), total_loss_usd DECIMAL(18,2),
  total_loss_lower_bound DECIMAL(18,2), total_loss_upper_bound DECIMAL(18,2),
  inflation_adjusted_usd DECIMAL(18,2), cpi_year INT, cpi_value DECIMAL(10,2), created_at_bronze TIMESTAMP,
  updated_at_bronze TIMESTAMP, ingestion_timestamp_bronze TIMESTAMP, ransom_paid_flag INT, insured_flag INT,
  regulatory_penalty_flag INT, net_loss_after_insurance DECIMAL(18,2), loss_range_valid_flag INT,
  data_quality_flag INT, financial_quality_flag STRING, dq_issue_count INT, ingestion_timestamp_silver TIMESTAMP
"""

# Names of the flags.
MARKET_DQ_FLAGS = [
    "dq_invalid_incident_id", "dq_invalid_stock_ticker", "dq_invalid_price_7d_before",
    "dq_invalid_price_disclosure_day", "dq_invalid_price_1d_after", "dq_invalid_price_7d_after",
    "dq_invalid_price_30d_after", "dq_invalid_volume_avg_30d_baseline", "dq_invalid_volume_disclosure_day",
    "dq_invalid_p_value_1d", "dq_invalid_p_value_30d", "dq_invalid_volume_ratio_disclosure",
    "dq_invalid_pre_volatility_30d", "dq_invalid_post_volatility_30d", "dq_invalid_days_to_price_recovery",
    "dq_invalid_updated_before_created", "dq_invalid_boolean_token", "dq_missing_bronze_ingestion_timestamp",
]

# Names, types and order of the table.
MARKET_DDL = """
  incident_id STRING, stock_ticker STRING, price_7d_before DECIMAL(18,2), price_disclosure_day DECIMAL(18,2),
  price_1d_after DECIMAL(18,2), price_7d_after DECIMAL(18,2), price_30d_after DECIMAL(18,2),
  volume_avg_30d_baseline BIGINT, volume_disclosure_day BIGINT, sector_index STRING,
  sector_return_same_period DECIMAL(18,6), abnormal_return_1d DECIMAL(18,6), abnormal_return_7d DECIMAL(18,6),
  abnormal_return_30d DECIMAL(18,6), car_neg1_to_pos1 DECIMAL(18,6), car_0_to_7 DECIMAL(18,6),
  car_0_to_30 DECIMAL(18,6), car_0_to_90 DECIMAL(18,6), t_statistic_1d DECIMAL(18,6), p_value_1d DECIMAL(18,6),
  t_statistic_30d DECIMAL(18,6), p_value_30d DECIMAL(18,6), earnings_announcement_within_7d BOOLEAN,
  market_cap_at_disclosure DECIMAL(20,2), volume_ratio_disclosure DECIMAL(18,6),
  pre_incident_volatility_30d DECIMAL(18,6), post_incident_volatility_30d DECIMAL(18,6),
  days_to_price_recovery INT, notes STRING, created_at TIMESTAMP, updated_at TIMESTAMP,
  bronze_ingestion_timestamp TIMESTAMP, silver_ingestion_timestamp TIMESTAMP, source_file STRING,
""" + ", ".join(f"{f} INT" for f in MARKET_DQ_FLAGS) + ", dq_has_issues INT"

# Names, types and order of the table.
METRICS_DDL = """
  layer STRING, table_name STRING, column_name STRING, null_count BIGINT, null_pct DOUBLE,
  total_rows BIGINT, profiled_at TIMESTAMP
"""


_SIMPLE = {"STRING": StringType(), "DOUBLE": DoubleType(), "INT": IntegerType(), "BIGINT": LongType(),
           "BOOLEAN": BooleanType(), "DATE": DateType(), "TIMESTAMP": TimestampType()}


def _type(name: str) -> DataType:
    if name.startswith("DECIMAL("):
        p, s = name[len("DECIMAL("):-1].split(",")
        return DecimalType(int(p), int(s))
    return _SIMPLE[name]


def struct(ddl: str) -> StructType:
    """StructType of a ``name TYPE, ...`` column list (no session needed)."""
    fields = []
    for item in " ".join(ddl.split()).replace(", ", ",").replace(",2)", ";2)").replace(",6)", ";6)").split(","):
        if not item.strip():
            continue
        name, typ = item.strip().split(" ", 1)
        fields.append(StructField(name, _type(typ.replace(";", ",")), True))
    return StructType(fields)


INCIDENTS = struct(INCIDENTS_DDL)
FINANCIAL = struct(FINANCIAL_DDL)
MARKET = struct(MARKET_DDL)
METRICS = struct(METRICS_DDL)


def _feed(silver: StructType, last: str, replaced: dict[str, str], left_out: tuple[str, ...] = ()) -> StructType:
    """A feed's columns as its file has them: those of the silver table up to ``last``, typed alike, then two times."""
    names = silver.fieldNames()
    fields = [silver[n] for n in names[:names.index(last) + 1] if n not in left_out]
    added = [StructField(n, _SIMPLE[t], True) for n, t in {**replaced, "created_at": "TIMESTAMP", "updated_at": "TIMESTAMP"}.items()]
    return StructType(fields + added)


#: Typed schemas of the three feeds' files, by the name of the feed.
FEEDS = {
    "incidents_master": _feed(INCIDENTS, "notes", {}),
    "financial_impact": _feed(FINANCIAL, "inflation_adjusted_usd", {"cpi_index_used": "STRING"}, ("source_file",)),
    "market_impact": _feed(MARKET, "notes", {}),
}


def conform(df: DataFrame, schema: StructType, strict: bool = True) -> DataFrame:
    """Store-assignment into a fixed schema: select by name, cast, fill absent columns with NULL.

    ``strict`` casts fail on overflow (ANSI store assignment); otherwise NULL.
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f.name)
            c = c.cast(f.dataType) if strict else c.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols)
