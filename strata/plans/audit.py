"""Audit run of one table: NULL profile -> metric snapshot (appended), placeholder
profile -> placeholder values of a focus column -> cleaned table -> post-clean check.

The table is read once: one aggregation (``profile.facts``), stored in the shared
folder, from whose few rows all profiles are made.  The cleaned table is a lazy
projection.  Nothing is collected to the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions import clean
from strata.operators import profile
from strata.session import materialize
from strata.sources import io


@dataclass
class AuditResult:
    nulls: DataFrame               # column_name, null_count, null_pct (ordered)
    metrics: DataFrame             # audit-table rows
    placeholders: DataFrame        # column_name, placeholder_count (ordered)
    placeholder_values: DataFrame  # raw_value, normalized, count (focus column)
    cleaned: DataFrame             # the table with placeholders -> NULL
    nulls_after_clean: DataFrame   # rows, nulls_after_clean (focus column)


def run(df: DataFrame, layer: str, table: str, focus_col: str, as_of=None,
        tokens=clean.PLACEHOLDER_TOKENS, append_to: str | None = None,
        append_path: str | None = None) -> AuditResult:
    """Profile ``df``; with ``append_to`` the snapshot is added to that table (a repeated run replaces its own)."""
    found = materialize(profile.facts(df, focus_col, tokens))
    counts = profile.null_counts_of(found, df.columns)
    metrics = profile.snapshot(counts, layer, table, as_of)
    if append_to is not None:
        io.replace_partitions(metrics, append_to, profile.SNAPSHOT_KEYS, append_path or io.table_location(df.sparkSession, append_to))
    return AuditResult(
        nulls=counts.select("column_name", "null_count", "null_pct").orderBy(F.desc("null_pct"), F.desc("null_count")),
        metrics=metrics,
        placeholders=profile.placeholders_of(found),
        placeholder_values=profile.placeholder_values_of(found),
        cleaned=clean.placeholders_to_null(df, tokens),
        nulls_after_clean=profile.null_after_clean_of(found, focus_col),
    )
