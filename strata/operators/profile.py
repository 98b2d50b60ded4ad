"""Column profiles: NULLs and placeholders, each in one pass over the table.

The reference counted rows with one job, NULLs with a second, and placeholders
with one job per string column, then did the arithmetic on the driver.  Here
every profile is one aggregation producing a single wide row, unpivoted with
``stack`` into one row per column; nothing is collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.functions import clean


def _pct(part: Column, total: Column, digits: int = 2) -> Column:
    """round(part * 100 / total, digits) in exact decimal arithmetic (half-up); empty table -> NULL."""
    p = part.cast("decimal(20,0)") * F.lit(100)
    return F.round(F.try_divide(p, total.cast("decimal(20,0)")), digits).cast("double")


def _unpivot(wide: DataFrame, names: Sequence[str], prefix: str, value: str) -> DataFrame:
    stack = ", ".join(f"'{n}', `{prefix}{i}`" for i, n in enumerate(names))
    return wide.selectExpr("__total", f"stack({len(names)}, {stack}) AS (column_name, {value})")


def null_counts(df: DataFrame) -> DataFrame:
    """Rows (column_name, null_count, null_pct, total_rows) for every column."""
    names = df.columns
    if not names:
        return df.sparkSession.createDataFrame(
            [], "column_name string, null_count bigint, null_pct double, total_rows bigint")
    wide = df.agg(F.count(F.lit(1)).alias("__total"),
                  *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(names)])
    long = _unpivot(wide, names, "__n", "null_count")
    return long.select(
        "column_name",
        F.col("null_count").cast("bigint").alias("null_count"),
        _pct(F.col("null_count"), F.col("__total")).alias("null_pct"),
        F.col("__total").cast("bigint").alias("total_rows"),
    )


def nulls(df: DataFrame) -> DataFrame:
    """(column_name, null_count, null_pct) ordered by pct then count, descending."""
    return null_counts(df).select("column_name", "null_count", "null_pct").orderBy(
        F.desc("null_pct"), F.desc("null_count"))


#: What tells one snapshot from another: a snapshot of these is written whole, and again over itself.
SNAPSHOT_KEYS = ("layer", "table_name", "profiled_at")


def metrics(df: DataFrame, layer: str, table: str, as_of=None) -> DataFrame:
    """Metric snapshot rows in the audit table's shape."""
    return snapshot(null_counts(df), layer, table, as_of)


def snapshot(counts: DataFrame, layer: str, table: str, as_of=None) -> DataFrame:
    """Metric snapshot rows of NULL counts."""
    return counts.select(
        F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), "column_name", "null_count", "null_pct",
        "total_rows", clean.now(as_of).cast("timestamp").alias("profiled_at"))


def _string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]


def placeholders(df: DataFrame, tokens: Sequence[str] = clean.PLACEHOLDER_TOKENS) -> DataFrame:
    """(column_name, placeholder_count) for string columns holding any placeholder, descending."""
    names = _string_columns(df)
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, placeholder_count bigint")
    toks = list(tokens)
    wide = df.agg(F.count(F.lit(1)).alias("__total"),
                  *[F.count_if(F.lower(F.trim(F.col(f"`{c}`"))).isin(toks)).alias(f"__p{i}")
                    for i, c in enumerate(names)])
    long = _unpivot(wide, names, "__p", "placeholder_count")
    return (long.where(F.col("placeholder_count") > 0)
            .select("column_name", F.col("placeholder_count").cast("bigint").alias("placeholder_count"))
            .orderBy(F.desc("placeholder_count")))


def placeholder_values(df: DataFrame, col: str, tokens: Sequence[str] = clean.PLACEHOLDER_TOKENS) -> DataFrame:
    """Frequency of (raw_value, normalized) placeholder values in one column, descending."""
    folded = lambda c: F.lower(F.trim(c))  # noqa: E731  a function of the raw value, so that alone is the key
    counts = df.where(folded(F.col(col)).isin(list(tokens))).groupBy(F.col(col).alias("raw_value")).count()
    return counts.select("raw_value", folded(F.col("raw_value")).alias("normalized"), "count").orderBy(F.desc("count"))


def null_after_clean(df: DataFrame, col: str) -> DataFrame:
    """One row: total rows and NULLs in ``col``."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias("rows"),
                  F.count_if(F.col(col).isNull()).cast("bigint").alias("nulls_after_clean"))


# --- the whole audit from one aggregation ---------------------------------------------------

def facts(df: DataFrame, focus_col: str, tokens: Sequence[str] = clean.PLACEHOLDER_TOKENS) -> DataFrame:
    """Everything the audit asks of a table, from one pass: a row for each placeholder spelling of ``focus_col``, and one for all other rows.

    ``raw_value`` (NULL on the other rows' row), ``rows``, and by column name the maps ``nulls`` and
    ``placeholders`` (string columns).  Summed over its rows it is the profile of the
    table.  One aggregation with map-side combine; its result has as many rows as
    spellings occur, whatever the size of the table.
    """
    texts, toks = _string_columns(df), list(tokens)
    held = lambda c: F.lower(F.trim(F.col(f"`{c}`"))).isin(toks)
    focus = F.when(held(focus_col), F.col(f"`{focus_col}`")) if focus_col in texts else F.lit(None).cast("string")
    wide = df.groupBy(focus.alias("raw_value")).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"__n{i}") for i, c in enumerate(df.columns)],
        *[F.count_if(held(c)).alias(f"__p{i}") for i, c in enumerate(texts)])
    by_name = lambda names, prefix: F.map_from_arrays(
        F.array(*map(F.lit, names)), F.array(*[F.col(f"{prefix}{i}") for i in range(len(names))]))
    none = F.create_map().cast("map<string,bigint>")
    return wide.select("raw_value", "rows", by_name(df.columns, "__n").alias("nulls"),
                       (by_name(texts, "__p") if texts else none).alias("placeholders"))


def _summed(found: DataFrame, counts: str, value: str) -> DataFrame:
    """(column_name, ``value``) of a map of counts, and the table's ``__total`` rows."""
    each = found.select("rows", F.explode(counts).alias("column_name", "c"))
    return each.groupBy("column_name").agg(F.sum("c").alias(value), F.sum("rows").alias("__total"))


def null_counts_of(found: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``null_counts`` from ``facts``; a table without rows has a row for each of its ``columns`` too."""
    all_of = found.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    n, total = F.coalesce("null_count", F.lit(0)).cast("bigint"), F.coalesce("__total", F.lit(0)).cast("bigint")
    return all_of.join(F.broadcast(_summed(found, "nulls", "null_count")), "column_name", "left").select(
        "column_name", n.alias("null_count"), _pct(n, total).alias("null_pct"), total.alias("total_rows"))


def placeholders_of(found: DataFrame) -> DataFrame:
    """``placeholders`` from ``facts``."""
    return _summed(found, "placeholders", "placeholder_count").where(F.col("placeholder_count") > 0).select(
        "column_name", F.col("placeholder_count").cast("bigint").alias("placeholder_count")).orderBy(F.desc("placeholder_count"))


def placeholder_values_of(found: DataFrame) -> DataFrame:
    """``placeholder_values`` of the focus column from ``facts``."""
    return found.where("raw_value is not null").select(
        "raw_value", F.lower(F.trim("raw_value")).alias("normalized"), F.col("rows").alias("count")).orderBy(F.desc("count"))


def null_after_clean_of(found: DataFrame, focus_col: str) -> DataFrame:
    """``null_after_clean`` of the focus column from ``facts``: its NULLs and its placeholders, which cleaning turns into NULL."""
    gone = F.col("nulls")[focus_col] + F.coalesce(F.try_element_at("placeholders", F.lit(focus_col)), F.lit(0))
    return found.agg(F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
                     F.coalesce(F.sum(gone), F.lit(0)).cast("bigint").alias("nulls_after_clean"))
