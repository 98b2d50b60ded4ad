"""Joining what was found out about groups of equal rows back to the rows, when a few groups hold most of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A group is hot when it holds more than one in so many rows; so there are at most that many of them.
HOT_SHARE = 400


def join_groups(rows: DataFrame, groups: DataFrame, key: str, count: str, columns: Sequence[str],
                counted: int | DataFrame | None = None, share: int = HOT_SHARE) -> DataFrame:
    """``rows`` with ``columns`` of their group (null where ``groups`` has none for their key; keys are not null).

    ``groups`` has one row a key, with its ``count``; ``counted`` is the number of
    rows (or those themselves), needed if some keys have no group.  Hot groups are
    broadcast, fewer than ``share`` rows by their definition, and the rest are joined
    by shuffling.  A row that found its group takes part in the shuffle under a key of
    its own that no group has, so that no task gets the rows of a hot group.
    """
    if isinstance(counted, DataFrame):
        counted = counted.count()
    elif counted is None:
        counted = groups.agg(F.sum(count)).first()[0] or 0
    of_group = groups.select(F.col(key).alias("_key"), F.struct(*columns).alias("_found"), F.col(count).alias("_count"))
    hot = of_group.where(F.col("_count") * share > counted).select("_key", F.col("_found").alias("_hot"))
    rest = of_group.where(F.col("_count") * share <= counted).select(
        F.struct(F.col("_key").alias("key"), F.lit(None).cast("long").alias("row")).alias("_k"), "_found")
    first = rows.join(F.broadcast(hot), F.col(key) == F.col("_key"), "left").drop("_key")
    own = F.when(F.col("_hot").isNotNull(), F.monotonically_increasing_id())
    keyed = first.withColumn("_k", F.struct(F.when(F.col("_hot").isNull(), F.col(key)).alias("key"), own.alias("row")))
    both = keyed.join(rest, "_k", "left")
    return both.select(*rows.columns, *[F.coalesce(f"_hot.{c}", f"_found.{c}").alias(c) for c in columns])
