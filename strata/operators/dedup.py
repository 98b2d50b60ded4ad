"""Winner per business key (top-1 per group).

``row_number() = 1`` over a window partitioned by the key.  Catalyst turns this
into ``WindowGroupLimit`` Partial (before the exchange) + Final, so every map
task forwards at most one row per key: a hot key (e.g. NULL ids, or one id
holding a third of the rows) costs one row per map partition in the shuffle,
not all its rows.  The order keys are materialised as plain columns first so
the limit can be pushed below the exchange.

The reference orderings are not total; a final tie-break makes results
reproducible: caller-supplied unique columns, else ``xxhash64`` of the row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__strata_rank"


def row_hash(df: DataFrame) -> Column:
    """Deterministic 64-bit hash of all columns (content based, order independent of partitioning)."""
    return F.xxhash64(*[F.col(c) for c in df.columns])


def winner(df: DataFrame, key: str | Sequence[str], order: Sequence[Column],
           tiebreak: Sequence[Column | str] | None = None, drop_null_key: bool = False) -> DataFrame:
    """Keep one row per ``key``: the first by ``order`` then ``tiebreak``.

    ``order`` holds sort Columns (``F.col("x").desc_nulls_last()`` ...).
    NULL keys form one group (SQL PARTITION BY semantics) unless
    ``drop_null_key``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if drop_null_key:
        cond = None
        for k in keys:
            c = F.col(k).isNotNull()
            cond = c if cond is None else cond & c
        df = df.where(cond)
    if tiebreak is None:
        # two independent hashes (64 + 32 bit): a full tie needs both to collide
        tb = [row_hash(df).asc(), F.hash(*[F.col(c) for c in df.columns]).asc()]
    else:
        tb = [F.col(t).asc_nulls_first() if isinstance(t, str) else t for t in tiebreak]
    w = Window.partitionBy(*keys).orderBy(*order, *tb)
    return df.withColumn(_RANK, F.row_number().over(w)).where(F.col(_RANK) == 1).drop(_RANK)
