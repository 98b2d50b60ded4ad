"""Upsert (MERGE) as a DataFrame operation.

``upsert(target, source, key)`` returns the target as it is after

    MERGE INTO target USING source ON target.key = source.key
    WHEN MATCHED [AND when] THEN UPDATE SET *
    WHEN NOT MATCHED THEN INSERT *

Plan: ONE full outer equi-join on the key, so a side that is already partitioned
by the key (a winner, a table bucketed on it) is not shuffled again.  A NULL key
never matches (``NULL = NULL`` is not true), exactly as in MERGE: rows without a
key are split off before the join and added unchanged (target) or as inserts
(source), so they are not shuffled at all.

A key that occurs twice in the source would make the result ambiguous; MERGE
refuses it, and so does the plan, by a count per key in the same partitioning.
Pass ``unique=False`` for a source that has one row per key by construction
(``dedup.winner``).

Columns of the target missing from the source are left as they are on update
and NULL on insert.  ``stamp_col`` receives ``as_of`` only on rows that were
updated or inserted.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from strata.functions.clean import now

_T, _S = "__strata_in_target", "__strata_in_source"

#: Condition of the market silver: update only when the target has no bronze
#: time or the source is strictly newer.
def newer_only(ts_col: str) -> Callable[[Callable[[str], Column], Callable[[str], Column]], Column]:
    def cond(t, s):
        return t(ts_col).isNull() | (s(ts_col) > t(ts_col))
    return cond


def _one_per_key(source: DataFrame, key: str) -> DataFrame:
    """``source`` (keys not NULL); a key that occurs twice fails the job."""
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    error = F.raise_error(F.concat(F.lit("source has duplicate key "), F.col(key).cast("string")))
    checked = source.withColumn(_S, F.when(n > 1, error.cast("boolean")).otherwise(F.lit(True)))
    return checked


def _rows(target: DataFrame, source: DataFrame, key: str, when, unique: bool) -> DataFrame:
    """Structs t and s of each merged row (NULL where absent), in_t, and take: the source's row counts."""
    keyed = source.where(F.col(key).isNotNull())
    keyed = _one_per_key(keyed, key) if unique else keyed.withColumn(_S, F.lit(True))
    one = target.where(F.col(key).isNotNull()).select(F.col(key).alias("__k"), F.struct(*target.columns).alias("t"))
    two = keyed.select(F.col(key).alias("__k"), F.struct(*source.columns).alias("s"), _S)
    met = one.join(two, "__k", "full_outer").select("t", "s", F.col("t").isNotNull().alias(_T), F.coalesce(_S, F.lit(False)).alias(_S))
    none = lambda df, name: F.lit(None).cast(df.select(F.struct(*df.columns).alias("x")).schema["x"].dataType).alias(name)
    left = target.where(F.col(key).isNull()).select(
        F.struct(*target.columns).alias("t"), none(source, "s"), F.lit(True).alias(_T), F.lit(False).alias(_S))
    new = source.where(F.col(key).isNull()).select(
        none(target, "t"), F.struct(*source.columns).alias("s"), F.lit(False).alias(_T), F.lit(True).alias(_S))
    rows = met.unionByName(left).unionByName(new)
    newer = F.lit(True) if when is None else F.coalesce(
        when(lambda c: F.col(f"t.{c}"), lambda c: F.col(f"s.{c}")), F.lit(False))
    return rows.select("t", "s", F.col(_T).alias("in_t"), (F.col(_S) & (~F.col(_T) | newer)).alias("take"))


def _merged(rows: DataFrame, target: DataFrame, source: DataFrame, stamp_col: str | None, as_of) -> DataFrame:
    """The merged target of ``_rows``."""
    out = []
    for name in target.columns:
        old, kind = F.col(f"t.{name}"), target.schema[name].dataType
        if name == stamp_col:
            old = F.when(F.col("take"), now(as_of).cast(kind)).otherwise(old)
        elif name in source.columns:
            old = F.when(F.col("take"), F.col(f"s.{name}").cast(kind)).otherwise(old)
        out.append(old.alias(name))
    return rows.select(*out)


def upsert(target: DataFrame, source: DataFrame, key: str, when: Callable | None = None,
           stamp_col: str | None = None, as_of=None, unique: bool = True) -> DataFrame:
    """The merged target (columns and order of ``target``)."""
    return _merged(_rows(target, source, key, when, unique), target, source, stamp_col, as_of)


def _counts() -> dict[str, Column]:
    """What a merge reports, as aggregates over ``_rows``."""
    in_t, take = F.col("in_t"), F.col("take")
    found = {"num_updated_rows": F.count_if(in_t & take), "num_inserted_rows": F.count_if(~in_t & take),
             "num_unchanged_rows": F.count_if(~take), "num_affected_rows": F.count_if(take), "num_output_rows": F.count(F.lit(1))}
    return {name: c.cast("bigint").alias(name) for name, c in found.items()}


@dataclass
class Merged:
    """A merge that was written: what the sink returned, and the counts taken while it wrote."""
    table: object
    counts: dict[str, int]


def write(target: DataFrame, source: DataFrame, key: str, sink: Callable[[DataFrame], object], when: Callable | None = None,
          stamp_col: str | None = None, as_of=None, unique: bool = True) -> Merged:
    """Merge and hand the rows to ``sink``, which writes them in one action; the counts are taken in that same pass.

    The rows are observed after the join and before the projection, so nothing is
    joined or read a second time for the counts.  No shuffle follows the join, hence
    each row is counted by the task that writes it and a task that is run again
    counts once.  The sink must consume all rows (a table write, not ``limit`` or
    ``first``) and must not read ``target``'s own files while it replaces them: write
    to a new location, as ``io.write_table`` does.
    """
    seen = Observation()
    observed = _rows(target, source, key, when, unique).observe(seen, *_counts().values())
    table = sink(_merged(observed, target, source, stamp_col, as_of))
    found = seen.get  # waits for the action; without one the sink wrote nothing
    return Merged(table, {name: int(found[name]) for name in _counts()})


def metrics(target: DataFrame, source: DataFrame, key: str, when: Callable | None = None,
            unique: bool = True) -> DataFrame:
    """One row: rows updated, inserted, left unchanged, and the merged total, by a join of its own.

    It tells what a merge would do; ``write`` counts while it does it.
    """
    return _rows(target, source, key, when, unique).agg(*_counts().values())


def assert_unique(source: DataFrame, key: Sequence[str] | str) -> None:
    """Raise when a key occurs twice in ``source`` (MERGE would be ambiguous).

    One aggregation, stops at the first duplicate found.
    """
    keys = [key] if isinstance(key, str) else list(key)
    full = source
    for k in keys:
        full = full.where(F.col(k).isNotNull())
    dup = full.groupBy(*keys).count().where("count > 1").limit(1).collect()
    if dup:
        raise ValueError(f"source has duplicate keys, e.g. {dup[0].asDict()}")
