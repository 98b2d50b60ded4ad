"""Lookups against dimension tables.

A dimension is broadcast only behind a check of the bytes that would be sent: one
aggregation over its key and the columns asked for.  Beyond the bound both sides are
shuffled, with hot keys salted (``salted_lookup``): a sketch of the keys finds
those that hold more than a quarter of a shuffle partition's share of the rows, each of their
rows goes to one of so many parts, by a hash of the row, that a part is no larger
than that, and the dimension's row is repeated for every part.  The parts of all
hot keys together are at most eight times the shuffle partitions, so the repetition is
bounded whatever the skew, and small enough that several of them in one task do no harm.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Most bytes (of values, as text, and 16 for each of them) that we broadcast on our own authority.
MAX_BROADCAST_BYTES = 64 << 20


def fits_broadcast(dim: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when all values of ``dim`` take at most ``max_bytes``."""
    size = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + 16 for c in dim.columns), F.lit(0))
    return (dim.agg(F.sum(size.cast("long"))).first()[0] or 0) <= max_bytes


#: Parts of a hot key for each share of a shuffle partition that it holds.
PARTS_PER_SHARE = 4
#: A key with fewer rows is never salted: one task reads them in no time.
LEAST_HOT_ROWS = 100_000


def hot_keys(df: DataFrame, key_hash: Column, slots: int, least_rows: int = LEAST_HOT_ROWS) -> dict[int, list[int]]:
    """Hashes of hot keys by the number of parts (2, 4, 8, ...) that their rows are dealt to.

    A key is hot if it holds more rows than the even share of one of ``slots``, so there are
    fewer hot keys than slots.  The counts come from a frequent-items sketch that
    tracks eight times as many keys: it misses no key of that size, and its error
    only moves the number of parts, never a result.
    """
    tracked = max(10_000, 8 * slots)
    seen = df.select(key_hash.alias("h")).where("h is not null").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {slots}, {tracked})").alias("top")).first()
    share = max(seen["n"] / slots, least_rows)
    found: dict[int, list[int]] = {}
    for r in seen["top"] or []:
        if r["count"] > share:
            found.setdefault(1 << math.ceil(math.log2(r["count"] / share)), []).append(r["item"])
    return found


def salted_lookup(df: DataFrame, dim: DataFrame, left_on: Sequence[str], right_on: Sequence[str], columns: Sequence[str],
                  salt_by: Sequence[str] | None = None, least_rows: int = LEAST_HOT_ROWS) -> DataFrame:
    """``left_lookup`` by shuffling both sides, with the rows of hot keys and of NULL keys dealt to many tasks.

    ``salt_by`` names the columns whose hash deals the rows out (default: all); rows
    equal in all of them stay together, so it should hold something that tells rows apart.
    The part of a row is a function of the row alone: a task that is run again deals alike.
    """
    spark = df.sparkSession
    slots = PARTS_PER_SHARE * int(spark.conf.get("spark.sql.shuffle.partitions"))
    hashed = lambda cols: F.when(_all_present(cols), F.xxhash64(*cols))
    hot = hot_keys(df, hashed([F.col(k) for k in left_on]), slots, least_rows)

    def parts(h: Column) -> Column:
        out = F.lit(1)
        for n, hashes in sorted(hot.items()):
            out = F.when(h.isin(hashes), F.lit(n)).otherwise(out)
        return out

    of_row = F.xxhash64(*[F.col(c) for c in (salt_by or df.columns)])
    here = hashed([F.col(k) for k in left_on])
    # a NULL key matches nothing, so its rows may go anywhere
    salt = F.pmod(of_row, F.when(here.isNull(), F.lit(slots)).otherwise(parts(here)).cast("long")).cast("int")
    names = [f"__dim_key_{i}" for i in range(len(right_on))]
    d = dim.select(*[F.col(k).alias(n) for k, n in zip(right_on, names)], *[F.col(c) for c in columns])
    d = d.where(_all_present([F.col(n) for n in names]))
    each = F.sequence(F.lit(0), parts(hashed([F.col(n) for n in names])) - 1) if hot else F.array(F.lit(0))
    d = d.withColumn("__dim_salt", F.explode(each))
    left = df.withColumn("__salt", salt)
    cond = left["__salt"] == d["__dim_salt"]
    for a, b in zip(left_on, names):
        cond = (left[a] == d[b]) & cond
    return left.join(d, cond, "left").drop("__salt", "__dim_salt", *names)


def _all_present(cols: Sequence[Column]) -> Column:
    out = cols[0].isNotNull()
    for c in cols[1:]:
        out = out & c.isNotNull()
    return out


def left_lookup(df: DataFrame, dim: DataFrame, left_on: str | Sequence[str], right_on: str | Sequence[str],
                columns: Sequence[str], max_bytes: int = MAX_BROADCAST_BYTES, salt_by: Sequence[str] | None = None,
                least_hot_rows: int = LEAST_HOT_ROWS) -> DataFrame:
    """``df LEFT JOIN dim`` on equal keys, adding ``columns`` of ``dim``.

    NULL or unmatched keys give NULL columns (SQL semantics).  ``dim`` must be
    unique on ``right_on``, otherwise rows of ``df`` fan out.  A dimension over
    ``max_bytes`` is joined by ``salted_lookup``.
    """
    lk = [left_on] if isinstance(left_on, str) else list(left_on)
    rk = [right_on] if isinstance(right_on, str) else list(right_on)
    names = [f"__dim_key_{i}" for i in range(len(rk))]
    d = dim.select(*[F.col(k).alias(n) for k, n in zip(rk, names)], *[F.col(c) for c in columns])
    if not fits_broadcast(d, max_bytes):
        return salted_lookup(df, dim, lk, rk, columns, salt_by, least_hot_rows)
    d, cond = F.broadcast(d), None
    for a, b in zip(lk, names):
        c = df[a] == d[b]
        cond = c if cond is None else cond & c
    return df.join(d, cond, "left").drop(*names)
