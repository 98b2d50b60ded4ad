"""Document fingerprints by winnowing.

A text's words (lower-cased, parted by blanks, tabs and line ends) are hashed and
combined to hashes of ``K`` consecutive words; in each window of ``W`` such
hashes the least is chosen, the rightmost of equal ones, with its position.  Any
passage of ``K + W - 1`` words that two texts share gives them a common
fingerprint, and a passage under ``K`` words never does.  Hashes of K words are built by
doubling (1, 2, 4 words), window minima likewise (1, 2, 4 positions), so the
work for a word does not depend on K or W beyond their logarithm.

Defined cases: null and empty texts have one fingerprint, that of the empty
word; a text of fewer than K words has one, that of all its words; repeated rows
are fingerprinted each; other columns pass through, and ``fingerprints`` (and
``next_text``) are replaced.  Texts are never cut.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Words in a hash and hashes in a window; powers of two.
K, W = 4, 4
#: Positions fill the lower bits of a window's sort key, reversed so that the rightmost is least.
POSITION_BITS = 30
#: Stands for a null doc_id: it sorts below all others.
NULL_ID = -(1 << 63)


def _paired(of: str, gap: int, how) -> Column:
    """how(x[i], x[i + gap]) for each i; past the end the second is null."""
    return F.zip_with(F.col(of), F.slice(F.col(of), F.lit(gap + 1), F.size(of)), how)


def add(docs: DataFrame, text: str = "text", out: str = "fingerprints", plain: Sequence[str] = ()) -> DataFrame:
    """``docs`` with the text's fingerprints: array of (hash, position of the first word from 0).

    Columns that rows are partitioned or sorted by are named in ``plain``: they are
    not nested meanwhile, so that the plan still knows of the order.
    """
    kept = [c for c in docs.columns if c != out and c not in plain]
    order = [c for c in docs.columns if c != out]
    blanks = F.translate(F.lower(F.coalesce(F.col(text), F.lit(""))), "\n\t\r", "   ")
    # every array below is read more than once, so that none is computed again inside a lambda
    df = docs.select(*plain, F.struct(*kept).alias("_doc"), F.transform(F.split(blanks, " "), lambda w: F.xxhash64(w)).alias("_g1"))
    size = 1
    while size < K:
        df = df.withColumn(f"_g{2 * size}", _paired(f"_g{size}", size, lambda a, b: F.xxhash64(a, b)))
        size *= 2
    df = df.withColumn("_g", F.when(F.size("_g1") >= K, F.slice(f"_g{K}", F.lit(1), F.size("_g1") - (K - 1)))
                       .otherwise(F.array(F.xxhash64("_g1"))))
    low, last = (1 << (63 - POSITION_BITS)) - 1, (1 << POSITION_BITS) - 1
    df = df.withColumn("_m1", F.transform("_g", lambda h, i: F.shiftleft(h.bitwiseAND(F.lit(low)), POSITION_BITS)
                                          + (F.lit(last).cast("long") - i)))
    size = 1
    while size < W:
        df = df.withColumn(f"_m{2 * size}", _paired(f"_m{size}", size, lambda a, b: F.least(a, b)))
        size *= 2
    chosen = F.array_distinct(F.slice(f"_m{W}", F.lit(1), F.greatest(F.size("_g") - (W - 1), F.lit(1))))
    at = lambda m: (F.lit(last).cast("long") - m.bitwiseAND(F.lit(last).cast("long"))).cast("int")
    return df.select(*[c if c in plain else f"_doc.{c}" for c in order], F.transform(chosen, lambda m: F.struct(
        F.get("_g", at(m)).alias("hash"), at(m).alias("position"))).alias(out))


def hashes(fingerprints: str) -> Column:
    return F.array_distinct(F.col(fingerprints)["hash"])


def likeness(a: str, b: str) -> Column:
    """Shared hashes over all hashes of two columns of distinct hashes: 0 to 1."""
    return F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b))


def as_text(fingerprints: str) -> Column:
    """hash@position of each, comma-joined; the hash as its lower 32 bits in hex."""
    return F.array_join(F.transform(fingerprints, lambda f: F.concat(
        F.lower(F.hex(f["hash"].bitwiseAND(F.lit(0xFFFFFFFF)))), F.lit("@"), f["position"])), ",")


def _ranges(edges: list[int], key: Column) -> Column:
    """Number of edges below ``key``, counted first by groups of edges, then within one."""
    step = math.isqrt(len(edges) - 1) + 1
    groups = [edges[i:i + step] for i in range(0, len(edges), step)]
    array = lambda xs: "array(" + ",".join(f"cast('{x}' as bigint)" for x in xs) + ")"
    group = F.size(F.filter(F.expr(array([g[-1] for g in groups])), lambda e: e < key))
    inner = F.expr("array(" + ",".join(map(array, groups)) + ")")
    return group * step + F.size(F.filter(F.get(inner, group), lambda e: e < key))


def order_by_id(docs: DataFrame, ranges: int, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, object] | None:
    """Rows in ranges of doc_id, each range ending with a copy (``_copy``) of the row that follows it.

    With the returned window ``lead`` gives the next row by descending doc_id
    (nulls last, equal ids by text, after the last row the first) and never looks
    beyond a range.  None for an empty table.
    """
    key = F.coalesce(F.col(doc_id).cast("long"), F.lit(NULL_ID))
    rows = docs.withColumn("_key", key)
    found = rows.agg(F.max("_key"), F.percentile_approx("_key", [i / ranges for i in range(1, ranges)] or [1.0], 100 * ranges)).first()
    if found[0] is None:
        return None
    edges = sorted({found[0], *found[1]})
    rows = rows.withColumns({"_range": _ranges(edges, F.col("_key")), "_copy": F.lit(False)})
    firsts = rows.where(F.col("_key").isin(edges)).groupBy("_key", "_range").agg(
        F.min(F.coalesce(text, F.lit(""))).alias(text))
    copies = firsts.withColumns({"_range": (F.col("_range") + 1) % len(edges), "_copy": F.lit(True)})
    both = rows.unionByName(copies, allowMissingColumns=True)
    return both, Window.partitionBy("_range").orderBy("_copy", F.col("_key").desc(), F.col(text).asc_nulls_first())


def edited_pairs(docs: DataFrame, ranges: int) -> DataFrame:
    """Each text's fingerprints beside those of its edited text and of the next document's.

    The edited text has the last half replaced by the next document's first
    characters.  The texts are shuffled once, by range of doc_id.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = order_by_id(docs, ranges)
    if ordered is None:
        ordered = docs.withColumns({"_key": F.lit(0).cast("long"), "_range": F.lit(0), "_copy": F.lit(False)}), \
            Window.partitionBy("_range").orderBy("_copy", F.col("_key").desc(), "text")
    rows, window = ordered
    rows = rows.withColumn("n_chars", F.length("text").cast("long")).withColumn("_next", F.lead("text").over(window))
    rows = add(rows, plain=("_range", "_copy", "_key", "text")).withColumn("_next_prints", F.lead("fingerprints").over(window)).where(~F.col("_copy"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")),
                                              F.substring("_next", F.lit(1), half)))
    return add(rows, "edited", "edited_fingerprints").withColumnRenamed("_next_prints", "next_fingerprints")


def digest(pairs: DataFrame) -> DataFrame:
    sets = pairs.withColumns({"_own": hashes("fingerprints"), "_edited": hashes("edited_fingerprints"),
                              "_next": hashes("next_fingerprints")})
    return sets.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text("fingerprints").alias("fingerprint"), as_text("edited_fingerprints").alias("edited_fingerprint"),
        likeness("_own", "_edited").alias("near_edited"), likeness("_own", "_next").alias("near_next"))
