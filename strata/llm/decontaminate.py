"""Benchmark decontamination: a hash set of the items' word n-grams, scanned over every document.

Words are runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z.  A
benchmark window is ``n`` consecutive words of an item, or all of a shorter item.
The windows are a broadcast hash table (a literal in the plan): slot -> windows
with their words and items.  A document is screened first: an occurrence is a
run of benchmark words, so texts without such a run are done.  In the others
each window of words is hashed to a slot and compared word by word.
All of it happens in the row; nothing is shuffled, and each text is split once,
whatever filter is put on the result.

The table is broadcast only up to ``broadcast_windows``, counted first; beyond
that the documents' windows are joined with the benchmark's by shuffling.

Defined cases: null and empty texts have no words; null or empty items have no
windows; repeated documents are scanned each, repeated items count once by id;
an empty benchmark leaves every document clean; other columns pass through and
``n_words``, ``hits`` (word positions from 1), ``items`` are replaced.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import lower_ascii, stored

#: Everything that is not part of a word, after lower-casing (fixed pattern).
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SLOTS_SCHEMA = "array<array<struct<w:array<string>,items:array<string>>>>"


def words(text: Column) -> Column:
    return F.filter(F.split(lower_ascii(F.coalesce(text, F.lit(""))), GAP), lambda w: w != "")


def windows(benchmark: DataFrame, n: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows: size, words ``w``, the ids of their ``items`` as text."""
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), words(F.col(text)).alias("ws"))
    items = items.where(F.size("ws") > 0).withColumn("size", F.least(F.size("ws"), F.lit(n)))
    each = items.select("item", "size", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("ws") - F.col("size") + 1), lambda i: F.slice("ws", i, F.col("size")))).alias("w"))
    return each.groupBy("size", "w").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _slot(w: Column, n_slots: int) -> Column:
    return F.pmod(F.xxhash64(w), F.lit(n_slots)).cast("int")


def _probe(docs: DataFrame, size: int, slots: Column, n_slots: int) -> tuple[DataFrame, Column, Column]:
    """Starts of the windows of ``size`` words that are in the table, the positions they cover, their items."""
    name = f"_at{size}"

    def found(i: Column) -> Column:
        w = F.slice("_words", i, size)
        return F.filter(F.get(slots, _slot(w, n_slots)), lambda e: e["w"] == w)

    starts = F.filter(F.sequence(F.lit(1), F.size("_words") - size + 1), lambda i: F.size(found(i)) > 0)
    docs = docs.withColumn(name, F.when(F.col("_near") & (F.size("_words") >= size), starts)
                           .otherwise(F.array().cast("array<int>")))
    covered = F.flatten(F.transform(name, lambda i: F.sequence(i, i + size - 1)))
    ids = F.flatten(F.transform(name, lambda i: F.flatten(F.transform(found(i), lambda e: e["items"]))))
    return docs, covered, ids


def _windows_of(size: int) -> Column:
    return F.transform(F.sequence(F.lit(1), F.size("_words") - size + 1), lambda i: F.slice("_words", i, size))


def _scan_broadcast(docs: DataFrame, found: DataFrame, n_windows: int) -> DataFrame:
    """hits_<size> and items of each document by the literal hash table."""
    n_slots = 1 << max(4, (8 * n_windows).bit_length())
    rows = found.withColumn("slot", _slot(F.col("w"), n_slots)).collect()
    known = sorted({w for r in rows for w in r["w"]})
    run = "1" * min(r["size"] for r in rows)
    quoted = ",".join(f"'{w}'" for w in known)
    docs = docs.withColumn("_flags", F.expr(f"array_join(transform(_words, w -> if(w IN ({quoted}), '1', '0')), '')"))
    # both columns are read twice below, so that neither is computed again inside a lambda
    docs = docs.withColumn("_near", (F.length("_flags") >= F.size("_words")) & (F.instr("_flags", run) > 0))
    hits, items = [], []
    for size in sorted({r["size"] for r in rows}):
        slots: list[list[dict]] = [[] for _ in range(n_slots)]
        for r in rows:
            if r["size"] == size:
                slots[r["slot"]].append({"w": r["w"], "items": r["items"]})
        docs, covered, ids = _probe(docs, size, F.from_json(F.lit(json.dumps(slots)), SLOTS_SCHEMA), n_slots)
        hits.append(covered)
        items.append(ids)
    return docs.withColumns({"hits": F.array_sort(F.array_distinct(F.concat(*hits))),
                             "items": F.array_sort(F.array_distinct(F.concat(*items)))})


def _scan_shuffled(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The same by joining windows of documents with those of the benchmark."""
    docs = stored(docs.withColumn("_row", F.monotonically_increasing_id()), "decontaminate")
    sizes = [r["size"] for r in found.select("size").distinct().collect()]
    each = reduce(DataFrame.unionByName, [
        docs.where(F.size("_words") >= s).select("_row", F.lit(s).alias("size"), F.posexplode(_windows_of(s)).alias("i", "w"))
        for s in sizes])
    hits = each.join(found, ["size", "w"]).groupBy("_row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.expr("sequence(i + 1, i + size)"))))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return docs.join(hits, "_row", "left").withColumns({
        "hits": F.coalesce("hits", F.array().cast("array<int>")), "items": F.coalesce("items", F.array().cast("array<string>"))})


def scan(docs: DataFrame, benchmark: DataFrame, n: int = 10, text: str = "text",
         broadcast_windows: int = 200_000) -> DataFrame:
    """``docs`` with n_words, hits (positions of hit words) and items (ids with occurring windows, sorted)."""
    kept = [c for c in docs.columns if c not in ("n_words", "hits", "items")]
    found = windows(benchmark, n)
    n_windows = found.count()
    work = docs.select(F.struct(*kept).alias("_doc"), words(F.col(text)).alias("_words"))  # so no column's name can clash
    if not n_windows:
        out = work.withColumns({"hits": F.array().cast("array<int>"), "items": F.array().cast("array<string>")})
    elif n_windows <= broadcast_windows:
        out = _scan_broadcast(work, found, n_windows)
    else:
        out = _scan_shuffled(work, found)
    # a filter on the result would be copied below the projections, with the split into words inside
    # every lambda; it is not moved below a generator
    found = F.struct(F.size("_words").cast("long").alias("n_words"), "hits", "items")
    return out.select(F.col("_doc"), F.inline(F.array(found))).select(*[f"_doc.{c}" for c in kept], "n_words", "hits", "items")


def remove_documents(scanned: DataFrame) -> DataFrame:
    """Only the documents without a hit."""
    return scanned.where(F.size("hits") == 0).drop("n_words", "hits", "items")


def remove_spans(scanned: DataFrame, text: str = "text") -> DataFrame:
    """Every document with its hit words taken out; the characters between words stay."""
    raw = scanned.withColumns({
        "_parts": F.regexp_extract_all(F.concat(text, F.lit(" ")), F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), F.lit(0)),
        "_gaps": F.split(text, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")})
    cleaned = F.concat(F.array_join(F.transform("_parts", lambda w, i: F.concat(
        F.get("_gaps", i), F.when(F.array_contains("hits", i + 1), F.lit("")).otherwise(w))), ""),
        F.get("_gaps", F.size("_parts")))
    return raw.withColumn(text, F.when(F.size("hits") > 0, cleaned).otherwise(F.col(text))).drop(
        "_parts", "_gaps", "n_words", "hits", "items")


def digest(scanned: DataFrame) -> DataFrame:
    return scanned.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH iw AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item, least(len(ws), 10) AS size,
    unnest([list_slice(ws, i, i + least(len(ws), 10) - 1) FOR i IN range(1, len(ws) - least(len(ws), 10) + 2)]) AS w
  FROM iw WHERE len(ws) > 0),
dw AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
pos AS (
  SELECT r, size, unnest(range(1, len(ws) - size + 2)) AS i, ws
  FROM dw, (SELECT DISTINCT size FROM win) WHERE len(ws) >= size),
hit AS (
  SELECT r, i, p.size, item FROM (SELECT r, i, size, list_slice(ws, i, i + size - 1) AS w FROM pos) p
  JOIN win ON win.size = p.size AND win.w = p.w),
cover AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(i, i + size)) AS q FROM hit) GROUP BY r),
who AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(who.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, cover.n IS NOT NULL AS contaminated
FROM dw LEFT JOIN cover USING (r) LEFT JOIN who USING (r)
"""
