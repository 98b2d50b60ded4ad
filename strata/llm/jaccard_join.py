"""Grouped prefix join: links between documents whose word n-gram sets are alike.

A document's set holds the hashes of its distinct ``n``-word shingles.  Two sets
with Jaccard similarity of at least ``percent`` share a shingle among the first
``size - ceil(percent * size) + 1`` of each, in any order that all documents
follow.  The order puts shingles of rarely filled counters first: a fixed array
of counters over all shingles of the corpus, so common lines and passages come last.

1. Equal sets are one class; of the classes with equal size and prefix one is the
   head, and those that link with it are its group, which stands for its members in
   the index of prefix shingles.  The others are groups of their own.
2. Groups that share a prefix shingle and pass the filters on sizes, positions and
   folded bits are candidates.  A shingle's groups are first compared with one of them (a star)
   and what links is merged; only groups still apart are then compared in pairs.
   So a group of near copies, however large, costs a few comparisons a member.
3. Candidates are verified exactly: the heads first, which connects their groups; where
   two heads do not link, their groups are expanded and the members verified.  Components
   come from distributed union-find.

Sets are identified by a 64-bit and shingles by a 48-bit hash.

Defined cases: null, empty and blank texts have an empty set, which is linked
with nothing; fewer than n words give one shingle; repeated rows are equal sets;
null ids never are the smallest id of a component unless it has no other; an
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import discard, stored
from strata.llm.components import WIDTHS, connect, may_link, parities, words_of

#: Counters of the shingle order (4 MB), in blocks that are summed apart, by that many first sums.
COUNTERS, BLOCK, FIRST_SUMS = 1 << 20, 1 << 12, 64
#: So many first shingles of a prefix are carried along: pairs that share one of them leave the join once.
NAMED = 24
#: Bits of the table of ids whose sets are fetched (a hint: false positives are fetched in vain).
FETCH_BITS = 1 << 24
#: Rows that a task works on at once.
ROWS = 400
#: Multipliers of the words' hashes in a shingle, by position (odd numbers from one sequence).
STEP = 0x9E3779B97F4A7C15


def slices(batches: Iterator[pa.RecordBatch], rows: int = ROWS) -> Iterator[pa.RecordBatch]:
    return (batch.slice(at, rows) for batch in batches for at in range(0, batch.num_rows, rows))


def shingles(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 48-bit hashes of the n-word shingles."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < n:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words)) >> 16], np.uint64)
    one = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    mixed = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        mixed += one[i:len(one) - n + 1 + i] * np.uint64((STEP * (2 * i + 1)) % (1 << 64))
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(STEP)
    return np.unique(mixed >> np.uint64(16))


def pack48(values: np.ndarray) -> bytes:
    """Six bytes of each."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def row_hash(text: str = "text") -> Column:
    """Tells rows of one doc_id, or of none, apart by their texts."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


def _texts(docs: DataFrame, *more: Column) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"), *more)


def order_counters(docs: DataFrame, n: int) -> np.ndarray:
    """How many shingles of all documents fall on each counter."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in slices(batches):
            found = np.concatenate([shingles(v.as_py(), n) for v in batch.column(1)])
            np.add.at(total, (found % COUNTERS).astype(np.int64), 1)
        blocks = total.astype("<i4").reshape(-1, BLOCK)
        salt = TaskContext.get().partitionId() % FIRST_SUMS
        yield pa.RecordBatch.from_pydict({"block": pa.array(range(len(blocks)), pa.int32()),
                                          "salt": pa.array([salt] * len(blocks), pa.int32()),
                                          "counts": pa.array([b.tobytes() for b in blocks], pa.binary())})

    def add(group: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(BLOCK, np.int64)
        for counts in group["counts"]:
            total += np.frombuffer(counts, "<i4")
        most = np.iinfo(np.int32).max
        return pd.DataFrame({"block": group["block"][:1], "salt": group["salt"][:1],
                             "counts": [np.minimum(total, most).astype("<i4").tobytes()]})

    schema = "block int, salt int, counts binary"
    sums = _texts(docs).mapInArrow(count, schema).groupBy("block", "salt").applyInPandas(add, schema)
    rows = sums.groupBy("block").applyInPandas(add, schema).collect()
    out = np.zeros((COUNTERS // BLOCK, BLOCK), np.int32)
    for r in rows:
        out[r["block"]] = np.frombuffer(r["counts"], "<i4")
    return out.ravel()


def prefix_size(size: int, percent: int) -> int:
    return size - -(-percent * size // 100) + 1


def prefixes(docs: DataFrame, n: int, percent: int, counters) -> DataFrame:
    """doc_id, row, n_shingles, node (hash of the set; null if empty), key (hash of size and prefix), prefix (longs), bits (parities)."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counters.value
        for batch in slices(batches):
            sizes, nodes, keys, firsts, bits = [], [], [], [], []
            for value in batch.column(1):
                own = shingles(value.as_py(), n)
                sizes.append(len(own))
                if not len(own):
                    nodes.append(None), keys.append(None), firsts.append(None), bits.append(None)
                    continue
                order = np.lexsort((own, counts[(own % COUNTERS).astype(np.int64)]))
                first = own[order[:prefix_size(len(own), percent)]].astype(np.int64)
                nodes.append(int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True))
                keys.append(int.from_bytes(hashlib.blake2b(
                    len(own).to_bytes(8, "little") + first.tobytes(), digest_size=8).digest(), "little", signed=True))
                firsts.append(first)
                bits.append(parities(own, words_of(len(own))))
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "row": batch.column(2), "n_shingles": pa.array(sizes, pa.int64()), "node": pa.array(nodes, pa.int64()),
                "key": pa.array(keys, pa.int64()), "prefix": pa.array(firsts, pa.list_(pa.int64())), "bits": pa.array(bits, pa.list_(pa.int64()))})

    return _texts(docs, row_hash().alias("row")).mapInArrow(find, "doc_id long, row long, n_shingles long, node long, key long, prefix array<long>, bits array<long>")


def _bitmap(ids: DataFrame) -> bytes:
    """A bit for each id's remainder: at most FETCH_BITS / 8 bytes, whatever the number of ids."""
    at = F.pmod(F.xxhash64("doc_id"), F.lit(FETCH_BITS)) + 1  # bit positions count from 1
    blocks = ids.select(at.alias("at")).groupBy(F.bitmap_bucket_number("at").alias("block")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits")).collect()
    size = 1 << 15
    out = bytearray(FETCH_BITS // 8)
    for r in blocks:
        start = (r["block"] - 1) * size // 8
        out[start:start + size // 8] = bytes(r["bits"])[:max(0, min(size // 8, len(out) - start))]
    return bytes(out)


def sets_of(docs: DataFrame, n: int, bits) -> DataFrame:
    """node and set (48-bit hashes) of the documents whose bit is set."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.frombuffer(bits.value, np.uint8)
        for batch in slices(batches):
            at = batch.column(2).to_numpy()
            rows = np.flatnonzero((wanted[at >> 3] >> (at & 7).astype(np.uint8)) & 1)
            nodes, sets = [], []
            for value in batch.column(1).take(pa.array(rows)):
                own = shingles(value.as_py(), n)
                if len(own):
                    nodes.append(int.from_bytes(hashlib.blake2b(own.tobytes(), digest_size=8).digest(), "little", signed=True))
                    sets.append(pack48(own))
            yield pa.RecordBatch.from_pydict({"node": pa.array(nodes, pa.int64()), "set": pa.array(sets, pa.binary())})

    at = F.pmod(F.xxhash64("doc_id"), F.lit(FETCH_BITS)).cast("int").alias("at")
    return _texts(docs, at).mapInArrow(find, "node long, set binary")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of nodes that do link, by their whole sets."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = unpack48(x.as_py()), unpack48(y.as_py())
                same = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(same * 100 >= percent * (len(x) + len(y) - same))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    left = pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("_b")), "b")
    both = left.join(sets.select(F.col("node").alias("a"), F.col("set").alias("_a")), "a")
    return both.select("a", "b", "_a", "_b").mapInArrow(linked, "a long, b long")


class Sets:
    """Sets of the nodes that candidate pairs named so far; each is taken from the texts once and kept."""

    def __init__(self, docs: DataFrame, members: DataFrame, n: int):
        self.docs, self.members, self.n, self.have = docs, members.select("node", F.col("least").alias("doc_id")), n, None
        self.kept: list[DataFrame] = []

    def of(self, pairs: DataFrame) -> DataFrame:
        nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
        if self.have is not None:
            nodes = nodes.join(self.have.select("node"), "node", "left_anti")
        new = stored(self.members.join(nodes, "node", "left_semi"), "wanted")
        if self.have is None or new.limit(1).count():
            bits = self.docs.sparkSession.sparkContext.broadcast(_bitmap(new))
            got = sets_of(self.docs, self.n, bits).join(new.select("node"), "node", "left_semi").dropDuplicates(["node"])
            got = stored(got, "sets")
            self.kept.append(got)
            self.have = got if self.have is None else self.have.unionByName(got)
        return self.have


def _expand(pairs: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of groups as those pairs of their members' nodes that may link."""
    test = may_link(WIDTHS[0][1], percent)
    one, two = (members.select(F.col("grp").alias(g), F.col("node").alias(f"_{g}"),
                               F.struct("n", "bits", F.lit(0).alias("slack")).alias(f"s_{g}")) for g in ("a", "b"))
    return pairs.join(one, "a").join(two, "b").where(test(F.col("s_a"), F.col("s_b"))).select(
        F.col("_a").alias("a"), F.col("_b").alias("b"))


def link(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id of every row: the smallest doc_id that links reach."""
    return link_rows(docs, n, percent).select("doc_id", "n_shingles", "component_id")


def link_rows(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """``link`` with ``row`` (``row_hash`` of the text) and ``root``, equal in a component and null for an empty set."""
    sc = docs.sparkSession.sparkContext
    counters = sc.broadcast(order_counters(docs, n))
    found = stored(prefixes(docs, n, percent, counters), "prefixes")
    classes = found.where("node is not null").groupBy("node").agg(F.first("key").alias("key"), F.min("doc_id").alias("least"))
    grouped = classes.groupBy("key").agg(F.min("node").alias("grp"), F.count("*").alias("n_members"))
    alike = stored(classes.join(grouped, "key").select("node", "least", "grp", "n_members"), "alike")
    own = stored(alike.where("n_members > 1 and node <> grp").select(F.col("node").alias("a"), F.col("grp").alias("b")), "pairs")
    sets = Sets(docs, alike, n)
    known = stored(verify(own, sets.of(own), percent), "links")
    # an equal prefix is not yet a link: a set that does not link with its head is a group of its own
    stays = known.select(F.col("a").alias("node"), F.col("b").alias("head"))
    grouping = alike.join(stays, "node", "left").select("node", "least", F.coalesce("head", "node").alias("grp"))
    bits = found.where("node is not null").groupBy("node").agg(F.first("n_shingles").cast("int").alias("n"), F.first("bits").alias("bits"))
    members = stored(grouping.join(bits, "node"), "members")
    heads = found.where("node is not null").select(F.col("node").alias("grp"), F.col("n_shingles").cast("int").alias("n"), "prefix")
    heads = heads.join(members.where("node = grp").select("grp"), "grp").groupBy("grp").agg(
        F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    heads = stored(heads, "heads")
    rows = stored(found.select("doc_id", "row", "n_shingles", "node"), "rows")
    discard(found, own)
    tokens = heads.select("grp", "n", F.posexplode("prefix").alias("pos", "token"))
    return _resolve(rows, members, heads, tokens, sets, known, percent)


def _near(percent: int, one: Column, two: Column) -> Column:
    """Size and position filters of two rows (n shingles, position p) of the first shingle that two prefixes share.

    The prefixes follow one order, so two sets share nothing before that shingle and
    at most the smaller number of shingles left after it.  A pair that fails here in
    a later common shingle has met this test in the first.
    """
    most = 1 + F.least(one["n"] - 1 - one["p"], two["n"] - 1 - two["p"])
    alike = F.least(one["n"], two["n"]) * 100 >= F.greatest(one["n"], two["n"]) * percent
    return alike & (most * (100 + percent) >= (one["n"] + two["n"]) * percent)


def _index(tokens: DataFrame, percent: int) -> DataFrame:
    """bucket, node, info, rank (``connect``) of the prefix shingles of two groups or more, by bounds on what a bucket holds (``_near``)."""
    limits = tokens.groupBy("token").agg(
        F.min("grp").alias("least"), F.max("grp").alias("most"), F.min("pos").alias("least_p"),
        F.min("n").alias("least_n"), F.max("n").alias("most_n")).where("least <> most").drop("least", "most")
    most = 1 + F.least(F.col("n") - 1 - F.col("pos"), F.col("most_n") - 1 - F.col("least_p"))
    viable = most * (100 + percent) >= (F.col("n") + F.col("least_n")) * percent
    return tokens.join(limits, "token").where(viable).select(
        F.col("token").alias("bucket"), F.col("grp").alias("node"), F.struct("n", F.col("pos").alias("p")).alias("info"), F.col("pos").alias("rank"))


def _resolve(found: DataFrame, members: DataFrame, heads: DataFrame, tokens: DataFrame, sets: Sets, known: DataFrame, percent: int) -> DataFrame:
    index = stored(_index(tokens, percent), "index")

    # a group's members differ from its head by as much as a link allows, and no group of one does
    slack = F.when(F.count(F.lit(1)) > 1, F.floor(2 * F.first("n") * (100 - percent) / (100 + percent)).cast("int")).otherwise(0)
    many = members.groupBy("grp").agg(F.count(F.lit(1)).alias("members"), slack.alias("slack"))
    # a whole long prefix would be carried by each of its many rows
    named = F.slice("prefix", 1, NAMED).alias("buckets")
    sketches = stored(members.where("node = grp").join(many, "grp").join(heads.select("grp", named), "grp").select(
        "node", F.struct("n", "bits", "slack", "buckets").alias("sketch"), "members"), "sketches")
    discard(heads)  # the prefixes are the largest table but the sets
    large = sketches.where("members > 1").select("node")

    def of_heads(pairs: DataFrame) -> DataFrame:
        return verify(pairs, sets.of(pairs), percent)

    def check(pairs: DataFrame) -> DataFrame:
        """Links of heads; only where the heads of two groups do not link are their members compared."""
        direct = stored(of_heads(pairs), "links")
        apart = pairs.join(direct, ["a", "b"], "left_anti")
        of_large = [apart.join(large.withColumnRenamed("node", c), c, "left_semi") for c in ("a", "b")]
        members_pairs = stored(_expand(of_large[0].unionByName(of_large[1]).distinct(), members, percent), "members")
        return direct.unionByName(of_heads(members_pairs))

    roots = connect(index, known, partial(_near, percent), sketches.select("node", "sketch"), may_link(WIDTHS[0][1], percent), check, of_heads)
    discard(index, sketches, *sets.kept)

    named = members.select("node", "least").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    of_node = named.select("node", "root").join(smallest, "root").select("node", "root", "component_id")
    return found.select("doc_id", "row", "n_shingles", "node").join(of_node, "node", "left").select(
        "doc_id", "row", "n_shingles", "root", F.coalesce("component_id", "doc_id").alias("component_id"))
