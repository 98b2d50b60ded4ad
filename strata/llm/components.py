"""Links between rows that share a bucket, and their components, without all pairs of a bucket.

``components`` is a distributed union-find by alternating star contraction.
``connect`` finds links: every bucket is first compared with one of its rows (a
star), what links is merged, and rows that lie in one component are not compared
again, so a bucket of alike rows costs a comparison a row, whatever its size.

Pairs are screened by ``parities`` before their sets are read: a set is folded to a few
hundred bits (a thousand for large ones), each the parity of the elements that fall on it.  Bits that differ between
two sets are no more than the elements that do, so a pair with too many of
them cannot link; none that links is lost.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import discard, part_of, parts_for, stored, stored_in_parts

#: Stars are repeated, so often at most, while the rest would meet more pairs than this times the index rows
#: and the last star left fewer than this share of the rows apart.  What they leave is compared all the same.
REST_FACTOR, MOST_STARS, SETTLED = 4, 4, 0.8
#: Rows whose sketches are compared at once, and the parts at most.
PART_ROWS, MOST_PARTS = 200_000, 6
#: Longs of a set's parities (powers of two, from the widest), from so many elements.
WIDTHS = ((256, 16), (96, 8), (0, 4))


def _toward_least(edges: DataFrame) -> DataFrame:
    """Large star: every larger neighbour of a node is linked to the node's least neighbour."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _through_least(edges: DataFrame) -> DataFrame:
    """Small star: a node's smaller neighbours, and the node, are linked to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.withColumnRenamed("m", "v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every linked node but the roots: root is the least node of its component.

    Nodes are of one orderable type; self links and repeated links are allowed,
    nulls are not links.  The state between rounds is a table of at most as many
    rows as links, written to the shared folder; a node of any degree is
    aggregated map-side, and joins on a hot node can be split.  Rounds grow with
    the logarithm of the longest chain.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    edges, before = stored(edges, "links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = tuple(state)
        old, edges = edges, stored(_through_least(_toward_least(edges)), "links")
        discard(old)


def labels(links: DataFrame) -> DataFrame:
    """(node, root): one contraction of links (a, b).

    Equal roots are connected; connected nodes may still differ, so this only
    saves comparisons, at the price of one round of ``components``.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    return _through_least(_toward_least(edges)).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def parities(hashes: np.ndarray, words: int) -> list[int]:
    """Parity of the number of hashes on each of 64 * ``words`` bits (a power of two), as longs."""
    odd = np.bincount((hashes & np.uint64(64 * words - 1)).astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def words_of(n: int) -> int:
    """Longs of the parities of a set of n elements: a larger set differs from unlike ones in more elements than few bits tell."""
    return next(words for least, words in WIDTHS if n >= least)


def may_link(words: int, percent: int) -> Callable[[Column, Column], Column]:
    """Test of two sketches (n elements, bits: ``parities``, slack): whether their sets can have that Jaccard similarity.

    Alike sets of m elements together differ in at most (100 - percent) / (100 + percent) * m.
    ``slack``: by how many elements the sets that a row stands for may differ from its own.
    Parities of fewer than ``words`` longs are folded to the least width when their widths differ.
    """
    least = WIDTHS[-1][1]

    def bit_of(sketch: Column, i: int) -> Column:
        return F.coalesce(F.get(sketch["bits"], i), F.lit(0).cast("long"))

    def folded(sketch: Column, i: int) -> Column:
        return reduce(Column.bitwiseXOR, [bit_of(sketch, j) for j in range(i, words, least)])

    def test(one: Column, two: Column) -> Column:
        apart = lambda part, n: sum((F.bit_count(part(one, i).bitwiseXOR(part(two, i))) for i in range(n)), F.lit(0))
        differ = F.when(F.size(one["bits"]) == F.size(two["bits"]), apart(bit_of, words)).otherwise(apart(folded, least))
        return (differ - one["slack"] - two["slack"]) * (100 + percent) <= (one["n"] + two["n"]) * (100 - percent)
    return test


def _star(rows: DataFrame, heads: DataFrame, near: Callable[[Column, Column], Column]) -> DataFrame:
    """Candidate pairs: each row of a bucket against the bucket's head."""
    one = heads.select("bucket", F.col("head.node").alias("a"), F.col("head.info").alias("i"))
    two = rows.select("bucket", F.col("node").alias("b"), F.col("info").alias("j"))
    return one.join(two, "bucket").where((F.col("a") != F.col("b")) & near(F.col("i"), F.col("j"))).select("a", "b").distinct()


def _screened(pairs: DataFrame, sketches: DataFrame, test: Callable[[Column, Column], Column]) -> DataFrame:
    """The pairs whose sketches may link, before their sets are read."""
    slim = sketches.select("node", F.struct("sketch.n", "sketch.bits", "sketch.slack").alias("s"))
    one, two = (slim.select(F.col("node").alias(c), F.col("s").alias(f"s_{c}")) for c in ("a", "b"))
    return pairs.join(one, "a").join(two, "b").where(test(F.col("s_a"), F.col("s_b"))).select("a", "b")


def _rest(apart: DataFrame, near: Callable[[Column, Column], Column], sketches: DataFrame, test: Callable[[Column, Column], Column]) -> DataFrame:
    """Pairs of a bucket in different components that may link: rows outside the main one against all.

    A pair whose sketches name common buckets leaves the join in the first of them only, others as
    often as they meet.
    """
    held = ["root", "info", "sketch"]
    apart = apart.join(sketches, "node")
    side = lambda n, end: ["bucket", F.col("node").alias(n), *[F.col(c).alias(f"{c}{end}") for c in held]]
    one = apart.where("root <> main").select(*side("a", 1))
    two = apart.select(*side("b", 2), (F.col("root") != F.col("main")).alias("also"))
    new = (F.col("root1") != F.col("root2")) & (~F.col("also") | (F.col("a") < F.col("b"))) & near(F.col("info1"), F.col("info2"))
    common = F.get(F.array_intersect(F.col("sketch1.buckets"), F.col("sketch2.buckets")), 0)
    first = F.coalesce(common == F.col("bucket"), F.lit(True))
    return one.join(two, "bucket").where(new & test(F.col("sketch1"), F.col("sketch2")) & first).select("a", "b").distinct()


def connect(index: DataFrame, links: DataFrame | None, near: Callable[[Column, Column], Column], sketches: DataFrame,
            test: Callable[[Column, Column], Column], check: Callable[[DataFrame], DataFrame],
            check_star: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Components, as of ``components``, of the links between all pairs sharing a bucket for which ``check`` holds.

    ``index``: bucket, node, info, rank, for buckets of two nodes or more, stored;
    the row of least rank, the likeliest to link with many, heads its bucket.
    ``near`` is a cheap test of two infos that each pair which links passes in the first bucket they share (in the
    order of ``buckets`` below), ``test`` (``may_link``) one of two
    ``sketches`` (node, sketch with n, bits, slack and ``buckets``: its own, or the first of them, in
    an order that all nodes follow; stored), made before a pair leaves the join; ``check`` keeps the true
    links of stored candidate pairs.  ``check_star`` may find fewer in the stars, whose
    rows are then compared again.  ``links``: pairs known to link.  No pair in
    different components is left unchecked; only pairs already connected are.
    Between stars one contraction of the links (``labels``) tells most of those.
    """
    rows, tried, size = index, None, index.count()
    before = size
    heads = index.groupBy("bucket").agg(F.min(F.struct("rank", "node", "info")).alias("head"))
    nodes = index.select("node").distinct()

    def add(pairs: DataFrame, checked: Callable[[DataFrame], DataFrame]) -> DataFrame:
        found = checked(pairs)
        more = stored(found if links is None else links.unionByName(found), "links")
        discard(pairs)
        return more

    for _ in range(MOST_STARS):
        links = add(stored(_screened(_star(rows, heads, near), sketches, test), "pairs"), check_star or check)
        done = heads.select("bucket", F.col("head.node").alias("node"))
        tried = stored(done if tried is None else tried.unionByName(done), "tried")
        place = nodes.join(labels(links), "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        left = index if check_star else index.join(tried, ["bucket", "node"], "left_anti")
        rows = left.join(place, "node")
        spread = rows.groupBy("bucket").agg(F.min("root").alias("main"), F.max("root").alias("other"), F.count("*").alias("c"))
        rows = stored(rows.join(spread.where("main <> other"), "bucket"), "apart")
        outside = rows.where("root <> main")
        cost, count = outside.agg(F.coalesce(F.sum("c"), F.lit(0))).first()[0], rows.count()
        if cost <= REST_FACTOR * size or count > SETTLED * before:
            break
        before = count
        outside = outside.join(tried, ["bucket", "node"], "left_anti") if check_star else outside
        heads = outside.groupBy("bucket").agg(F.min(F.struct("rank", "node", "info")).alias("head"))
    if not cost:
        return components(links)
    # each row takes its sketch into the join
    parts = parts_for(count, PART_ROWS, MOST_PARTS)
    pairs = stored_in_parts(index.sparkSession, lambda part: _rest(rows.where(part_of("bucket", parts) == part), near, sketches, test), parts, "pairs")
    if parts > 1:  # pairs without a common named bucket may have met in several
        pairs, several = stored(pairs.distinct(), "pairs"), pairs
        discard(several)
    return components(add(pairs, check))
