"""Best-fit-decreasing packing of token pieces into sequences of a fixed capacity.

Best fit decreasing treats pieces of one length alike, and so do bins with one
remaining capacity.  The plan is therefore made from the histogram of lengths
alone (at most ``capacity`` numbers, whatever the size of the corpus): for each
length, longest first, a segment tree over remaining capacities gives the
tightest open bins in logarithmic time, and whole ranges of equal bins are filled
at once.  The plan is a list of runs: pieces of a length with rank first..stop go
``per_bin`` to a bin from a first bin on.  Each piece then finds its place by
joining its rank within its length with the runs.

Ranks come from counts per task and length and their prefix sums, so no task
sees more than its own pieces.

Defined cases: a null text is an empty document; an empty document is one piece
with the end id; repeated rows are packed each; an empty table gives no rows;
pieces outside 1..capacity are refused; other columns of ``docs`` are left out,
those of ``pieces`` pass through (``sequence_id`` and ``offset`` are
replaced).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm.common import stored
from strata.llm.tokens import encoder

#: Documents handed to a task's encoder at a time.
BATCH = 256


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, with_ids: bool = False,
                 doc_id: str = "doc_id", text: str = "text", by_chunk: bool = True) -> DataFrame:
    """Each document's ids and ``end_id``, cut into pieces of ``capacity``; the last may be shorter.

    Columns doc_id, piece, start, length, ids_crc32 and, if asked for, ids (little-endian uint32 bytes).
    """
    end = np.asarray([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, by_chunk).encode
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH):
                rows, part = [], batch.slice(at, BATCH)
                for doc, value in zip(part.column(0).to_pylist(), part.column(1)):
                    ids = encode(value.as_py() or "") + end
                    for n, a in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[a:a + 4 * capacity]
                        rows.append((doc, n, a // 4, len(piece) // 4, zlib.crc32(piece), piece if with_ids else None))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns[:len(names)], names=names)

    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return docs.select(F.col(doc_id).cast("long"), F.coalesce(text, F.lit("")).alias("_text")).mapInArrow(cut, schema)


class Tree:
    """Segment tree over remaining capacities 0..n: which of them have open bins."""

    def __init__(self, n: int):
        self.leaves = 1 << (n + 1).bit_length()
        self.any = [False] * (2 * self.leaves)

    def set(self, at: int, is_open: bool) -> None:
        at += self.leaves
        self.any[at] = is_open
        while at > 1:
            at >>= 1
            self.any[at] = self.any[2 * at] or self.any[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        """The smallest open capacity that is at least ``least``."""
        at = least + self.leaves
        while not self.any[at]:
            while at & 1:
                at >>= 1
                if at <= 1:
                    return None
            at += 1
        while at < self.leaves:
            at = 2 * at if self.any[2 * at] else 2 * at + 1
        return at - self.leaves


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, stop rank, pieces per bin, first bin, offset in the bin)."""
    tree, bins, runs, opened = Tree(capacity), [[] for _ in range(capacity + 1)], [], 0

    def leave(start: int, count: int, room: int) -> None:
        if count:
            bins[room].append((start, count))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        rank, stop = 0, histogram[length]
        while rank < stop:
            room = tree.tightest(length)
            if room is None:
                room, start, count = capacity, opened, -(-(stop - rank) // (capacity // length))
                opened += count
            else:
                start, count = bins[room].pop()
                tree.set(room, bool(bins[room]))
            each = min(room // length, stop - rank)
            used = min(count, (stop - rank) // each)
            runs.append((length, rank, rank + used * each, each, start, capacity - room))
            rank += used * each
            leave(start + used, count - used, room)
            leave(start, used, room - each * length)
    return runs


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (a ``length`` column) with ``sequence_id`` and ``offset`` in its sequence."""
    spark: SparkSession = pieces.sparkSession
    # numbered where they are made and written: a lost task cannot deal them differently later
    whole = pieces.select(F.struct(*[c for c in pieces.columns if c not in ("sequence_id", "offset")]).alias("piece"))
    numbered = stored(whole.select("piece", F.col("piece.length").alias("length"), F.spark_partition_id().alias("part"),
                                   F.monotonically_increasing_id().alias("at")), "pieces")
    counts = numbered.groupBy("part", "length").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("part", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).limit(capacity + 1).collect()}
    if any(n is None or not 1 <= n <= capacity for n in histogram):
        raise ValueError(f"lengths must be 1..{capacity}")
    runs = spark.createDataFrame(plan(histogram, capacity),
                                 "of long, first long, stop long, each long, bin long, start long")
    within = F.row_number().over(Window.partitionBy("part", "length").orderBy("at")) - 1
    ranked = numbered.withColumn("rank", within).join(bases, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("base"))
    # the runs' number depends on the capacity alone, so they may be broadcast
    placed = ranked.join(F.broadcast(runs), (F.col("length") == F.col("of")) & (F.col("rank") >= F.col("first"))
                         & (F.col("rank") < F.col("stop")))
    nth = F.col("rank") - F.col("first")
    return placed.select(
        "piece.*", (F.col("bin") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("start") + (nth % F.col("each")) * F.col("length")).cast("long").alias("offset"))
