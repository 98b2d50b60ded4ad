"""Periodic runs of words, found online by catchers over completed power-of-two blocks.

A run is a stretch of words with smallest period q (words q apart are equal), of at
least ``max(min_words, exponent * q)`` words, that neither neighbour extends.  Words
are appended to a ``Detector``.  Whenever a block of b = 2^k words is complete, a
catcher starts for it: it waits for the block's words to come again at the distances
of its level (b to 2b - 1 for threefold runs, so that a level has two or three
catchers at work at any time).  A return opens a comparison of suffixes at that
distance, carried back to the first unequal word at once and forward by every word
appended later; it is a square once it spans twice the distance.  Squares of
one period that overlap are the same comparison, and one whose distance is a multiple
of the period of a comparison that covers it belongs to that: so squares merge into
runs, which are reported when a word ends them.

Every run is caught: of its words before the last period, ``2b - 1`` or more hold a
whole block that begins at a multiple of b, and the block comes again one period on.
A block of period q up to b / 2 may come again at many distances, q apart, inside a
stretch of period q.  If that is the block's own stretch, all these distances are
multiples of q, and q alone is compared.  If it is another, only the distances that
bring both stretches' starts or ends together can carry on beyond them, as a threefold
run does: those two are compared, the second once the later stretch has ended.

Words are compared as 4-byte numbers, many at a time.  A text of n words takes n / 8
steps of the smallest blocks and half as many at each level above, with a bounded
number of comparisons each.  A document is read by one task; the detector holds its
words (4 bytes each) and the open comparisons.

Defined cases: null and empty texts have no words and no runs, their collapsed text
is empty; texts are never cut; repeated rows are searched each; an empty table gives
none; other columns pass through, and ``runs`` and ``collapsed`` are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import workers_import

#: Bytes of a word's number.
WIDTH = 4
RUNS_TYPE = "array<struct<start:bigint,length:bigint,period:bigint>>"
ROWS = 256


def levels(min_words: int, exponent: int, n: int) -> list[tuple[int, int, int]]:
    """(b, least, greatest distance) of each block size, so that runs of every period up to n // exponent are caught."""
    out = []
    b = 1
    while b <= n:
        # a run of period d has max(min_words - d, (exponent - 1) * d) words before its last period
        fits = lambda d, b=b: max(min_words - d, (exponent - 1) * d) >= 2 * b - 1
        bigger = lambda d, b=b: max(min_words - d, (exponent - 1) * d) >= 4 * b - 1
        own = [d for d in range(1, min(2 * min_words, 4 * b) + 1) if fits(d) and not bigger(d)]
        high = (4 * b - 2) // (exponent - 1)  # the largest distance that is too small for blocks of 2b
        low = -(-(2 * b - 1) // (exponent - 1))
        if not own and low > 2 * min_words:
            own = [low]
        if own:
            out.append((b, min(own), max(max(own), high)))
        b *= 2
    return out


class Detector:
    """Runs of a growing sequence of word numbers."""

    def __init__(self, min_words: int = 24, exponent: int = 3):
        if exponent < 3 or min_words < 1:
            raise ValueError("exponent must be 3 or more, min_words 1 or more")
        self.min_words, self.exponent = min_words, exponent
        self.seen = bytearray()   # the words so far
        self.at = 0               # words that the catchers have gone through
        self.open: dict[int, list[int]] = {}  # distance -> [start, end] of the comparison that reaches the last word
        self.waiting: list[list[int]] = []    # block, b, its least and greatest distance, its stretch's end; return, q, end so far
        self.ended: dict[tuple[int, int], int] = {}  # (start, end) of reported runs -> period
        self._levels: list[tuple[int, int, int]] = []
        self._known = 0           # words that _levels is made for

    def append(self, words: bytes) -> None:
        """More words, as 4-byte numbers."""
        self.seen += words
        n = len(self.seen) // WIDTH
        if n > self._known:  # a level that is new now had no room for a return before
            self._known = 2 * n
            self._levels = levels(self.min_words, self.exponent, self._known)
        if not self._levels:
            return
        step = self._levels[0][0]
        for m in range(self.at - self.at % step + step, n + 1, step):
            self._advance(m)
            for b, low, high in self._levels:
                if m % b:
                    break
                self._catch(b, low, high, m - 2 * b + 1, m)
            self.at = m

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of all runs of the words so far, by start, then period."""
        n = len(self.seen) // WIDTH
        self._advance(n)
        for b, low, high in self._levels:  # the words after each level's last whole block
            if (done := self.at - self.at % b) < n:
                self._catch(b, low, high, done - b + 1, n)
        found = dict(self.ended)
        for d, (start, end) in self.open.items():
            if self._long(start, end, d):
                found[start, end] = min(d, found.get((start, end), d))
        return sorted(((start, end - start, d) for (start, end), d in found.items()), key=lambda r: (r[0], r[2]))

    def _long(self, start: int, end: int, d: int) -> bool:
        return end - start >= max(self.min_words, self.exponent * d)

    def _catch(self, b: int, low: int, high: int, first: int, m: int) -> None:
        """Returns of earlier blocks of b words that begin at ``first`` or later and end by word ``m``."""
        oldest = max(0, first - high)
        for i in range(oldest + -oldest % b, m - b - low + 1, b):
            block = bytes(self.seen[i * WIDTH:(i + b) * WIDTH])
            after, stop = max(first, i + low), min(m, i + high + b)
            at = self._next(block, after, stop)
            while at >= 0:
                q = self._next(block, at + 1, min(stop, at + b // 2 + b)) - at
                if q < 0:
                    self._compare(i, at - i, m)
                    at = self._next(block, at + 1, stop)
                else:  # the block has period q
                    end = self._stretches(i, at, q, b, low, high, m)
                    at = self._next(block, end - b + 1, stop)

    def _next(self, block: bytes, after: int, stop: int) -> int:
        """The first word from ``after`` where ``block`` stands whole before ``stop``, or -1."""
        at = self.seen.find(block, after * WIDTH, stop * WIDTH)
        while at >= 0 and at % WIDTH:  # between two words
            at = self.seen.find(block, at + -at % WIDTH, stop * WIDTH)
        return at // WIDTH if at >= 0 else -1

    def _stretches(self, i: int, at: int, q: int, b: int, low: int, high: int, m: int) -> int:
        """Compare the block at ``i`` with its returns in the stretch of period q about ``at``; the end of that stretch."""
        if self._held(i, q):
            return m
        start, end = self._back(at, q), self._ahead(at + b, q, m)
        own = self._back(i, q)
        if own == start:
            self._compare(i, q, m)
        else:
            own_end = self._ahead(i + b, q, m)
            ways = [start - own]
            if end < m:
                ways.append(end - own_end)
            elif m - own_end <= high:
                self.waiting.append([i, b, low, high, own_end, at, q, end])
            for d in ways:
                if low <= d <= high and (d - (at - i)) % q == 0 and start <= i + d and i + d + b <= end:
                    self._compare(i, d, m)
        return end

    def _held(self, i: int, d: int) -> bool:
        """An open comparison covers all from word ``i`` on, and ``d`` is a multiple of its distance."""
        return any(start <= i and d % q == 0 for q, (start, _) in self.open.items())

    def _compare(self, i: int, d: int, m: int) -> None:
        """Open the comparison at distance ``d`` about word ``i``, unless one holds it already."""
        if self._held(i, d):
            return
        back, ahead = self._back(i, d), self._ahead(i + d, d, m)
        if ahead == m:
            self.open[d] = [back, ahead]
        elif self._long(back, ahead, d):
            self._report(back, ahead, d)

    def _advance(self, m: int) -> None:
        """Carry the open comparisons on to word ``m``; those that end before are runs, if long enough."""
        for d, reach in list(self.open.items()):
            reach[1] = self._ahead(reach[1], d, m)
            if reach[1] < m:
                del self.open[d]
                if self._long(*reach, d):
                    self._report(*reach, d)
        if self.waiting:
            self.waiting, before = [], self.waiting
            for x in before:
                i, b, low, high, own_end, at, q, end = x
                x[-1] = end = self._ahead(end, q, m)
                if end == m:
                    if m - own_end <= high:
                        self.waiting.append(x)
                elif low <= (d := end - own_end) <= high and (d - (at - i)) % q == 0 and i + d + b <= end:
                    self._compare(i, d, m)

    def _report(self, start: int, end: int, d: int) -> None:
        self.ended[start, end] = min(d, self.ended.get((start, end), d))

    def _ahead(self, j: int, d: int, m: int) -> int:
        """The first word from ``j`` to ``m`` that differs from the one ``d`` before it, or ``m``."""
        seen, step = self.seen, 8
        while j < m:
            k = min(j + step, m)
            if seen[j * WIDTH:k * WIDTH] == seen[(j - d) * WIDTH:(k - d) * WIDTH]:
                j, step = k, 2 * step
            elif k - j == 1:
                return j
            else:
                step = (k - j) // 2
        return m

    def _back(self, i: int, d: int) -> int:
        """The least word so that all from it to ``i`` equal the one ``d`` after them."""
        seen, step = self.seen, 8
        while i > 0:
            k = max(i - step, 0)
            if seen[k * WIDTH:i * WIDTH] == seen[(k + d) * WIDTH:(i + d) * WIDTH]:
                i, step = k, 2 * step
            elif i - k == 1:
                return i
            else:
                step = (i - k) // 2
        return 0


def numbers(words: list[bytes]) -> bytes:
    """Each word as a 4-byte number, equal for equal words."""
    named: dict[bytes, int] = {}
    return np.array([named.setdefault(w, len(named)) for w in words], np.uint32).tobytes()


def runs_of(words: list[bytes], min_words: int = 24, exponent: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start, then period."""
    if len(words) < min_words:
        return []
    detector = Detector(min_words, exponent)
    detector.append(numbers(words))
    return detector.runs()


def kept_words(words: list[bytes], runs: Iterable[tuple[int, int, int]]) -> list[bytes]:
    """The words outside every run and those of each run's first period that no other run drops."""
    gone = [(start + q, start + length) for start, length, q in runs]
    if not gone:
        return words
    keep = np.ones(len(words), bool)
    for a, b in gone:
        keep[a:b] = False
    return [words[i] for i in np.flatnonzero(keep)]


def find(docs: DataFrame, text: str = "text", min_words: int = 24, exponent: int = 3) -> DataFrame:
    """``docs`` with ``runs`` (start, length, period; words from 0) and ``collapsed``, the text with each run cut to its first period.

    Words are parted by ASCII white space; collapsed words are joined by one space.
    """
    workers_import(docs.sparkSession)
    kept = docs.drop("runs", "collapsed")
    at = kept.columns.index(text)
    runs_type = T._parse_datatype_string(RUNS_TYPE)
    schema = T.StructType([*kept.schema.fields, T.StructField("runs", runs_type), T.StructField("collapsed", T.StringType())])
    entry = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                part = batch.slice(first, ROWS)
                runs, collapsed = [], []
                for value in part.column(at):
                    words = value.as_buffer().to_pybytes().split() if value.is_valid else []  # at the six ASCII blanks
                    found = runs_of(words, min_words, exponent)
                    runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                    collapsed.append(b" ".join(kept_words(words, found)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(runs, entry), pa.array(collapsed, pa.binary()).cast(pa.string())],
                                                 names=schema.names)

    return kept.mapInArrow(read, schema)


def repeat_tails(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` where a tenth of the texts, by crc32 of the id, ends in a repeated stretch of its own words.

    With h that crc32, g = floor(h / 10) and n words, h % 10 = 0 makes each word from
    a = g % n on the word a + (i - a) % p, p = 1 + floor((n - a) / (3 + g % 8)).  A row
    without an id keeps its text.
    """
    workers_import(docs.sparkSession)
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.when(h % 10 == 0, F.floor(h / 10).cast("long"))

    @F.pandas_udf("string")
    def tails(texts: pd.Series, numbers: pd.Series) -> pd.Series:
        def one(t: str | None, g: float | None) -> str | None:
            words = (t or "").encode().split()
            if not (n := len(words)):
                return t
            a = int(g) % n
            p = 1 + (n - a) // (3 + int(g) % 8)
            return b" ".join(words[:a] + [words[a + i % p] for i in range(n - a)]).decode()
        return texts.combine(numbers, one)

    # the other texts are not sent to Python
    changed = tails(F.when(g.isNotNull(), F.col(text)), g)
    return docs.withColumn(text, F.when(g.isNotNull(), changed).otherwise(F.col(text)))


def digest(found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """Number of runs, the run of the greatest exponent, and hashes of all runs and of the collapsed text."""
    # exponents are compared as exact fractions: length / period by cross-multiplication
    ahead = lambda a, b: (a["length"] * b["period"] > b["length"] * a["period"]) | (
        (a["length"] * b["period"] == b["length"] * a["period"]) & (F.struct(a["start"], a["period"]) < F.struct(b["start"], b["period"])))
    best = F.aggregate("runs", F.get("runs", F.lit(0)), lambda a, b: F.when(ahead(b, a), b).otherwise(a))
    text = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("_best", best).select(
        doc_id, F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"_best.{c}").alias(c) for c in ("start", "length", "period")],
        F.floor(1000 * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
