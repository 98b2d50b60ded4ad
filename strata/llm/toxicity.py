"""Toxic passages by maximum-scoring segments.

Every word gets a log-odds score for toxic against other documents.  Its prior is
a Dirichlet (here a beta) distribution around the share of its next shorter
prefix, so a rare word is judged by the words that begin like it, and the
shortest prefix by all words.  Less a constant drift, the scores of a toxic
passage sum up to a positive segment: a linear scan (Ruzzo and Tompa) finds all
maximal ones.  Under the scores' distribution in other documents the best
segment of a text follows an extreme-value law (Karlin and Altschul), which
makes the score independent of the text's length; a logistic curve, fitted to
labelled documents that the word scores have not seen, turns the significance of
the best segment and the mass of all significant ones into a probability.

Labels are learnt from a bounded sample (``SAMPLE`` rows at most, about, chosen by a hash
of the id); features are counted over all of that sample.

Defined cases: null and empty texts score as texts without a segment; texts are
scanned whole; repeated rows are scored each; rows without a label teach
nothing; without both classes every score is 0; other columns pass through and
``toxicity``, ``toxic_spans`` are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import workers_import

#: Labelled rows taught from, about, and the share of them that words are counted in (the rest calibrates).
SAMPLE, COUNTED = 100_000, 0.7
#: Letters of the prefixes that back a word up, and the weight of a prior in documents.
PREFIXES, PRIOR = (3, 5, 7), 4.0
#: A feature is kept where it moves the log odds of its next shorter prefix by this much, in so many documents.
MOVES, LEAST_DOCS = 0.7, 3
#: Taken from every word's score; segments that random text exceeds this rarely count as significant.
DRIFT, SIGNIFICANT = 0.5, 0.05
#: Words whose scores a worker remembers.
REMEMBERED = 300_000
WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    """The word's prefixes, shortest first (each with a mark), then the word."""
    return [word[:n] + "*" for n in PREFIXES if len(word) > n] + [word]


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (start, stop, sum) of ``scores``, in linear time (amortised).

    Each candidate keeps the sums before and after it and the nearest earlier
    candidate that began lower; a new positive run joins that one if it ended
    no higher.  Candidates between began no lower and are not met again.
    """
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    found: list[tuple[int, int, float, float, int]] = []
    for at in np.flatnonzero(scores > 0).tolist():
        start, stop, low, high = at, at + 1, float(sums[at]), float(sums[at + 1])
        j = len(found) - 1
        while True:
            while j >= 0 and found[j][2] >= low:
                j = found[j][4]
            if j < 0 or found[j][3] >= high:
                break
            start, _, low, _, lower = found[j]
            del found[j:]
            j = lower
        found.append((start, stop, low, high, j))
    return [(a, b, high - low) for a, b, low, high, _ in found]


class Model:
    def __init__(self, odds: dict[str, float], rate: float = 1.0, size: float = 1.0, curve: tuple = (0.0, 0.0, 0.0)):
        self.odds, self.rate, self.size, self.curve = odds, rate, size, curve
        self.memory: dict[str, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "memory": {}}

    def word(self, word: str) -> float:
        odds, out = self.odds, 0.0
        for f in features(word):
            out = odds.get(f, out)
        return out

    def scores(self, words: list[str]) -> np.ndarray:
        memory, out = self.memory, np.empty(len(words))
        for i, w in enumerate(words):
            s = memory.get(w)
            if s is None:
                s = memory[w] = self.word(w) - DRIFT
            out[i] = s
        if len(memory) > REMEMBERED:
            memory.clear()
        return out

    def spans(self, text: str) -> tuple[list[tuple[int, int, float]], float, float]:
        """Significant segments as (start, stop, p-value) in characters, -log10 p of the best, summed excess."""
        places = [(m.start(), m.end()) for m in WORD.finditer(text)]
        low = text.lower()
        words = [text[a:b].lower() for a, b in places] if len(low) != len(text) else [low[a:b] for a, b in places]
        best, mass, out = 0.0, 0.0, []
        for a, b, total in segments(self.scores(words)):
            expected = self.size * len(words) * math.exp(-min(700.0, self.rate * total))
            p = -math.expm1(-expected)
            best = max(best, -math.log10(max(p, 1e-300)))
            if p < SIGNIFICANT:
                out.append((places[a][0], places[b - 1][1], p))
                mass += self.rate * total
        return out, best, math.log1p(mass)

    def probability(self, best: float, mass: float) -> float:
        a, b, c = self.curve
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, a + b * math.log1p(best) + c * mass))))


def word_odds(counts: dict[str, tuple[int, int]], n_docs: int, n_toxic: int) -> dict[str, float]:
    """Log odds of each feature against the base rate where they move its prefix's by MOVES."""
    base = n_toxic / n_docs
    rest = math.log(base / (1 - base))

    odds: dict[str, float] = {}
    share: dict[str, float] = {}
    for f in sorted(counts, key=lambda f: (len(f) - f.endswith("*"), not f.endswith("*"))):
        n, toxic = counts[f]
        stem = f[:-1] if f.endswith("*") else f
        prior = next((share[p] for k in reversed(PREFIXES) if len(stem) > k and (p := stem[:k] + "*") in share), base)
        share[f] = (toxic + PRIOR * prior) / (n + PRIOR)
        if n >= LEAST_DOCS and abs(math.log(share[f] / (1 - share[f])) - math.log(prior / (1 - prior))) >= MOVES:
            odds[f] = math.log(share[f] / (1 - share[f])) - rest
    return odds


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple:
    """Ridge logistic regression by Newton steps; the first weight is the constant."""
    x, w = np.column_stack([np.ones(len(x)), x]), np.zeros(x.shape[1] + 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), x.T @ (y - p) - ridge * w)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return tuple(float(v) for v in w)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and toxic documents of each feature in this task's part ('' counts all)."""
    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"feature": list(n), "n": list(n.values()), "toxic": [t[f] for f in n]},
                                          schema=pa.schema([("feature", pa.string()), ("n", pa.int64()), ("toxic", pa.int64())]))

    n, t = Counter(), Counter()
    for batch in batches:
        for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
            found = {f for w in set(WORD.findall((text.as_py() or "").lower())) for f in features(w)} | {""}
            n.update(found)
            if toxic:
                t.update(found)
            if len(n) > 400_000:
                yield rows()
                n, t = Counter(), Counter()
    yield rows()


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Texts of about ``sample`` labelled documents at most, with toxic and a place from 0 to 1 by a hash of the id.

    The sampled labels are bounded by ``sample``, so they are broadcast and the texts stay where they are.
    """
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / (1 << 20)
    share = min(1.0, sample / max(1, labels.count()))
    some = labels.where(place < share).select("doc_id", F.col("toxic").cast("int").alias("toxic"), (place / share).alias("place"))
    return docs.join(F.broadcast(some), "doc_id").select("text", "toxic", "place")


def fit(rows: DataFrame) -> Model:
    """A model from a bounded sample of labelled documents: text, toxic 0/1, place 0 to 1."""
    workers_import(rows.sparkSession)
    teach, check = rows.where(F.col("place") < COUNTED), rows.where(F.col("place") >= COUNTED)
    counts = teach.select("text", "toxic").mapInArrow(_counted, "feature string, n long, toxic long") \
        .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    # features of one or two documents move nothing; a bounded sample has a bounded number of others
    got = {r["feature"]: (r["n"], r["toxic"]) for r in counts.where((F.col("n") >= LEAST_DOCS) | (F.col("feature") == "")).collect()}
    n_docs, n_toxic = got.pop("", (0, 0))
    if not 0 < n_toxic < n_docs:
        return Model({})
    model = Model(word_odds(got, n_docs, n_toxic))
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Histogram of the word scores and the best segments of the calibrating documents."""
        for batch in batches:
            out = []
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                scores = sent.value.scores(WORD.findall((text.as_py() or "").lower()))
                values, times = np.unique(np.round(scores, 1), return_counts=True)
                found = segments(scores)
                out.append((int(toxic), len(scores), [s for _, _, s in found], values.tolist(), times.tolist()))
            columns = list(zip(*out)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
                pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.list_(pa.int64())))],
                names=["toxic", "words", "sums", "values", "times"])

    seen = check.select("text", "toxic").mapInArrow(
        words, "toxic int, words long, sums array<double>, values array<double>, times array<long>")
    plain = seen.select("toxic", F.explode(F.arrays_zip("values", "times")).alias("v")).where("toxic = 0") \
        .groupBy(F.col("v.values").alias("value")).agg(F.sum("v.times").alias("times")).collect()
    if not plain:
        return model
    value, times = np.array([r["value"] for r in plain]), np.array([r["times"] for r in plain], float)
    model.rate = _rate(value, times / times.sum())
    best = seen.select("toxic", "words", F.coalesce(F.array_max("sums"), F.lit(0.0)).alias("best")).where("toxic = 0 and words > 0")
    # the law's other constant: log(size) is the median's place, ln ln 2 below the location
    mid = best.select(F.percentile_approx(F.lit(model.rate) * F.col("best") - F.log("words"), 0.5)).first()[0]
    model.size = math.exp(min(50.0, (mid if mid is not None else 0.0))) * math.log(2)
    sent2 = rows.sparkSession.sparkContext.broadcast(model)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent2.value.spans(t.as_py() or "")[1:] for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array([math.log1p(a) for a, _ in found], pa.float64()),
                                              pa.array([b for _, b in found], pa.float64())], names=["toxic", "best", "mass"])

    rows = check.select("text", F.col("toxic").cast("int")).mapInArrow(marks, "toxic int, best double, mass double").collect()
    y = np.array([r["toxic"] for r in rows], float)
    if 0 < y.sum() < len(y):
        model.curve = logistic(np.array([(r["best"], r["mass"]) for r in rows]), y)
    return model


def _rate(values: np.ndarray, shares: np.ndarray) -> float:
    """The rate solving sum(share * exp(rate * value)) = 1."""
    if values.max() <= 0 or values @ shares >= 0:
        return 1.0
    low, high = 1e-6, 1.0
    while shares @ np.exp(high * values) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if shares @ np.exp(mid * values) < 1 else (low, mid)
    return low


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``toxic_spans`` (start, end, p of each significant passage)."""
    workers_import(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("toxicity", "toxic_spans")
    at = kept.columns.index(text)
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("p", T.DoubleType())])
    schema = T.StructType([*kept.schema.fields, T.StructField("toxicity", T.DoubleType()), T.StructField("toxic_spans", T.ArrayType(span))])
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            found = [own.spans(v.as_py() or "") for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays([
                *batch.columns, pa.array([own.probability(best, mass) if own.odds else 0.0 for _, best, mass in found], pa.float64()),
                pa.array([[{"start": a, "end": b, "p": p} for a, b, p in s] for s, _, _ in found], spans_type)], names=schema.names)

    return kept.mapInArrow(scan, schema)
