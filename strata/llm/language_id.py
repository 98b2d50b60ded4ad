"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text's UTF-8 bytes in windows, in both directions, labels
every byte, and a document's probabilities are the means over all its bytes.  It
is trained in numpy by backpropagation through time on the whole texts of a bounded,
documented sample of labelled documents (about ``SAMPLE`` for each language, chosen by a
hash of the id and text) and is a few thousand numbers, so tasks receive it whole.

Defined cases: null texts and texts without a letter are ``und`` with score 0;
whole texts are read, a block of windows in memory at a time; repeated rows are
labelled each; without labelled documents every text is ``und``; other columns
pass through, and ``lang_pred`` and ``score`` are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import workers_import

#: Labelled documents that a language gives to training, about.
SAMPLE = 120
#: Units of each direction; bytes in a window; windows read at once.
UNITS, WINDOW, BLOCK = 10, 128, 2048
EPOCHS, BATCH, RATE, SEED = 4, 64, 0.02, 7
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
PAD = 256


class Network:
    """Two gated recurrent layers (forward, backward) and a softmax over their joint states.

    z, r = sigmoid, n = tanh(x + r * (h U)), h' = h + z * (n - h).
    """

    def __init__(self, classes: int, units: int = UNITS, seed: int = SEED):
        rng = np.random.default_rng(seed)
        small = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        self.units = units
        self.weights = {"X": small(2, PAD + 1, 3 * units), "U": small(2, units, 3 * units),
                        "O": small(2, units, classes), "c": np.zeros(classes, np.float32)}

    def states(self, windows: np.ndarray, keep: bool = False):
        """States after each byte, (2, length, windows, units); padding leaves a state as it is."""
        x, u, n = self.weights["X"], self.weights["U"], self.units
        length, count = windows.shape[1], windows.shape[0]
        both = np.stack([windows.T, windows.T[::-1]])
        real = (both != PAD).astype(np.float32)[..., None]
        h = np.zeros((2, count, n), np.float32)
        out = np.empty((2, length, count, n), np.float32)
        trace = []
        for t in range(length):
            seen = np.stack([x[0][both[0, t]], x[1][both[1, t]]])
            back = np.matmul(h, u)
            gates = np.tanh((seen[..., :2 * n] + back[..., :2 * n]) * np.float32(0.5)) * np.float32(0.5) + np.float32(0.5)
            z, r = gates[..., :n], gates[..., n:]
            new = np.tanh(seen[..., 2 * n:] + r * back[..., 2 * n:])
            if keep:
                trace.append((h, z, r, new, back[..., 2 * n:], real[:, t]))
            h = h + (z * real[:, t]) * (new - h)
            out[:, t] = h
        return (out, both, trace) if keep else out

    def probabilities(self, windows: np.ndarray, out: np.ndarray | None = None) -> np.ndarray:
        """(length, windows, classes) for every position."""
        out = self.states(windows) if out is None else out
        score = out[0] @ self.weights["O"][0] + out[1][::-1] @ self.weights["O"][1] + self.weights["c"]
        score -= score.max(-1, keepdims=True)
        np.exp(score, out=score)
        return score / score.sum(-1, keepdims=True)

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over positions, back through time."""
        w, n = self.weights, self.units
        out, both, trace = self.states(windows, keep=True)
        p = self.probabilities(windows, out)
        wrong = p
        wrong[:, np.arange(len(labels)), labels] -= 1
        wrong *= (windows.T != PAD)[..., None] / max(1, int((windows != PAD).sum()))
        grad = {k: np.zeros_like(v) for k, v in w.items()}
        grad["c"] = wrong.sum((0, 1))
        aligned = np.stack([wrong, wrong[::-1]])
        for d in (0, 1):
            grad["O"][d] = np.tensordot(out[d], aligned[d], ((0, 1), (0, 1)))
        dh = np.zeros_like(trace[0][0])
        for t in range(len(trace) - 1, -1, -1):
            h, z, r, new, back, real = trace[t]
            dh = dh + np.matmul(aligned[:, t], w["O"].transpose(0, 2, 1))
            dz = dh * real * (new - h) * z * (1 - z)
            dn = dh * z * real * (1 - new * new)
            dr = dn * back * r * (1 - r)
            gates = np.concatenate([dz, dr, dn], -1)
            inner = np.concatenate([dz, dr, dn * r], -1)
            grad["U"] += np.matmul(h.transpose(0, 2, 1), inner)
            for d in (0, 1):
                np.add.at(grad["X"][d], both[d, t], gates[d])
            dh = dh * (1 - z * real) + np.matmul(inner, w["U"].transpose(0, 2, 1))
        return grad

    def train(self, windows: np.ndarray, labels: np.ndarray, epochs: int = EPOCHS, batch: int = BATCH, rate: float = RATE) -> None:
        rng, step = np.random.default_rng(SEED), 0
        m1, m2 = ({k: np.zeros_like(v) for k, v in self.weights.items()} for _ in range(2))
        for _ in range(epochs):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), batch):
                rows, step = order[at:at + batch], step + 1
                grad = self.gradients(windows[rows], labels[rows])
                size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
                for k, g in grad.items():
                    g = g / max(1.0, size)
                    m1[k] += 0.1 * (g - m1[k])
                    m2[k] += 0.01 * (g * g - m2[k])
                    scale = rate * np.sqrt(1 - 0.99 ** step) / (1 - 0.9 ** step)
                    self.weights[k] -= (scale * m1[k] / (np.sqrt(m2[k]) + 1e-6)).astype(np.float32)


def windows_of(data: bytes, size: int = WINDOW) -> np.ndarray:
    """The bytes in rows of ``size``, the last one padded."""
    rows = -(-len(data) // size)
    out = np.full(rows * size, PAD, np.int16)
    out[:len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(rows, size)


def fit(labelled: DataFrame, sample: int = SAMPLE) -> tuple[Network, list[str]]:
    """A network trained on ``labelled`` (doc_id, text, lang), and its languages."""
    rows = labelled.where("text is not null and lang is not null")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(counts)
    place = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text"), F.lit(1_000_000_000))
    share = F.lit(0)
    for lang in langs:
        share = F.when(F.col("lang") == lang, F.lit(max(1, round(1_000_000_000 * sample / counts[lang])))).otherwise(share)
    got = rows.where(place < share).select("doc_id", "lang", F.col("text").alias("t"))
    pairs = [(windows_of(r["t"].encode()), langs.index(r["lang"])) for r in got.orderBy("doc_id", "t").collect() if LETTER.search(r["t"])]
    network = Network(max(1, len(langs)))
    if pairs:
        network.train(np.concatenate([w for w, _ in pairs]), np.concatenate([np.full(len(w), c) for w, c in pairs]))
    return network, langs


def label(network: Network, texts: list[bytes]) -> np.ndarray:
    """Mean probabilities over all bytes of each text."""
    total, classes = np.zeros((len(texts), len(network.weights["c"]))), None
    pending, owners, held = [], [], 0

    def flush() -> None:
        nonlocal pending, owners, held
        if held:
            rows, who = np.concatenate(pending), np.concatenate(owners)
            for at in range(0, held, BLOCK):
                part = rows[at:at + BLOCK]
                p = network.probabilities(part)
                np.add.at(total, who[at:at + BLOCK], (p * (part.T != PAD)[..., None]).sum(0))
        pending, owners, held = [], [], 0

    for i, data in enumerate(texts):
        for at in range(0, len(data), BLOCK * WINDOW):
            rows = windows_of(data[at:at + BLOCK * WINDOW])
            pending.append(rows), owners.append(np.full(len(rows), i))
            held += len(rows)
            if held >= BLOCK:
                flush()
    flush()
    return total / np.maximum(total.sum(1, keepdims=True), 1e-12)


def predict(docs: DataFrame, model: tuple[Network, list[str]], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the pooled probability of that language."""
    workers_import(docs.sparkSession)
    network, langs = model
    sent = docs.sparkSession.sparkContext.broadcast(network)
    kept = docs.drop("lang_pred", "score")
    at = kept.columns.index(text)
    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = sent.value
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                texts = [v.as_py() or "" for v in part.column(at)]
                known = [bool(langs) and LETTER.search(t) is not None for t in texts]
                p = label(net, [t.encode() if k else b"" for t, k in zip(texts, known)])
                best = p.argmax(1)
                yield pa.RecordBatch.from_arrays([
                    *part.columns, pa.array([langs[b] if k else UNKNOWN for b, k in zip(best, known)], pa.string()),
                    pa.array([float(p[i, b]) if k else 0.0 for i, (b, k) in enumerate(zip(best, known))], pa.float64())], names=schema.names)

    return kept.mapInArrow(read, schema)
