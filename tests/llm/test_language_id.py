import random

import numpy as np
from pyspark.sql import functions as F

from strata.llm import language_id as g


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    net = g.Network(3, units=4)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    windows = rng.integers(0, 256, (3, 6)).astype(np.int16)
    windows[0, 4:] = g.PAD
    labels = np.array([0, 2, 1])

    def loss():
        p = net.probabilities(windows)
        own = np.log(p[:, np.arange(3), labels])
        return -(own * (windows.T != g.PAD)).sum() / (windows != g.PAD).sum()

    grad = net.gradients(windows, labels)
    for k, places in (("X", [(0, windows[1, 2], 3), (1, windows[2, 0], 9)]), ("U", [(0, 1, 2), (1, 3, 10)]), ("O", [(1, 2, 1)]), ("c", [(0,)])):
        for at in places:
            at = tuple(int(x) for x in at)
            was = net.weights[k][at]
            net.weights[k][at] = was + 1e-3
            up = loss()
            net.weights[k][at] = was - 1e-3
            down = loss()
            net.weights[k][at] = was
            assert abs((up - down) / 2e-3 - grad[k][at]) < 2e-4, (k, at)


def test_held_out_accuracy_and_cases(spark, frame):
    rng = random.Random(2)
    say = lambda parts: " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(60))
    langs = {"xx": ["the", "ing", "on", "sh"], "yy": ["é", "eau", "ment", "que"]}
    rows = [(i, say(langs[k]), k) for i, k in enumerate(["xx", "yy"] * 80)]
    model = g.fit(spark.createDataFrame(rows[:120], "doc_id long, text string, lang string"), sample=50)
    odd = [(500, None), (501, ""), (502, "123 -- 45"), (503, rows[0][1] * 60), (504, "the")]
    docs = frame([*((i, t) for i, t, _ in rows[120:]), *odd, odd[3]])
    got = g.predict(docs, model)
    assert "word" in got.columns and got.columns[-1] == "score"
    by = {r["doc_id"]: r for r in got.collect()}
    right = [by[i]["lang_pred"] == k for i, _, k in rows[120:]]
    assert np.mean(right) > 0.95
    assert [by[i]["lang_pred"] for i in (500, 501, 502, 503)] == ["und", "und", "und", "xx"] and by[500]["score"] == 0.0
    assert all(0 <= r["score"] <= 1 for r in by.values())
    assert g.predict(frame([]), model).count() == 0
    nothing = g.fit(spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string"))
    assert g.predict(frame([(1, "abc")]), nothing).first()["lang_pred"] == "und"


def test_a_text_in_blocks_is_one_text():
    net = g.Network(2)
    data = bytes(range(65, 91)) * 20_000
    whole = g.label(net, [data])
    parts = g.label(net, [data, b"", b"ab"])
    assert np.allclose(whole[0], parts[0]) and parts[1].sum() == 0


def plain_label(net, data):
    """Mean probabilities over all bytes, byte by byte, straight from the network's equations."""
    w, n = {k: v.astype(np.float64) for k, v in net.weights.items()}, net.units
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    total = np.zeros(len(w["c"]))
    for at in range(0, len(data), g.WINDOW):
        window, states = data[at:at + g.WINDOW], []
        for d, order in ((0, range(len(window))), (1, reversed(range(len(window))))):
            h, seen = np.zeros(n), {}
            for i in order:
                x, back = w["X"][d][window[i]], h @ w["U"][d]
                z, r = sigmoid(x[:n] + back[:n]), sigmoid(x[n:2 * n] + back[n:2 * n])
                h = h + z * (np.tanh(x[2 * n:] + r * back[2 * n:]) - h)
                seen[i] = h
            states.append(seen)
        for i in range(len(window)):
            score = states[0][i] @ w["O"][0] + states[1][i] @ w["O"][1] + w["c"]
            p = np.exp(score - score.max())
            total += p / p.sum()
    return total / total.sum()


def test_labels_match_the_equations(spark, frame):
    rng, net = random.Random(4), g.Network(4, seed=3)
    texts = ["".join(rng.choice("abc é日 ") for _ in range(k)) for k in (1, 5, 127, 128, 129, 700)]
    got = g.label(net, [t.encode() for t in texts])
    for t, p in zip(texts, got):
        assert np.allclose(p, plain_label(net, t.encode()), atol=1e-5)
    model = (net, ["a", "b", "c", "d"])
    for r in g.predict(frame(list(enumerate(texts))), model).collect():
        p = plain_label(net, r["text"].encode())
        if r["lang_pred"] != g.UNKNOWN:
            assert abs(r["score"] - p.max()) < 1e-5 and r["lang_pred"] == model[1][int(p.argmax())]


def test_training_reads_whole_texts(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(g.Network, "train", lambda self, windows, labels: seen.append((windows, labels)))
    rows = [(i, f"text {i} " * 400, "xx") for i in range(5)] + [(None, "no id " * 300, "yy"), (9, "1 2 3", "yy"), (10, None, "yy")]
    g.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    (windows, labels), = seen
    assert (windows != g.PAD).sum() == sum(len(t) for _, t, _ in rows[:6])
    assert set(labels.tolist()) == {0, 1}
