import random
import sys

import numpy as np

from strata.llm import toxicity as x


def maximal(scores):
    """All maximal segments by their definition: the best segment, then the same left and right of it."""
    def inside(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += scores[j]
                if total > 1e-12 and (best is None or total > best[0] + 1e-12):
                    best = (total, i, j + 1)
        if best is None:
            return []
        return inside(a, best[1]) + [(best[1], best[2])] + inside(best[2], b)
    return inside(0, len(scores))


def test_segments_in_linear_time():
    """Executed lines grow with the number of words."""
    def steps(n):
        scores, seen = np.where(np.random.default_rng(4).random(n) < 0.1, 1.0, -0.5), 0  # sums fall, as with the drift

        def count(frame, event, arg):
            nonlocal seen
            seen += event == "line"
            return count

        before = sys.gettrace()
        sys.settrace(count)
        try:
            x.segments(scores)
        finally:
            sys.settrace(before)
        return seen

    assert 0 < steps(32_000) < 20 * steps(2_000)


def test_segments_match_their_definition():
    rng = random.Random(0)
    for _ in range(300):
        scores = np.array([rng.choice([-3, -1.5, -1, 1, 2, 2.5]) + rng.random() * 1e-3 for _ in range(rng.randint(0, 25))])
        assert [(a, b) for a, b, _ in x.segments(scores)] == maximal(scores)
        assert all(abs(total - scores[a:b].sum()) < 1e-9 for a, b, total in x.segments(scores))


def test_planted_passages(spark, frame):
    rng = random.Random(1)
    plain = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(200)]
    bad = ["moron", "idiot", "scum", "trash"]

    def text(toxic):
        own = [rng.choice(plain) for _ in range(rng.randint(40, 120))]
        if toxic:
            at = rng.randint(0, 30)
            own[at:at + 8] = [rng.choice(bad) if k % 2 else rng.choice(plain) for k in range(8)]
        return " ".join(own)

    rows = [(i, text(i % 7 == 0), int(i % 7 == 0)) for i in range(700)]
    docs = frame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (902, "Scum IDIOT moron trash " * 3), (902, None)])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows[:400]] + [(900, 0)], "doc_id long, toxic int")
    model = x.fit(x.labelled_sample(docs, labels))
    got = x.score(docs, model)
    assert got.count() == len(rows) + 4
    by = {r["doc_id"]: r for r in got.collect() if r["text"] is not None or r["doc_id"] == 900}
    held = rows[400:]
    wrong = [i for i, _, y in held if (by[i]["toxicity"] >= 0.7) != bool(y)]
    assert len(wrong) <= 3
    assert by[900]["toxicity"] < 0.7 and by[901]["toxicity"] < 0.7 and by[902]["toxicity"] >= 0.7
    spans = by[902]["toxic_spans"]
    assert spans and by[902]["text"][spans[0]["start"]:].startswith("Scum")
    assert x.score(frame([]), model).count() == 0
    none = x.fit(x.labelled_sample(docs, labels.where("toxic = 0")))
    assert x.score(docs.limit(3), none).agg({"toxicity": "max"}).first()[0] == 0.0
