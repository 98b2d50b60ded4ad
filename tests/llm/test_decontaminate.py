import re

import pytest

from strata.llm import decontaminate as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def brute(text, items, n):
    own, hit, ids = words(text), set(), set()
    for i, t in items:
        w = words(t)
        size = min(n, len(w))
        for a in range(len(w) - size + 1) if w else ():
            for b in range(len(own) - size + 1):
                if own[b:b + size] == w[a:a + size]:
                    hit |= set(range(b + 1, b + size + 1))
                    ids.add(str(i))
    return len(own), sorted(hit), sorted(ids)


@pytest.fixture(scope="module")
def items(spark, texts):
    own = [(7, texts[0][:90]), (10, "One TWO"), (11, None), (12, "..."), (12, "one"), (13, texts[4][20:140]), (13, texts[4][20:140])]
    return own, spark.createDataFrame(own, "item_id long, text string")


@pytest.mark.parametrize("bound", [200_000, 0])
def test_hits_match_brute_force(frame, rows, items, bound):
    data = [(i, t) for i, t in rows if len(t or "") < 3000] + [(4000, "Say: ONE-two, then É it's one"), (4001, "one " * 4000)]
    got = d.scan(frame(data), items[1], n=6, broadcast_windows=bound)
    assert {"hits", "items", "word", "score"} <= set(got.columns)
    rows = got.collect()
    assert len(rows) == len(data)
    by = {r["doc_id"]: (r["n_words"], r["hits"], r["items"]) for r in rows}
    for i, t in data:
        assert by[i] == brute(t, items[0], 6), t


def test_removal(spark, frame, items):
    docs = frame([(1, "a b c ONE, two! d"), (2, "clean text"), (3, None)], extra=False)
    scanned = d.scan(docs, items[1], n=6)
    assert {r["doc_id"] for r in d.remove_documents(scanned).collect()} == {2, 3}
    assert {r["doc_id"]: r["text"] for r in d.remove_spans(scanned).collect()} == {1: "a b c , ! d", 2: "clean text", 3: None}
    none = d.scan(docs, items[1].limit(0))
    assert d.digest(none).where("contaminated").count() == 0
    assert d.scan(docs.limit(0), items[1]).count() == 0


def test_a_filter_on_the_result_splits_no_text_again(frame, items):
    """One word split in the optimized plan, none inside a lambda: work in proportion to the text."""
    scanned = d.scan(frame([(1, "a b")]), items[1], n=6)
    for df in (scanned, d.remove_documents(scanned), d.digest(scanned).where("contaminated"), scanned.where("n_words > 3")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(") == 1, plan[:2000]


def test_removal_from_a_very_long_text(frame, items, texts):
    long = " ".join(f"word{i % 977}" for i in range(20_000))
    docs = frame([(1, long), (2, f"{long} {texts[4][20:140]} {long}")], extra=False)
    assert [r["doc_id"] for r in d.remove_documents(d.scan(docs, items[1], n=6)).collect()] == [1]
