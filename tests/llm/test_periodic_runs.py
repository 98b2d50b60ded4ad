import hashlib
import random
import re
import sys
import zlib

import pytest

from strata.llm import periodic_runs as p
from strata.llm.queries import queries


def brute(words, least=24, exponent=3):
    """Maximal equal stretches at every distance; of equal stretches the smallest distance is the period."""
    found, n = {}, len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - a >= max(least, exponent * q):
                found.setdefault((a, i + q), q)
    return sorted(((a, b - a, q) for (a, b), q in found.items()), key=lambda r: (r[0], r[2]))


def names(xs):
    return [str(x).encode() for x in xs]


def rows_of(seed, kinds=60):
    rng = random.Random(seed)
    rep = lambda root, n: [root[k % len(root)] for k in range(n)]
    letters = lambda k, n: [rng.randrange(k) for _ in range(n)]
    for _ in range(kinds):
        yield letters(2, rng.randint(0, 90))
        yield letters(3, rng.randint(0, 200))
        out = []
        for _ in range(rng.randint(1, 6)):
            root = letters(rng.choice([2, 3, 50]), rng.randint(1, rng.choice([3, 9, 40])))
            out += letters(4, rng.randint(0, 12)) + rep(root, rng.randint(1, 5 * len(root) + 30))
        yield out
        # stretches of one small period between other words, themselves repeated
        root = rep(letters(2, rng.randint(1, 4)), rng.randint(5, 90)) + [7] * rng.randint(1, 2) + rep(letters(2, rng.randint(1, 3)), rng.randint(0, 40))
        yield letters(2, rng.randint(0, 50)) + rep(root, rng.randint(len(root), 4 * len(root) + 20)) + letters(2, rng.randint(0, 9))
        yield rep(letters(1, 60) + [9], rng.randint(1, 400))


@pytest.mark.parametrize("seed", range(6))
def test_runs_match_brute_force(seed):
    n = 0
    for words in map(names, rows_of(seed)):
        want = brute(words)
        n += len(want)
        assert p.runs_of(words) == want, words
        assert p.runs_of(words, 10, 4) == brute(words, 10, 4), words
        assert p.runs_of(words, 1, 3) == brute(words, 1, 3), words
    assert n > 100


def test_words_appended_one_by_one_or_in_parts():
    for k, xs in enumerate(rows_of(77, 12)):
        words, rng = names(xs), random.Random(k)
        detector, whole, at = p.Detector(), p.numbers(words), 0
        while at < len(words):
            step = rng.choice([1, 2, 7, 30])
            detector.append(whole[at * p.WIDTH:(at + step) * p.WIDTH])
            at = min(len(words), at + step)
            if rng.random() < 0.05:
                assert detector.runs() == brute(words[:at])
        assert detector.runs() == brute(words)


def test_work_is_in_proportion_to_the_words():
    """Executed lines on repeated stretches of one word, on one word alone and on words that never come again."""
    def steps(words):
        seen = 0

        def count(frame, event, arg):
            nonlocal seen
            seen += event == "line"
            return count

        before = sys.gettrace()
        sys.settrace(count)
        try:
            p.runs_of(words)
        finally:
            sys.settrace(before)
        return seen

    kinds = {"one": lambda n: ["a"] * n, "none": range, "parted": lambda n: [("b" if k % 999 == 0 else "a") for k in range(n)],
             "halves": lambda n: [("b" if k % (n // 4) == 0 else "a") for k in range(n)]}
    for name, kind in kinds.items():
        few, many = steps(names(kind(4_000))), steps(names(kind(32_000)))
        assert many < 14 * few, name
        assert many < 60 * 32_000, name


def expected(doc_id, text):
    """The query's row by the contract alone."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    if doc_id is not None and n:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            period = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % period] for i in range(n)]
    runs = brute(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] * 10 ** 12 // r[2], r[0], r[2]), default=(None,) * 3)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_digest_matches_brute_force(frame, rows):
    odd = [(i, " ".join(names_ := [str(x) for x in xs]) + "\t" * (len(names_) % 3)) for i, xs in enumerate(rows_of(5, 30), 5000)]
    data = [r for r in rows if len(r[1] or "") < 4000] + odd + [(None, "a " * 40), (None, None), (-3, "é  \v" * 60), (7000, "\x1c \x85 " * 40)]
    found = p.find(p.repeat_tails(frame(data)))
    assert {"runs", "collapsed", "word", "score"} <= set(found.columns)
    got = [tuple(r) for r in p.digest(found).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r[6])
    assert sorted(got, key=key) == sorted((expected(*r) for r in data), key=key)
    assert sum(r[1] > 0 for r in got) > 50
    assert p.digest(p.find(p.repeat_tails(frame([])))).count() == 0


def test_clashing_columns_and_a_long_text(frame):
    docs = frame([(1, "x " * 100_000 + "y"), (2, " ".join(map(str, range(50_000))))])
    from pyspark.sql import functions as F
    docs = docs.withColumn("runs", F.lit(1)).withColumn("collapsed", F.lit("c")).withColumn("_best", F.lit(2)).withColumn("_g", F.lit(0))
    got = {r["doc_id"]: r for r in p.find(p.repeat_tails(docs)).collect()}
    assert [tuple(r) for r in got[1]["runs"]] == [(0, 100_000, 1)] and got[1]["collapsed"] == "x y" and got[1]["_g"] == 0
    assert got[2]["runs"] == [] and got[2]["collapsed"] == got[2]["text"]
    assert p.digest(p.find(docs)).count() == 2


def test_registered_query_on_a_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    short = {i: t for i, t in docs.items() if len(t or "") < 20_000}
    got = {r["doc_id"]: tuple(r) for r in queries()["op11_periodic_runs"](spark, sf).collect()}
    assert set(got) == set(docs)
    assert all(got[i] == expected(i, t) for i, t in short.items())
