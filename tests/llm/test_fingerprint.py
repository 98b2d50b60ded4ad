import hashlib

import xxhash

from strata.llm import fingerprint as f


def chained(*values: bytes) -> int:
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v, seed=seed)
    return seed


def winnow(text):
    """Fingerprints by comparing every window's hashes one by one."""
    b = lambda x: x.to_bytes(8, "little")
    one = [chained(w.encode()) for w in text.lower().translate(str.maketrans("\n\t\r", "   ")).split(" ")]
    if len(one) < f.K:
        grams = [chained(*map(b, one))]
    else:
        two = [chained(b(x), b(y)) for x, y in zip(one, one[1:])]
        grams = [chained(b(x), b(y)) for x, y in zip(two, two[2:])]
    low, out = (1 << 33) - 1, []
    for a in range(max(1, len(grams) - f.W + 1)):
        best = min(range(a, min(a + f.W, len(grams))), key=lambda i: (grams[i] & low, -i))
        if best not in out:
            out.append(best)
    return [(grams[i], i) for i in out]


def test_digest_matches_brute_force(frame, rows):
    data = [r for n, r in enumerate(rows) if r not in rows[:n]]
    got = {r["doc_id"]: r for r in f.digest(f.edited_pairs(frame(data), ranges=5)).collect()}
    ordered = sorted(((i, t or "") for i, t in data), reverse=True)
    for (i, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        own, other, new = ({h for h, _ in winnow(t)} for t in (text, after, edited))
        r = got[i]
        assert r["n_chars"] == len(text) and r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        for t, column in ((text, "fingerprint"), (edited, "edited_fingerprint")):
            assert r[column] == ",".join(f"{h & 0xFFFFFFFF:x}@{p}" for h, p in winnow(t))
        assert abs(r["near_edited"] - len(own & new) / len(own | new)) < 1e-12
        assert abs(r["near_next"] - len(own & other) / len(own | other)) < 1e-12


def test_order_of_ties_and_small_tables(frame):
    rows = [(None, "x y"), (3, "b"), (3, "a"), (9, "c d")]
    got = {(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in f.digest(f.edited_pairs(frame(rows), ranges=3)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert got == {(9, 3, sha("c a"[:2] + "a")), (3, 1, sha("a")), (3, 1, sha("b")), (None, 3, sha("x c"))}
    alone = f.digest(f.edited_pairs(frame([(1, "a b c d")]), ranges=3)).first()
    assert (alone["n_chars"], alone["edited_sha256"]) == (7, sha("a b a b"))
    assert alone["near_next"] == 1.0
    assert f.digest(f.edited_pairs(frame([]), ranges=3)).count() == 0


def test_a_shared_passage_is_always_found(texts):
    passage = " ".join(f"p{i}" for i in range(f.K + f.W - 1))
    for a, b in zip(texts[:10], texts[10:20]):
        assert {h for h, _ in winnow(f"{a} {passage} {b}")} & {h for h, _ in winnow(f"{b} {passage} {a}")}


def test_texts_are_shuffled_once(frame, rows):
    """Both windows run in one dealing out and one sort of the texts."""
    plan = f.edited_pairs(frame(rows), ranges=5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning(_range") == 1 and plan.count("Sort [_range") == 1, plan[:3000]
