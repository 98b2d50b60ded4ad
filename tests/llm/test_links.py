import hashlib
import random
import re
from collections import defaultdict

import pytest

from strata.llm import jaccard_join, line_dedup
from strata.llm.components import components


def united(nodes, sets, percent):
    """Smallest node of each component, by comparing all pairs."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[:i]:
            same = len(sets[a] & sets[b])
            if same and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(200 + i, 201 + i) for i in range(40)] + [(5, 5), (300, None)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in links[:-1]:
        near[a].add(b), near[b].add(a)
    for node in near:
        seen, todo = {node}, [node]
        while todo:
            todo += (new := near[todo.pop()] - seen)
            seen |= new
        assert got.get(node, node) == min(seen)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefix_join_matches_all_pairs(frame, rows):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
        sets[i] = {tuple(w[k:k + 4]) for k in range(max(1, len(w) - 3))} if w else set()
    want = united(sets, sets, 85)
    got = jaccard_join.link(frame([*rows, (None, "without an id"), (None, "")])).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if r["doc_id"] is not None:
            assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), want[r["doc_id"]])
    assert sum(want[i] != i for i in want) >= 12
    assert jaccard_join.link(frame([])).count() == 0


def test_tables_are_deleted_once_nothing_reads_them(spark, frame, rows):
    from pathlib import Path

    from strata.session import shared_dir

    folder = Path(shared_dir(spark, "llm").removeprefix("file:"))
    read = {"signatures", "index", "texts", "sketches", "heads", "sets"}
    for run in (line_dedup.classes, jaccard_join.link):
        before = set(folder.glob("*-*"))
        assert run(frame(rows)).count() >= len(rows)
        left = {p.name.split("-")[0] for p in set(folder.glob("*-*")) - before}
        assert left and not left & read


def test_shuffle_files_go_with_the_plan_that_made_them(spark):
    """A stored table's lineage ends, so nothing reads its shuffles again."""
    import time

    from pyspark.sql import functions as F

    from strata.llm.common import CLEANUP, stored

    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {b for b in blocks.getAllBlocks().mkString("\n").split("\n") if b.startswith("shuffle_")}
    set_before, before = spark.conf.get(CLEANUP, None), files()
    table = stored(spark.range(5000).groupBy((F.col("id") % 1000).alias("k")).count(), "counts")
    for _ in range(20):
        if not files() - before:
            break
        time.sleep(0.1)
    assert not files() - before
    assert table.count() == 1000
    assert spark.conf.get(CLEANUP, None) == set_before


def test_buckets_are_shuffled_in_parts(frame, rows, kept_lines, monkeypatch):
    """Whatever the number of parts, the same lines are kept, and a large table has several."""
    from strata.llm import common, components

    written = {}

    def counted(spark, make, parts, kind):
        written[kind] = max(parts, written.get(kind, 0))
        return common.stored_in_parts(spark, make, parts, kind)

    monkeypatch.setattr(line_dedup, "PART_LINES", 20)
    monkeypatch.setattr(components, "PART_ROWS", 2)
    monkeypatch.setattr(components, "REST_FACTOR", 0)
    monkeypatch.setattr(components, "MOST_STARS", 1)
    monkeypatch.setattr(line_dedup, "stored_in_parts", counted)
    monkeypatch.setattr(components, "stored_in_parts", counted)
    got = line_dedup.classes(frame(rows)).collect()
    assert {(r["doc_id"], r["line_no"]): r["keep"] for r in got} == kept_lines[1]
    assert written["index"] > 1 and written["sketches"] > 1 and written.get("pairs", 2) > 1


def test_the_table_of_lines_to_fetch_grows_with_them(spark, monkeypatch):
    """However many lines share a bucket, most others are not fetched again, and none of them is missed."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(line_dedup, "FETCH_POWERS", (4, 28))
    every = spark.range(40_000).select(F.xxhash64("id").alias("node"), "id")
    nodes = every.where("id < 10000").select("node")
    got = line_dedup.held(every, nodes).agg(F.count_if(F.col("id") < 10_000), F.count("*")).first()
    assert got[0] == 10_000 and got[1] < 20_000


def test_links_within_a_prefix_group(frame):
    """Three sets of equal size and prefix: the head is unlike the two others, which link."""
    words = lambda name, k: [f"{name}{i}" for i in range(k)]
    node = lambda w: jaccard_join.shingles(" ".join(w), 4)
    first = words("p", 7)  # four shingles: the prefix of 20
    name = lambda w: int.from_bytes(hashlib.blake2b(node(w).tobytes(), digest_size=8).digest(), "little", signed=True)
    for k in range(100):
        head, one = first + words(f"h{k}x", 16), first + words("m", 16)
        two = [*one[:-1], "other"]
        if name(head) < min(name(one), name(two)):
            break
    docs = [head, one, two]
    for i in range(5):  # the shingles outside the prefix are frequent
        docs.append([w for d, part in enumerate((head, one, two)) for w in (*words(f"f{i}d{d}x", 40), *part[4:])])
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link(frame([(i, " ".join(d)) for i, d in enumerate(docs)])).collect()}
    sets = {i: set(node(d).tolist()) for i, d in enumerate(docs)}
    assert len(sets[1]) == 20 and len(sets[1] & sets[2]) == 19 and len(sets[0] & sets[1]) == 4
    assert got == united(sets, sets, 85) and got[2] == 1 and got[0] == 0


@pytest.fixture(scope="module")
def kept_lines(rows):
    every = {(i, n): s for i, t in rows if t for n, s in enumerate(t.split("\n"))}
    filled = {k: s.lower() for k, s in every.items() if s.strip(" \t\r")}
    sets = {s: {s[i:i + 5] for i in range(max(1, len(s) - 4))} for s in filled.values()}
    root = united(sets, sets, 80)
    first = {}
    for k in sorted(filled):
        first.setdefault(root[filled[k]], k)
    return every, {k: k not in filled or first[root[filled[k]]] == k for k in every}


def test_lines_match_all_pairs(frame, rows, kept_lines):
    every, kept = kept_lines
    got = line_dedup.classes(frame(rows)).collect()
    assert {(r["doc_id"], r["line_no"]): r["keep"] for r in got} == kept
    assert all((r["class_id"] is None) == (not every[r["doc_id"], r["line_no"]].strip(" \t\r")) for r in got)


def test_lines_are_removed(frame, rows, kept_lines):
    every, kept = kept_lines
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove(frame(rows)).collect()}
    for i, t in rows:
        parts = (t or "").split("\n")
        left = [s for n, s in enumerate(parts) if kept.get((i, n), True)]
        if len(left) == len(parts):
            assert got[i] == t
        elif not "".join(left).strip():
            assert i not in got
        else:
            assert got[i] == "\n".join(left)
    assert line_dedup.remove(frame([])).count() == 0


def test_rows_of_one_id_or_none_keep_their_own_lines(frame):
    line = lambda w: " ".join(f"{w}{i}" for i in range(12))
    rows = [(1, f"{line('a')}\n{line('b')}"), (None, f"{line('c')}\n{line('a')}"), (None, f"{line('d')}\n{line('e')}"),
            (None, line("b")), (2, f"{line('f')}\n{line('g')}"), (2, f"{line('a')}\n{line('h')}"), (None, f"{line('i')}\n{line('i')}")]
    got = sorted(r["text"] for r in line_dedup.remove(frame(rows)).collect())
    assert got == sorted([rows[0][1], line("c"), rows[2][1], rows[4][1], line("h"), line("i")])


def test_lines_match_all_pairs_of_all_character_shingles(frame):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzé") for _ in range(rng.randint(2, 9)))
    lines = ["abc", "ABC", "abcde", "日本語のテキスト", "x" * 3000]
    for k in (6, 10, 14, 20):
        for _ in range(12):
            own = " ".join(word() for _ in range(k))
            at = rng.randrange(len(own))
            lines += [own, own[:at] + "Q" + own[at + 1:], own + " tail", own.replace(" ", "", 1)]
    sets = {s: {s[i:i + 5] for i in range(max(1, len(s) - 4))} for s in {x.lower() for x in lines}}
    root = united(sets, sets, 80)
    docs = ["\n".join(lines[i::7]) for i in range(7)]
    places = {(i, n): s.lower() for i, t in enumerate(docs) for n, s in enumerate(t.split("\n"))}
    first = {}
    for k in sorted(places):
        first.setdefault(root[places[k]], k)
    got = line_dedup.classes(frame(list(enumerate(docs)))).collect()
    assert {(r["doc_id"], r["line_no"]): r["keep"] for r in got} == {k: first[root[s]] == k for k, s in places.items()}
    assert sum(root[s] != s for s in sets) > 60


def test_parities_never_refuse_a_link(spark):
    """The screen lets every linking pair pass, also with slack for groups, and refuses unlike pairs."""
    import numpy as np
    from pyspark.sql import functions as F

    from strata.llm.components import may_link, parities

    rng, rows = np.random.default_rng(6), []
    for k in range(400):
        n = int(rng.integers(1, 300))
        one = rng.integers(0, 1 << 48, n, dtype=np.uint64)
        cut = int(rng.integers(0, max(1, n // 4) + 1))
        two = np.concatenate([one[cut:], rng.integers(0, 1 << 48, int(rng.integers(0, cut + 2)), dtype=np.uint64)]) if k % 2 else rng.integers(
            0, 1 << 48, n, dtype=np.uint64)
        a, b = set(one.tolist()), set(two.tolist())
        linked = bool(b) and 100 * len(a & b) >= 85 * len(a | b)
        apart = len(a ^ b)
        sketch = lambda s, slack: (len(s), parities(np.array(sorted(s), np.uint64), 8), slack)
        rows.append((sketch(a, 0), sketch(b, 0), linked, n, apart, sketch(a, apart)))
    kind = "struct<n:int,bits:array<long>,slack:int>"
    df = spark.createDataFrame(rows, f"a {kind}, b {kind}, linked boolean, n int, apart int, c {kind}")
    test = may_link(8, 85)
    got = df.select("linked", "n", test(F.col("a"), F.col("b")).alias("may"), test(F.col("c"), F.col("b")).alias("loose")).collect()
    assert all(r["may"] for r in got if r["linked"]) and sum(r["linked"] for r in got) > 50
    assert all(r["loose"] for r in got)
    assert sum(not r["may"] for r in got) > 150


def test_groups_whose_heads_are_unlike_still_link_by_members(frame):
    """Two groups of near copies in a chain: only members in between link the groups."""
    base = [f"w{i}" for i in range(130)]
    docs = []
    for k in range(14):  # each moves a few words further
        base = base[:9 * k] + [f"c{k}x{j}" for j in range(2)] + base[9 * k + 2:]
        docs.append(list(base))
    data = [(i, " ".join(w)) for i, w in enumerate(docs)] + [(100, " ".join(docs[-1])), (200, "something else altogether here")]
    sets = {i: set(jaccard_join.shingles(t, 4).tolist()) for i, t in data}
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link(frame(data)).collect()}
    assert got == united(sets, sets, 85)
    assert got[13] == 0 and 100 * len(sets[0] & sets[13]) < 85 * len(sets[0] | sets[13])


def test_lines_are_compared_by_sql_alone(spark, frame, rows):
    from pyspark.sql import functions as F

    each = line_dedup.lines(frame(rows))
    signed = line_dedup.signatures(each)
    texts = each.where("node is not null").select("node", F.lower("line").alias("text")).dropDuplicates(["node"])
    ends = texts.agg(F.min("node").alias("a"), F.max("node").alias("b"))
    for df in (signed, line_dedup.sketches_of(signed, texts), line_dedup.verify(ends, texts)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not [n for n in ("MapInArrow", "Python", "Pandas") if n in plan]


def test_a_long_line_has_each_shingle_once(spark):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    texts = ["a", "abcd", "abcde", "🙂é" * 40] + ["".join(rng.choice("abé🙂 ") for _ in range(n)) for n in (63, 64, 65, 66, 67, 68, 69, 128, 132, 133, 1000)]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.size(line_dedup.shingle_set(F.col("t"))).alias("n")).collect()
    assert {r["t"]: r["n"] for r in got} == {t: len({t[i:i + 5] for i in range(max(1, len(t) - 4))}) for t in texts}


def test_pairs_of_long_prefixes_leave_the_bucket_join_once(spark):
    """Two sketches that name the first of their buckets only: one pair, however many buckets they share."""
    from pyspark.sql import functions as F

    from strata.llm.components import _rest

    apart = spark.createDataFrame([(b, n, 1, n, 9) for b in range(40) for n in (1, 2)] + [(b, 3, 1, 3, 9) for b in range(30, 40)],
                                  "bucket long, node long, info int, root long, main long")
    sketches = spark.createDataFrame([(1, {"buckets": list(range(24))}), (2, {"buckets": list(range(24))}), (3, {"buckets": list(range(50, 60))})],
                                     "node long, sketch struct<buckets:array<long>>")
    pairs = _rest(apart, lambda one, two: F.lit(True), sketches, lambda one, two: F.lit(True))
    assert sorted(map(tuple, pairs.collect())) == [(1, 2), (1, 3), (2, 3)]


def test_a_prefix_pair_must_be_able_to_link_from_its_first_common_shingle_on(spark):
    """Shingles of a common passage come last in the prefixes; there, too few are left for a link."""
    from pyspark.sql import functions as F

    near = [((100, p, 20), (100, q, 20)) for p, q in ((0, 0), (8, 8), (8, 3), (9, 0), (14, 14))]
    kind = "struct<n:int,p:int,q:int>"
    got = spark.createDataFrame(near, f"one {kind}, two {kind}").select(jaccard_join._near(85, F.col("one"), F.col("two"))).collect()
    assert [r[0] for r in got] == [True, True, True, False, False]


def test_documents_with_common_passages_match_all_pairs(frame):
    rng = random.Random(8)
    passage = [f"p{i}" for i in range(160)]
    docs = []
    for k in range(30):
        own = [f"w{k}x{j}" for j in range(rng.choice((15, 30, 300)))]
        docs += [own + passage, passage[:rng.randint(100, 160)] + own, [*own[:7], f"new{k}", *own[8:], *passage]]
    data = list(enumerate(" ".join(d) for d in docs))
    sets = {i: set(jaccard_join.shingles(t, 4).tolist()) for i, t in data}
    want = united(sets, sets, 85)
    assert {r["doc_id"]: r["component_id"] for r in jaccard_join.link(frame(data)).collect()} == want
    assert 3 < len(set(want.values())) < 80


def test_star_pairs_are_screened_before_their_sets_are_read(spark):
    """A bucket's head is unlike the rows of its bucket but one: only that pair is checked."""
    import numpy as np
    from pyspark.sql import functions as F

    from strata.llm.common import stored
    from strata.llm.components import WIDTHS, connect, may_link, parities, words_of

    rng = np.random.default_rng(2)
    sets = [rng.integers(0, 1 << 48, 500, dtype=np.uint64) for _ in range(8)]
    sets[1] = np.concatenate([sets[0][:490], sets[1][:10]])
    sets[2] = np.concatenate([sets[0][:375], sets[2][:125]])  # similarity 0.6
    rows = [(k, (500, parities(s, words_of(500)), 0, [7])) for k, s in enumerate(sets)]
    sketches = stored(spark.createDataFrame(rows, "node long, sketch struct<n:int,bits:array<long>,slack:int,buckets:array<long>>"), "sketches")
    index = stored(spark.createDataFrame([(7, k, 500, 0) for k in range(8)], "bucket long, node long, info int, rank int"), "index")
    seen = []

    def check(pairs):
        seen.extend(map(tuple, pairs.collect()))
        return pairs

    roots = connect(index, None, lambda one, two: F.lit(True), sketches, may_link(WIDTHS[0][1], 80), check)
    assert [tuple(r) for r in roots.collect()] == [(1, 0)] and seen == [(0, 1)]


def test_sketches_of_different_widths_may_link(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from strata.llm.components import WIDTHS, may_link, parities, words_of

    rng, rows = np.random.default_rng(5), []
    for least, _ in WIDTHS[:-1]:
        for n in (least - 1, least + 20):
            own = rng.integers(0, 1 << 48, n, dtype=np.uint64)
            other = rng.integers(0, 1 << 48, n, dtype=np.uint64)
            sketch = lambda s: (len(s), parities(s, words_of(len(s))), 0)
            rows += [(sketch(own), sketch(own[:int(n * 0.9)]), True), (sketch(own), sketch(other), False)]
    kind = "struct<n:int,bits:array<long>,slack:int>"
    df = spark.createDataFrame(rows, f"a {kind}, b {kind}, linked boolean")
    got = df.select("linked", may_link(WIDTHS[0][1], 85)(F.col("a"), F.col("b")).alias("may")).collect()
    assert all(r["may"] == r["linked"] for r in got)


def test_long_lines_have_wide_sketches(spark, frame):
    """Lines of similarity 0.6 are refused by their sketches, alike ones pass."""
    from pyspark.sql import functions as F

    from strata.llm.components import may_link

    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    base = text(600)
    lines = [base, base[:450] + text(150), base[:580] + text(20), base[:450] + "é" + text(150), base[:300] + "é" + base[301:]]
    each = line_dedup.lines(frame([(i, s) for i, s in enumerate(lines)]))
    texts = each.select("node", F.lower("line").alias("text"))
    one = line_dedup.sketches_of(line_dedup.signatures(each), texts).join(each.select("doc_id", "node"), "node").select("doc_id", "sketch")
    both = one.where("doc_id = 0").select(F.col("sketch").alias("s")).join(one.where("doc_id > 0"))
    words = len(one.first()["sketch"]["bits"])
    got = {r["doc_id"]: r["may"] for r in both.select("doc_id", may_link(words, 80)(F.col("s"), F.col("sketch")).alias("may")).collect()}
    assert got == {1: False, 2: True, 3: False, 4: True}


def test_a_shingle_has_one_hash_in_texts_of_bytes_and_of_parts(spark):
    from pyspark.sql import functions as F

    text = " ".join(f"word{i}" for i in range(60))
    df = spark.createDataFrame([(text, text + "é")], "a string, b string")
    a, b = df.select(line_dedup.shingle_set(F.col("a")), line_dedup.shingle_set(F.col("b"))).first()
    assert set(a) < set(b) and len(b) == len(a) + 1
