from collections import defaultdict

import corpus_pipeline as p
from pyspark.sql import functions as F

from strata.llm import queries
from strata.llm.common import stored

SF = "/root/testdata/sf0.001"


def test_stages(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = frame([(9001, None), (9002, "12 34"), (9003, "")], extra=False)
    copy = docs.where("doc_id < 5").selectExpr("doc_id + 9100 as doc_id", "text", "lang", "source", "n_chars")
    docs = docs.unionByName(odd).unionByName(copy).unionByName(docs.where("doc_id = 7"))
    named = p.identify_language(spark, docs, SF)
    assert named.columns == docs.columns
    ids = {r["doc_id"] for r in named.select("doc_id").collect()}
    assert not ids & {9001, 9002, 9003} and len(ids) >= 200
    once = p.drop_near_duplicates(spark, docs, SF)
    left = [r["doc_id"] for r in once.select("doc_id").collect()]
    assert len(left) == len(set(left)) and not set(left) & set(range(9100, 9105))
    clean = p.drop_contaminated(spark, docs, SF)
    assert clean.columns == docs.columns and clean.count() < docs.count()
    empty = docs.limit(0)
    for name, stage in p.STAGES:
        assert stage(spark, empty, SF).count() == 0, name


def test_no_language_to_learn_from(spark, frame):
    rows = [(1, "plain words"), (2, "слова"), (3, "12 34"), (4, None), (5, ""), (None, "ß 1")]
    got = p.identify_language(spark, frame(rows), SF)
    assert sorted((r["doc_id"] or 0, r["lang"]) for r in got.collect()) == [(0, None), (1, None), (2, None)]


def test_near_duplicates_of_rows_without_an_id_and_of_one_id(spark, frame):
    text = lambda w: " ".join(f"{w}{i}" for i in range(60))
    rows = [(3, text("a")), (3, text("b")), (3, text("b")), (None, text("a") + " tail"), (None, text("c")), (None, text("c")),
            (None, text("d")), (None, text("d") + " tail"), (5, None), (None, ""), (None, "")]
    got = sorted((r["doc_id"] or 0, (r["text"] or "")[:2]) for r in p.drop_near_duplicates(spark, frame(rows), SF).collect())
    assert got == [(0, ""), (0, "c0"), (0, "d0"), (3, "a0"), (3, "b0"), (5, "")]


def test_near_duplicates_by_five_words_at_80_percent(spark, frame):
    words = [f"w{i}" for i in range(60)]  # 56 shingles
    tail = lambda k: " ".join(words + [f"t{k}x{i}" for i in range(k)])
    docs = frame([(1, " ".join(words)), (2, tail(12)), (3, tail(15))])  # 56 / 68 and 56 / 71
    assert sorted(r["doc_id"] for r in p.drop_near_duplicates(spark, docs, SF).collect()) == [1, 3]


def test_columns_that_clash_with_what_the_stages_add(spark, frame):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    for name in ("items", "hits", "n_words", "score", "lang_pred", "_doc", "_words", "word", "line"):
        docs = docs.withColumn(name, F.concat(F.lit(f"{name} of "), F.col("doc_id")))
    want = {r["doc_id"]: r for r in docs.collect()}
    for name, stage in (("language", p.identify_language), ("decontaminate", p.drop_contaminated)):
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns
        rows = got.collect()
        assert rows and all(r == want[r["doc_id"]] for r in rows), name


def test_run(spark, tmp_path):
    """The whole pipeline: every piece belongs to a document that all stages kept, and no kept document is missing."""
    got = p.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in p.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF), f"test-{name}")
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert {r["doc_id"] for r in got} == kept and len(kept) > 100
    fill = defaultdict(int)
    for r in got:
        fill[r["sequence_id"]] += r["length"]
    assert max(fill.values()) <= p.CAPACITY
    pieces = {(r["doc_id"], r["piece"]) for r in got}
    assert len(pieces) == len(got)


def test_a_stage_leaves_its_result_until_the_next_is_stored(spark, monkeypatch):
    from pathlib import Path

    from strata.session import shared_dir

    folder, seen = Path(shared_dir(spark, "llm").removeprefix("file:")), []
    before = set(folder.glob("stage-*"))

    def stage(spark, docs, sf_dir):
        seen.append({f.name.split("-")[1] for f in set(folder.glob("stage-*")) - before})
        return docs.select("doc_id", "text")

    monkeypatch.setattr(p, "STAGES", [(name, stage) for name in "abcd"])
    assert p.run(spark, SF).count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert seen == [set(), {"a"}, {"b"}, {"c"}]


def test_names():
    assert [n for n, _ in p.STAGES] == ["language_id", "line_dedup", "jaccard_join", "decontaminate", "packing"]
    assert sorted(int(k[2:].split("_")[0]) for k in queries.queries()) == list(range(1, 14))
