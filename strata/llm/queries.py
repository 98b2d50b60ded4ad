"""Registered queries of the operators: thin digests with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import binary_tokens, decontaminate, fingerprint, jaccard_join, language_id, line_dedup, packing, periodic_runs, ppm, secret_scan, toxicity, warc, whitening
from strata.llm.common import bucket_of_id, new_folder, table

#: The public tokenizer of the packing and binary-output queries; the end ids are fixed by their contracts.
TOKENIZER = "word_bpe_49k.json"


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def op1_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = bucket_of_id("doc_id", 5) == 1
    return ppm.score(docs, ~held_out).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.classes(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where("toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    taught = labels.where(bucket_of_id("doc_id", 3) != 1)
    model = toxicity.fit(toxicity.labelled_sample(docs, taught))
    return toxicity.score(docs, model).select(
        "doc_id", (bucket_of_id("doc_id", 3) == 1).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.7).cast("int").alias("predicted"), "toxic_spans")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.digest(decontaminate.scan(docs, table(spark, sf_dir, "benchmark")))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER),
                                  end_id=1, capacity=4096)
    return packing.pack(pieces, capacity=4096)


def op6_binary_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    shards = binary_tokens.write(table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER),
                                 end_id=2, partitions=_partitions(spark))
    return binary_tokens.read(spark, path, shards)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(bucket_of_id("doc_id", 5) != 0))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (bucket_of_id("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.link(table(spark, sf_dir, "documents"), n=4, percent=85)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.digest(fingerprint.edited_pairs(table(spark, sf_dir, "documents"), 4 * _partitions(spark)))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return secret_scan.digest(secret_scan.scan(docs))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return periodic_runs.digest(periodic_runs.find(periodic_runs.repeat_tails(docs), min_words=24, exponent=3))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.transform(vectors, k=32).select(
        "vec_id", "component", "n", F.col("deviation").try_cast("long").alias("deviation"), "whitened", "explained", "identity_error")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    index = warc.write(table(spark, sf_dir, "pages"), path, min_payload=0)
    return warc.read(spark, path, index, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_ppm, op2_line_dedup, op3_toxicity, op4_decontaminate, op5_packing, op6_binary_tokens, op7_language_id, op8_jaccard_join, op9_fingerprints, op10_secret_scan,
        op11_periodic_runs, op12_whitening, op13_warc)}


def oracle_sql() -> dict[str, str]:
    return {"op4_decontaminate": decontaminate.ORACLE_SQL, "op13_warc": warc.ORACLE_SQL}
