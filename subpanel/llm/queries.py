"""Registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontamination,
    fill_in_middle,
    jaccard,
    language,
    licenses,
    line_dedup,
    mixing,
    neighbours,
    secrets,
    sharding,
    token_counts,
    toxicity,
    whitening,
)
from .common import id_bucket, read_table
from .registry import ORACLES, QUERIES, register


@register("op1_secret_scan")
def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_digest(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@register("op2_license_scan", licenses.oracle())
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@register("op3_shards")
def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                          sharding.SHARDS)


@register("op4_benchmark_leaks")
def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated_pairs(
        read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
        read_table(spark, sf_dir, "benchmark", ["item_id", "text"]), least_words=1)


@register("op5_toxicity")
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                             read_table(spark, sf_dir, "labels", ["doc_id", "toxic"]))


@register("op6_nearest_vectors")
def op6_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]),
                             F.col("vec_id") % 20 == 0, k=20)


@register("op7_jaccard_join")
def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(
        read_table(spark, sf_dir, "documents", ["doc_id", "text"]), k=4, percent=85).drop("cls")


@register("op8_source_mix")
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents", ["doc_id", "text", "source"])).select(
        "doc_id", "size", "source_size", "target", "taken", "copies")


@register("op9_language_id")
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text", "lang"])
    held_out = id_bucket("doc_id", 3) == 1
    return language.identify_languages(
        docs.withColumn("held_out", held_out), docs.where(~held_out), keep=["doc_id", "held_out"])


@register("op10_token_counts")
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                     public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@register("op11_line_dedup", line_dedup.oracle())
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return line_dedup.deduplicate(documents, line_dedup.build(documents), texts=False)


@register("op12_fill_in_middle", fill_in_middle.oracle())
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


@register("op13_whitened_vectors")
def op13_whitened_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]))


def load() -> tuple[dict, dict]:
    return dict(QUERIES), dict(ORACLES)
