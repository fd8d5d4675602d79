"""The numbered queries over the driver's tables, and their DuckDB SQL.

Each query applies one operator, with production parameters, to its whole
table.  Queries without SQL are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontaminate, jaccard, negatives, oracle, packing, private, quality, repeats, secrets, sharding, toxicity, urls, warc,
    whitening)
from tidemark.sources.scratch import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, d: str) -> DataFrame:
    return spark.read.parquet(f"{d}/documents.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """A vocabulary of the installed public tokenizers; every machine of the
    cluster has them at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    return quality.measure(_documents(spark, d)).drop("n_lines")


def op2_warc_packages(spark: SparkSession, d: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{d}/pages.parquet"), scratch_path(spark, "warc"))


def op3_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontaminate.find(_documents(spark, d), spark.read.parquet(f"{d}/benchmark.parquet"))


def op4_sharding(spark: SparkSession, d: str) -> DataFrame:
    out = sharding.shuffle_to_shards(_documents(spark, d), scratch_path(spark, "shards"))
    text = F.coalesce(F.col("row.text"), F.lit("")).cast("binary")
    return out.select(
        "row.doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_best_fit_packing(spark: SparkSession, d: str) -> DataFrame:
    out = packing.pack_documents(_documents(spark, d), tokenizer_path())
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_secret_scans(spark: SparkSession, d: str) -> DataFrame:
    return secrets.scan(_documents(spark, d))


def op7_personal_data(spark: SparkSession, d: str) -> DataFrame:
    return private.find(_documents(spark, d))


def op8_repeated_passages(spark: SparkSession, d: str) -> DataFrame:
    return repeats.find(_documents(spark, d))


# The rules of the url filter query.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"),
             ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op9_url_filters(spark: SparkSession, d: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    return urls.judge(spark.read.parquet(f"{d}/pages.parquet"), rules)


def op10_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.join(_documents(spark, d))


def op11_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score(_documents(spark, d), spark.read.parquet(f"{d}/labels.parquet"))


def op12_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    label = F.col("label").cast("bigint")
    out = negatives.mine(spark.read.parquet(f"{d}/embeddings.parquet"), F.col("id") % 50 == 0,
                         F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label))
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_embedding_whitening(spark: SparkSession, d: str) -> DataFrame:
    out = whitening.whiten(spark.read.parquet(f"{d}/embeddings.parquet"))
    return out.withColumn("deviation", F.col("deviation").try_cast("bigint"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_warc_packages": op2_warc_packages,
    "op3_decontamination": op3_decontamination,
    "op4_sharding": op4_sharding,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_secret_scans": op6_secret_scans,
    "op7_personal_data": op7_personal_data,
    "op8_repeated_passages": op8_repeated_passages,
    "op9_url_filters": op9_url_filters,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_toxicity": op11_toxicity,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_embedding_whitening": op13_embedding_whitening,
}
ORACLES: dict[str, str] = dict(oracle.ORACLES)
