"""The corpus pipeline: stages in order, each over all its predecessor kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, written as
Parquet and read again as the next one's ``docs``.  All but the last return the
columns of ``documents``:

1. quality rules: documents that fail a rule go;
2. n-gram Jaccard join: of each group of near-duplicates the document with the
   least id stays;
3. benchmark decontamination: documents that hold an item go;
4. secret scans: spans are replaced by a mark, and ``n_chars`` follows;
5. best-fit packing: where each piece of each document lies.

Defined results: a null, empty or very short text fails the quality rules, so
its row goes in stage 1.  Given such rows all the same, stage 2 keeps one row of
each text (of repeated rows, and of rows with null ids only, any one), stage 3
keeps them, stage 4 leaves null texts null, and stage 5 gives each a piece of
one token.  Null ids and nulls in other columns ride along; an empty table gives
an empty result in every stage; extra columns stay in stages 1 to 4, whatever
their names, and are not read by stage 5.  Stage 4 needs a column ``n_chars``
(as ``documents`` has); it is the text's new length where a secret was replaced,
else as it was.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, jaccard, packing, quality, registry, secrets
from tidemark.sources.scratch import materialise


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep(docs)


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    before = docs.withColumn("n_chars", F.struct("n_chars", F.col("text").alias("before")))
    changed = ~F.col("text").eqNullSafe(F.col("n_chars.before"))
    return secrets.redact(before).withColumn(
        "n_chars", F.when(changed, F.length("text").cast("bigint")).otherwise(F.col("n_chars.n_chars")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, registry.tokenizer_path()).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("jaccard_join", jaccard_join),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: SQL cannot express the latent retrieval, the test battery or the tokenizer;
#: the stages are tested against brute force in ``tests/llm``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
