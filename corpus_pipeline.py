"""The corpus pipeline: documents in, encoded training rows out.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame.  ``run`` writes every stage's rows as Parquet into the
shared folder and reads them back as the next stage's documents.  All stages
but the last keep the columns of their documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm import bpe, kernel, mixing, pii, simhash
from fundlake.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go (operator 6)."""
    stats = written(kernel.features(docs), "quality-stats")
    model = kernel.fit(stats, table(spark, sf_dir, "labels"), "quality")
    return docs.where(kernel.score_column(F.col("text"), model) >= kernel.ACCEPT)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays (operator 2)."""
    return simhash.keep_one(docs)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind (operator 1); n_chars follows."""
    model = pii.fit(docs)
    out = docs.withColumn("text", pii.redact_column(F.col("text"), model))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are used as often as their fitted rates say (operator 4)."""
    labelled = mixing.language_labels(docs, table(spark, sf_dir, "labels"))
    mixer, _ = mixing.fit(docs, labelled, mixing.TARGETS)
    return mixing.mix(docs, mixer)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids): the token ids of every text (operator 8)."""
    return bpe.encode(docs).select(F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("quality_kernel", quality), ("simhash_near_dedup", near_dedup), ("pii_lstm", redact),
          ("soft_mixing", mix), ("bpe_encode", encode)]

# Learned models and fingerprints have no SQL form; tests/llm/test_pipeline.py
# holds the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
