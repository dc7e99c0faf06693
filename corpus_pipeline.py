"""From raw documents to packed sequences: the stages of a training-data pipeline.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept. All but the
last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.llm import packing, quality_rules, secret_scan, simhash, toxicity
from clickpulse.llm.shared import written
from clickpulse.llm.tokens import vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression-distance classifier doesn't call toxic; a fifth of the labels is held out."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    usable = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0
    model = toxicity.train_on(docs, labels, usable)
    return toxicity.accept(docs, model)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that break no quality rule."""
    return quality_rules.judge(docs).where("kept").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the one row with the smallest id; null ids come last."""
    return simhash.keep_one(docs, repeats=False, shingle=3, distance=3)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each secret replaced by a mark; ``n_chars`` counts the new text."""
    rows = secret_scan.redact(docs)
    return rows.withColumn("n_chars", F.coalesce(F.char_length("text").cast("bigint"), "n_chars")).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, ids included."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality rules", drop_low_quality),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", redact_secrets),
    ("packing", pack),
]

#: Compression, packing and redaction by entropy are beyond SQL; a test runs the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
