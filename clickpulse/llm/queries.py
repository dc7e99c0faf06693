"""One thin query for each operator: it applies the operator to its whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.llm import (
    alignment,
    byte_bpe,
    embedding_dedup,
    packing,
    quality_classifier,
    quality_rules,
    recurrent_lm,
    secret_scan,
    simhash,
    token_files,
    toxicity,
    url_filters,
    whitening,
)
from clickpulse.llm.shared import shared_folder
from clickpulse.llm.tokens import vocabulary

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    token_files.write(_table(spark, sf_dir, "documents", "doc_id", "text"), folder, vocabulary("byte_bpe_50k.json"), end_id=2)
    n_tokens = (F.octet_length("tokens") / 4).cast("bigint").alias("n_tokens")
    return token_files.read(spark, folder).select("doc_id", "start", n_tokens, F.crc32("tokens").alias("ids_crc32"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(_table(spark, sf_dir, "documents", "doc_id", "text"), shingle=3, distance=3)
    return rows.select("doc_id", simhash.hex_digits(F.col("fingerprint")).alias("fingerprint"), "component_id")


# The rules of the contract.
URL_RULES = (
    url_filters.UrlRule("allow", "com", "/"),
    url_filters.UrlRule("block", "example.com", "/en/"),
    url_filters.UrlRule("allow", "www.example.com", "/en/"),
    url_filters.UrlRule("block", "net", "/es/"),
    url_filters.UrlRule("block", "net", "/fr/"),
)


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = url_filters.judge(_table(spark, sf_dir, "pages", "page_id", "url", "html"), URL_RULES)
    return rows.select("page_id", "host", "path", "rule", "verdict")


def _remainder(parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: what the contract holds out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % parts


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "toxic")
    model = toxicity.train_on(documents, labels, _remainder(5) != 0)
    rows = toxicity.score(documents, model)
    held_out, predicted = (_remainder(5) == 0).alias("held_out"), (F.col("score") >= 0.5).cast("int").alias("predicted")
    return rows.select("doc_id", held_out, "score", predicted)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules.judge(_table(spark, sf_dir, "documents", "doc_id", "text"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return rows.select("doc_id", *(f"measures.{c}" for c in base), "base_failed", "kept")


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = vocabulary("byte_bpe_50k.tiktoken")
    rows = byte_bpe.encode(_table(spark, sf_dir, "documents", "doc_id", "text"), path, public_tokenizers.PATTERN)
    return byte_bpe.digests(byte_bpe.decode(rows, path))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    rows = packing.pack(documents, vocabulary("byte_bpe_50k.json"), end_id=1)
    crc = F.crc32("tokens").alias("ids_crc32")
    return rows.select("doc_id", "start", "length", crc, "doc_tokens", "sequence_id", "offset", "tier", "step_id")


def op8_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    found = embedding_dedup.near_duplicates(rows, cosine=0.98)
    return found.select("vec_id", "n_links", "component_id", "kept")


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan(_table(spark, sf_dir, "documents", "doc_id", "text"))
    spans, base = F.col("secret_spans"), secret_scan.KINDS[:3]

    def count(kind: str) -> Column:
        number = secret_scan.KINDS.index(kind)
        return F.size(F.filter(spans, lambda s: s["kind_no"] == number)).cast("bigint").alias(f"n_{kind}")

    digest = F.sha2(secret_scan.rendered(spans, base), 256).alias("base_sha256")
    return rows.select("doc_id", *(count(k) for k in base), digest, secret_scan.rendered(spans).alias("spans"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    labels = _table(spark, sf_dir, "labels", "doc_id", "quality")
    model = quality_classifier.train_on(documents, labels, _remainder(4) != 2)
    rows = quality_classifier.score(documents, model)
    held_out, predicted = (_remainder(4) == 2).alias("held_out"), (F.col("score") >= 0.7).cast("int").alias("predicted")
    return rows.select("doc_id", held_out, "score", predicted)


def op11_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.score(_table(spark, sf_dir, "documents", "doc_id", "text"), _remainder(7) == 2)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whitening.whiten(_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    return rows.withColumn("deviation", F.col("deviation").try_cast("bigint"))


def op13_cross_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents", "doc_id", "text")
    return alignment.cross_alignment(documents, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_token_files": op1_token_files,
        "op2_simhash_near_dedup": op2_simhash_near_dedup,
        "op3_url_filters": op3_url_filters,
        "op4_toxicity": op4_toxicity,
        "op5_quality_rules": op5_quality_rules,
        "op6_byte_bpe": op6_byte_bpe,
        "op7_packing": op7_packing,
        "op8_embedding_near_dedup": op8_embedding_near_dedup,
        "op9_secret_scans": op9_secret_scans,
        "op10_quality_classifier": op10_quality_classifier,
        "op11_recurrent_lm": op11_recurrent_lm,
        "op12_embedding_whitening": op12_embedding_whitening,
        "op13_cross_alignment": op13_cross_alignment,
    }
