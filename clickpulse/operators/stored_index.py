"""A stored inverted index that a query reads by its terms, and leaves out blocks of documents that cannot rank.

Postings are a table bucketed by token. A block is a range of hashed document ids, the same for all tokens; of a
token's postings in a block one with the largest term frequency also holds their number, and a view shows just these.
The sum of a block's largest contributions bounds what any of its documents can score. Another table has the documents
of each language.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickpulse.operators.ranking import top_n
from clickpulse.operators.search import inverted_index

#: Buckets of a stored index, documents of a block on average, and files of a bucket that blocks are spread over.
BUCKETS, WIDTH, SHARES = 64, 128, 8


def build_index(documents: DataFrame, table: str, path: str, *, buckets: int = BUCKETS, width: int = WIDTH) -> None:
    """Writes the index of ``documents`` as tables ``table`` and ``table_totals`` below ``path``, and the view
    ``table_blocks``.

    Postings are shuffled by bucket and share of blocks, so that a token of most documents is not one task's work. There
    they are put in order by token and block, which marks the largest of each and is nearly the order of the files.
    """
    blocks = max(1, -(-documents.count() // width))
    block = F.coalesce(F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int"), F.lit(0))
    placed = inverted_index(documents).withColumn("block", block).withColumns(
        {"bucket": F.pmod(F.hash("token"), F.lit(buckets)), "share": F.pmod(F.col("block"), F.lit(SHARES))}
    )
    # bucket and share follow from the other keys: with them the shuffle serves, behind them the order is the files'
    own = Window.partitionBy("token", "lang", "block", "bucket", "share").orderBy(F.desc("tf"))
    n = F.count(F.lit(1)).over(own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    marked = placed.repartition("bucket", "share").withColumn("n", F.when(F.row_number().over(own) == 1, n))
    stored = marked.drop("bucket", "share").write.bucketBy(buckets, "token").sortBy("token", "lang", "block")
    stored.option("path", f"{path}/postings").saveAsTable(table)
    documents.sparkSession.sql(
        f"CREATE VIEW {table}_blocks AS SELECT lang, token, block, tf AS max_tf, n FROM {table} WHERE n IS NOT NULL"
    )
    totals = documents.groupBy(F.coalesce("lang", F.lit("")).alias("lang")).agg(F.count(F.lit(1)).alias("total"))
    totals.write.option("path", f"{path}/totals").saveAsTable(f"{table}_totals")


def term_postings(spark: SparkSession, table: str, terms: Iterable[str]) -> DataFrame:
    """Postings of a few terms; only their buckets are read."""
    return spark.table(table).where(F.col("token").isin(_wanted(terms)))


def _wanted(terms: Iterable[str]) -> list[str]:
    return sorted({t.lower() for t in terms})


def _weights(spark: SparkSession, table: str, blocks: DataFrame) -> DataFrame:
    """``idf`` of each language and term, in fixed point."""
    df = blocks.groupBy("lang", "token").agg(F.sum("n").alias("df"))
    idf = F.round(F.ln((F.col("total") + 1) / (F.col("df") + 1)), 6).cast("decimal(12,6)")
    return df.join(spark.table(f"{table}_totals"), "lang").select("lang", "token", idf.alias("idf"))


def _gain(frequency: str) -> Column:
    return F.sum(F.col(frequency) * F.col("idf"))


def _best(found: DataFrame, weights: DataFrame, k: int) -> DataFrame:
    scored = found.join(weights, ["lang", "token"]).groupBy("lang", "doc_id").agg(_gain("tf").alias("score"))
    return top_n(scored, ["lang"], [F.desc("score"), F.asc("doc_id")], k)


def live_postings(spark: SparkSession, table: str, terms: Iterable[str], k: int = 10) -> DataFrame:
    """The postings that have to be scored: those in blocks whose bound reaches a language's ``k``-th score so far.

    That score comes from the ``k`` blocks with the highest bounds, each of which holds a document at least; no
    document outside the live blocks can be among the ``k`` best.
    """
    wanted = _wanted(terms)
    blocks = spark.table(f"{table}_blocks").where(F.col("token").isin(wanted))
    weights = _weights(spark, table, blocks)
    bounds = blocks.join(weights, ["lang", "token"]).groupBy("lang", "block").agg(_gain("max_tf").alias("bound"))
    first = top_n(bounds, ["lang"], [F.desc("bound"), F.asc("block")], k).select("lang", "block")
    found = term_postings(spark, table, wanted)
    sure = _best(found.join(first, ["lang", "block"]), weights, k)
    least = sure.groupBy("lang").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") == k)
    live = bounds.join(least, "lang", "left").where(F.col("least").isNull() | (F.col("bound") >= F.col("least")))
    return found.join(live.select("lang", "block"), ["lang", "block"])


def search_index(spark: SparkSession, table: str, terms: Iterable[str], k: int = 10, *, early_stop: bool = True) -> DataFrame:
    """The rows of :func:`clickpulse.operators.search.search_documents`, from a stored index.

    ``early_stop`` scores only :func:`live_postings`; the result is the same without it.
    """
    wanted = _wanted(terms)
    blocks = spark.table(f"{table}_blocks").where(F.col("token").isin(wanted))
    found = live_postings(spark, table, wanted, k) if early_stop else term_postings(spark, table, wanted)
    best = _best(found, _weights(spark, table, blocks), k)
    return best.select("lang", "rank", "doc_id", F.col("score").cast("double").alias("score"))
