"""Inverted index over multi-language documents, and ranked term queries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.operators.ranking import top_n

# Fixed value: a token is a maximal run of letters and digits of any script, in lower case.
TOKEN_BREAK = r"[^\p{L}\p{N}]+"


def tokens(text: str) -> Column:
    """All tokens of the whole text."""
    return F.filter(F.split(F.lower(text), TOKEN_BREAK), lambda w: w != "")


#: A document's runs of equal words, as rows.
RUNS = (
    "inline(transform(starts, (s, j) -> named_struct("
    "'token', words[s], 'tf', CAST(coalesce(get(starts, j + 1), size(words)) - s AS bigint))))"
)


def _counted(documents: DataFrame, terms: Iterable[str] | None = None) -> DataFrame:
    """One row per document: its sorted tokens, and where each different one starts."""
    words = tokens("text")
    if terms is not None:
        words = F.filter(words, lambda w: w.isin(*terms))
    return documents.select(
        F.coalesce("lang", F.lit("")).alias("lang"), "doc_id", F.sort_array(words).alias("words")
    ).withColumn(
        "starts",
        F.expr(
            "filter(sequence(0, greatest(size(words) - 1, 0)),"
            " i -> i < size(words) AND (i = 0 OR words[i] <> words[i - 1]))"
        ),
    )


def postings(documents: DataFrame, terms: Iterable[str] | None = None) -> DataFrame:
    """One row per (language, token, document) with its term frequency ``tf``.

    A document is one row, so its tokens are counted within the row, as runs of the sorted
    token array, and no shuffle is needed.
    """
    return _counted(documents, terms).select("lang", "doc_id", F.expr(RUNS))


def _each() -> Column:
    """True for every posting, using all its columns: a plan that counts by it can share the
    shuffle of a plan that needs the rows."""
    return (F.col("tf") > 0) & F.col("doc_id").isNotNull()


def salted_postings(documents: DataFrame, salts: int) -> DataFrame:
    """Postings with a ``salt`` that spreads the postings of a common word.

    A word has one posting in a document, so of the postings of documents with m different words it has an m-th at
    most. These documents are spread by a hash over ``salts`` / m keys a word, one at least: no key has many more than
    one in ``salts`` of all postings, and in long documents, which hold nearly all postings, a word keeps one key.
    """
    keys = F.greatest(F.lit(1), F.floor(F.lit(salts) / F.greatest(F.lit(1), F.size("starts"))))
    # never null, so that a join on it adds no filter that would keep the two sides' shuffle apart
    salt = F.coalesce(F.pmod(F.xxhash64("doc_id"), keys).cast("int"), F.lit(0))
    return _counted(documents).withColumn("salt", salt).select("lang", "doc_id", "salt", F.expr(RUNS))


def inverted_index(documents: DataFrame, *, salts: int | None = None) -> DataFrame:
    """Postings with the document frequency ``df`` of their token. Postings stay rows.

    A common word's postings are spread by :func:`salted_postings`, ``salts`` being four times the shuffle partitions
    unless given, so a word in all documents keeps the whole cluster busy; at most that many counts per token are
    summed. Postings are shuffled once and not sorted; a task of the join holds the different words of its share.
    """
    salts = salts or 4 * int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salted = salted_postings(documents, salts).repartition("lang", "token", "salt")
    part = salted.groupBy("lang", "token", "salt").agg(F.count_if(_each()).alias("part"))
    totals = part.select(
        "lang", "token", "salt", F.sum("part").over(Window.partitionBy("lang", "token")).alias("df")
    )
    found = salted.join(totals.hint("shuffle_hash"), ["lang", "token", "salt"])
    return found.select("lang", "token", "doc_id", "tf", "df")


def search_documents(documents: DataFrame, terms: Iterable[str], k: int = 10) -> DataFrame:
    """The ``k`` best documents of each language for a few terms, by tf-idf with
    ``idf = ln((1 + N) / (1 + df))`` in fixed point, ties by document id.

    The texts are read once: matches are shuffled by document, which serves both the
    document frequencies and the scores.
    """
    wanted = sorted({t.lower() for t in terms})
    found = postings(documents, wanted).repartition("lang", "doc_id")
    # At most one row per language and term, so Spark's own size check picks the join.
    df = found.groupBy("lang", "token").agg(F.count_if(_each()).alias("df"))
    size = documents.groupBy(F.coalesce("lang", F.lit("")).alias("lang")).agg(F.count(F.lit(1)).alias("total"))
    idf = F.round(F.ln((F.col("total") + 1) / (F.col("df") + 1)), 6).cast("decimal(12,6)")
    weights = df.join(size, "lang").select("lang", "token", idf.alias("idf"))
    scored = (
        found.join(weights, ["lang", "token"])
        .groupBy("lang", "doc_id")
        .agg(F.sum(F.col("tf") * F.col("idf")).alias("score"))
    )
    best = top_n(scored, ["lang"], [F.desc("score"), F.asc("doc_id")], k)
    return best.select("lang", "rank", "doc_id", F.col("score").cast("double").alias("score"))
