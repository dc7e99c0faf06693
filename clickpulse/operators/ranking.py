"""Top-N per group and the reports made from it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.times import utc_stamp
from clickpulse.operators.windows import key_counts
from clickpulse.schema import HOT_TOP_N


def top_n(rows: DataFrame, by: list[str], order: list[Column], n: int) -> DataFrame:
    """First ``n`` rows of each group with their ``rank``. Spark cuts each task's groups to
    ``n`` rows before the shuffle, so a hot group costs no more than a small one."""
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col("rank") <= n)


def hot_search_topn(counts: DataFrame, n: int = HOT_TOP_N) -> DataFrame:
    """Top terms of each window: by count, then by term."""
    best = top_n(counts, ["window_end"], [F.desc("n"), F.asc("word")], n)
    return best.select("window_end", "rank", "word", "n")


def rank_lines(top: DataFrame) -> DataFrame:
    """One text line per rank, ``Top 1: word (5)``."""
    line = F.format_string("Top %d: %s (%d)", "rank", "word", "n")
    return top.select("window_end", "rank", line.alias("line"))


def hot_search_report(top: DataFrame) -> DataFrame:
    """One text block per window. A group holds at most N lines."""
    stamp = utc_stamp(F.col("window_end"))
    lines = F.transform(F.sort_array(F.collect_list(F.struct("rank", "line"))), lambda x: x["line"])
    return (
        rank_lines(top)
        .groupBy("window_end")
        .agg(lines.alias("lines"))
        .select(
            "window_end",
            F.concat(F.lit("Hot search "), stamp, F.lit("\n"), F.array_join("lines", "\n")).alias("report"),
        )
    )


def hot_search_latest(reports: DataFrame, field: str = "last_hot_search_result") -> DataFrame:
    """The newest report under one hash field."""
    newest = reports.agg(F.max_by("report", "window_end").alias("report"), F.max("window_end").alias("window_end"))
    return newest.filter("window_end IS NOT NULL").select(F.lit(field).alias("field"), "window_end", "report")


def hot_search_newest(counts: DataFrame, n: int = HOT_TOP_N) -> DataFrame:
    """The newest window's report under one hash field; no other window is ranked or formatted."""
    newest = counts.agg(F.max("window_end").alias("window_end"))
    return hot_search_latest(hot_search_report(hot_search_topn(counts.join(newest, "window_end"), n)))


def hot_search_by_rank(top: DataFrame) -> DataFrame:
    """The newest line per rank; the field is the text before the first colon."""
    lines = rank_lines(top).withColumn("field", F.trim(F.split_part("line", F.lit(":"), F.lit(1))))
    return lines.groupBy("field").agg(F.max_by("line", "window_end").alias("line"))


def hot_products_topn(events: DataFrame, size: str = "1 hour", slide: str = "10 minutes", n: int = 10) -> DataFrame:
    """Items with most clicks and purchases per sliding window."""
    touched = F.col("behavior").isin("click", "buy") & (F.col("itemId") != "")
    counts = key_counts(events, "itemId", size, slide, touched).withColumnRenamed("word", "item_id")
    best = top_n(counts, ["window_end"], [F.desc("n"), F.asc("item_id")], n)
    return best.select("window_end", "rank", "item_id", "n")


def sales_ranking(events: DataFrame, n: int = 10, by: tuple[str, ...] = ("countryCode",)) -> DataFrame:
    """Best-selling items of each group: by purchases, then amount, then item id."""
    sales = (
        events.filter((F.col("behavior") == "buy") & (F.col("itemId") != ""))
        .groupBy(*by, "itemId")
        .agg(F.count(F.lit(1)).alias("buys"), F.sum("priceCNY").alias("amount"))
    )
    best = top_n(sales, list(by), [F.desc("buys"), F.desc_nulls_last("amount"), F.asc("itemId")], n)
    return best.select(*by, "rank", F.col("itemId").alias("item_id"), "buys", F.col("amount").cast("double").alias("amount"))
