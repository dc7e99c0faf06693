"""Event-time window aggregates. Each works on a batch and, unchanged, on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.times import bucket, duration_ms
from clickpulse.schema import GMV_WINDOW, HOT_SLIDE, HOT_WINDOW


def _kept(events: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition holds. It refers to the event time, so that on a stream it stays
    behind the watermark, which then advances on all records and not only on these."""
    return events.filter(F.when(F.col("event_ts").isNotNull(), condition))


def gmv_tumbling(events: DataFrame, size: str = GMV_WINDOW) -> DataFrame:
    """Sum of ``priceCNY`` over purchases per tumbling window. A purchase without an amount
    adds nothing, and a window with no other has no row."""
    return (
        _kept(events, F.col("behavior") == "buy")
        .groupBy(F.window("event_ts", size).alias("w"))
        .agg(F.sum("priceCNY").alias("total"))
        .filter(F.col("total").isNotNull())
        .select(
            F.unix_millis("w.start").alias("window_start"),
            F.unix_millis("w.end").alias("window_end"),
            F.col("total").cast("double").alias("gmv"),
        )
    )


def gmv_report(gmv: DataFrame) -> DataFrame:
    """One text line per window, the amount with two decimals, rounded half up."""
    amount = F.round(F.col("gmv").cast("decimal(28,6)"), 2).cast("decimal(28,2)").cast("string")
    return gmv.select("window_end", F.concat(F.lit("GMV (CNY): "), amount).alias("line"))


def _window_ends(pane_start: Column, size: str, slide: str) -> Column:
    """Ends of all windows that hold the pane of ``slide`` length that starts here."""
    step = duration_ms(slide)
    return F.explode(F.sequence(pane_start + step, pane_start + duration_ms(size), F.lit(step)))


def _panes(events: DataFrame, size: str, slide: str) -> bool:
    """Whether counts per pane add up to counts per window: on a batch, where slides divide the size."""
    return not events.isStreaming and duration_ms(size) % duration_ms(slide) == 0


def key_counts(events: DataFrame, key: str, size: str, slide: str, condition: Column | None = None) -> DataFrame:
    """Rows per key in each sliding window: ``word, window_end, n``.

    A batch counts per pane of one slide first; only those counts are copied to their windows.
    """
    known = F.col(key).isNotNull()
    kept = _kept(events, known if condition is None else condition & known)
    if _panes(events, size, slide):
        start = bucket(F.unix_millis("event_ts"), duration_ms(slide))
        panes = kept.groupBy(start.alias("pane"), F.col(key).alias("word")).agg(F.count(F.lit(1)).alias("n"))
        spread = panes.select("word", _window_ends(F.col("pane"), size, slide).alias("window_end"), "n")
        return spread.groupBy("word", "window_end").agg(F.sum("n").alias("n"))
    return (
        kept.groupBy(F.window("event_ts", size, slide).alias("w"), F.col(key).alias("word"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select("word", F.unix_millis("w.end").alias("window_end"), "n")
    )


def hot_word_counts(events: DataFrame, size: str = HOT_WINDOW, slide: str = HOT_SLIDE) -> DataFrame:
    """Searches per term in each sliding window."""
    return key_counts(events, "searchTerm", size, slide, F.col("behavior") == "search")


def hot_word_counter(counts: DataFrame) -> DataFrame:
    """Number of (term, window) results, which is what the metric ``total_search_count`` counts."""
    return counts.agg(F.count(F.lit(1)).alias("total_search_count"))


def with_search_metric(counts: DataFrame, name: str = "hot_search") -> DataFrame:
    """The same rows, with ``total_search_count`` reported as an observed metric of each run or
    micro-batch."""
    return counts.observe(name, F.count(F.lit(1)).alias("total_search_count"))


def online_users(
    events: DataFrame, size: str = "5 minutes", slide: str = "1 minute", *, approximate: bool = False
) -> DataFrame:
    """Distinct users per sliding window.

    A batch reduces the rows to one per user and pane of one slide before it copies them to windows. A
    stream counts in two steps, per user and then per window, with a state row for each of the former;
    ``approximate`` keeps one sketch per window instead.
    """
    known = _kept(events, F.col("userId").isNotNull())
    if not approximate and _panes(events, size, slide):
        start = bucket(F.unix_millis("event_ts"), duration_ms(slide))
        seen = known.select(start.alias("pane"), "userId").distinct()
        spread = seen.select("userId", _window_ends(F.col("pane"), size, slide).alias("window_end"))
        return spread.groupBy("window_end").agg(F.count_distinct("userId").alias("users"))
    window = F.window("event_ts", size, slide).alias("w")
    if approximate:
        counted = known.groupBy(window).agg(F.approx_count_distinct("userId").alias("users"))
    else:
        counted = known.groupBy(window, "userId").count().groupBy("w").agg(F.count(F.lit(1)).alias("users"))
    return counted.select(F.unix_millis("w.end").alias("window_end"), "users")


def user_sketches(events: DataFrame, slide: str = "1 minute", *, precision: int = 14) -> DataFrame:
    """``pane`` (start of one slide) and ``sketch`` of its distinct users: one row, and in a stream one state row,
    for each pane, however many users it has. The relative error of an estimate is about 1.04 over the
    root of two to the power ``precision``: 0.8 % by default."""
    known = _kept(events, F.col("userId").isNotNull())
    window = F.window("event_ts", slide).alias("w")
    return known.groupBy(window).agg(F.hll_sketch_agg("userId", precision).alias("sketch")).select(
        F.unix_millis("w.start").alias("pane"), "sketch"
    )


def sketched_users(panes: DataFrame, size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    """Estimated distinct users of each window out of its panes' sketches, which may be stored ones. With a
    ``size`` that is the ``slide``, such as a day, panes are merged into longer ranges."""
    first = bucket(F.col("pane"), duration_ms(slide))
    spread = panes.select("sketch", _window_ends(first, size, slide).alias("window_end"))
    merged = spread.groupBy("window_end").agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select("window_end", F.hll_sketch_estimate("sketch").alias("users"))
