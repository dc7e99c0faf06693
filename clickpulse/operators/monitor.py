"""Traffic monitoring over arrival time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.json_fields import coerce, extract_object, to_long, unreadable
from clickpulse.functions.times import bucket, utc_day, utf16_length
from clickpulse.schema import LATENESS_BOUND_MS, MONEY, MONITOR_INTERVAL_S

_COUNTS = ("cnt", "chars", "searches", "clicks", "buys", "max_delay_ms")


def monitor_facts(raw: DataFrame) -> DataFrame:
    """Per record, what it adds to each counter. Nothing is dropped: a broken line still
    counts as one record with its size. An unreadable ``ts`` hides the behaviour; an
    unreadable price on a purchase hides the amount and the delay."""
    sized = raw.select("timestamp", "value", utf16_length(F.col("value")).alias("chars"))
    rows = extract_object(sized, ["behavior", "ts", "priceCNY"], ["timestamp", "chars"])
    counted = F.col("is_object") & ~unreadable(F.col("ts"), "bigint")
    buy = counted & (F.col("behavior") == "buy")
    timed = counted & ~(F.coalesce(F.col("behavior") == "buy", F.lit(False)) & unreadable(F.col("priceCNY"), MONEY))
    return rows.select(
        "timestamp",
        "chars",
        F.when(counted, F.col("behavior")).alias("behavior"),
        F.when(buy, coerce(F.col("priceCNY"), MONEY)).alias("amount"),
        F.when(timed, F.unix_millis("timestamp") - to_long(F.col("ts"))).alias("delay"),
    )


def with_rates(rows: DataFrame, seconds: float) -> DataFrame:
    """Adds per-second rates and the funnel percentages."""
    return funnel_columns(
        rows.withColumn("qps", F.col("cnt") / F.lit(float(seconds))).withColumn(
            "kb_per_s", F.col("chars") / F.lit(1024.0) / F.lit(float(seconds))
        )
    )


def funnel_columns(rows: DataFrame) -> DataFrame:
    """Click per search and buy per click in percent, 0 where the base is 0."""

    def percent(part: str, base: str):
        return F.when(F.col(base) == 0, F.lit(0.0)).otherwise(
            F.col(part).cast("double") / F.col(base).cast("double") * 100
        )

    return rows.withColumn("click_rate", percent("clicks", "searches")).withColumn(
        "buy_rate", percent("buys", "clicks")
    )


def monitor_counts(raw: DataFrame, seconds: int = MONITOR_INTERVAL_S) -> DataFrame:
    """Counters per arrival interval."""
    facts = monitor_facts(raw)
    return (
        facts.groupBy(F.window("timestamp", f"{seconds} seconds").alias("w"))
        .agg(
            F.count(F.lit(1)).alias("cnt"),
            F.sum("chars").alias("chars"),
            F.sum("amount").alias("amount"),
            F.count_if(F.col("behavior") == "search").alias("searches"),
            F.count_if(F.col("behavior") == "click").alias("clicks"),
            F.count_if(F.col("behavior") == "buy").alias("buys"),
            F.greatest(F.coalesce(F.max("delay"), F.lit(0)), F.lit(0)).cast("bigint").alias("max_delay_ms"),
        )
        .select(F.unix_millis("w.start").alias("window_start"), *_COUNTS, "amount")
    )


def monitor_intervals(raw: DataFrame, seconds: int = MONITOR_INTERVAL_S, *, fill_empty: bool = False) -> DataFrame:
    """Counters and rates per arrival interval; ``fill_empty`` adds intervals without records."""
    counts = monitor_counts(raw, seconds)
    if fill_empty:
        counts = _fill_empty(counts, seconds * 1000)
    rows = counts.withColumn("chars", F.coalesce("chars", F.lit(0))).withColumn(
        "gmv", F.coalesce(F.col("amount").cast("double"), F.lit(0.0))
    )
    return with_rates(rows, seconds).select(
        "window_start", "cnt", "chars", "gmv", "searches", "clicks", "buys", "max_delay_ms",
        "qps", "kb_per_s", "click_rate", "buy_rate",
    )


def _fill_empty(counts: DataFrame, step_ms: int) -> DataFrame:
    """Each interval, and after it those without records up to the next one, all counters zero.

    The next interval is looked up within the day; a day's last one takes the first of a later day. Days
    are matched through a tree over their first intervals, so nothing is ordered in one task and the records are
    read once. A gap becomes hours first, and an hour its intervals.
    """
    day_ms = 24 * max(3_600_000 // step_ms, 1) * step_ms
    days = counts.withColumn("day", bucket(F.col("window_start"), day_ms))
    inside = Window.partitionBy("day").orderBy("window_start")
    marked = days.select("*", F.lead("window_start").over(inside).alias("next"), F.lag("window_start").over(inside).alias("before"))
    # the first interval of later days, as the largest of what is before them with all signs turned
    # always true, and uses all counters, so that this side shares the shuffle of the other
    each = sum((F.coalesce(F.col(c), F.lit(0)) for c in _COUNTS), F.abs(F.coalesce(F.col("amount"), F.lit(0)))) >= 0
    firsts = marked.filter(F.col("before").isNull() & each).select((-F.col("day")).alias("at"), (-F.col("window_start")).alias("first"))
    later = _earlier_max(firsts, "at", "first", day_ms).select((-F.col("at")).alias("day"), (-F.col("earlier")).alias("later"))
    end = F.coalesce("next", "later", F.col("window_start") + step_ms)
    gaps = marked.join(later, "day", "left").withColumn("end", end).drop("day", "next", "before", "later")
    hour_ms = day_ms // 24
    hours = F.explode(F.sequence("window_start", F.col("end") - 1, F.lit(hour_ms))).alias("from")
    split = gaps.select("*", hours)
    last = F.least(F.col("end"), F.col("from") + hour_ms) - step_ms
    filled = split.select("*", F.explode(F.sequence("from", last, F.lit(step_ms))).alias("start"))
    own = F.col("start") == F.col("window_start")
    return filled.select(
        F.col("start").alias("window_start"),
        *[F.when(own, F.col(c)).otherwise(0).cast("bigint").alias(c) for c in _COUNTS],
        F.when(own, F.col("amount")).alias("amount"),
    )


def funnel_rates(events: DataFrame, by: str = "countryCode") -> DataFrame:
    """Search, click and buy counts with their conversion percentages per group."""
    counts = events.groupBy(F.col(by).alias("grp")).agg(
        F.count_if(F.col("behavior") == "search").alias("searches"),
        F.count_if(F.col("behavior") == "click").alias("clicks"),
        F.count_if(F.col("behavior") == "buy").alias("buys"),
    )
    return funnel_columns(counts)


def backlog_alarm(intervals: DataFrame, max_delay_ms: int = LATENESS_BOUND_MS, max_qps: float | None = None) -> DataFrame:
    """Intervals over a threshold, with the reason."""
    slow = F.col("max_delay_ms") >= max_delay_ms
    busy = F.col("qps") >= max_qps if max_qps is not None else F.lit(False)
    return intervals.filter(slow | busy).select(
        "window_start", "cnt", "max_delay_ms", "qps", F.when(slow, "delay").otherwise("rate").alias("reason")
    )


def lateness_profile(
    events: DataFrame,
    *,
    bound_ms: int = LATENESS_BOUND_MS,
    chunk_ms: int = 60_000,
    quantiles: tuple[float, ...] = (),
) -> DataFrame:
    """Per arrival day: delayed rows, largest delay, rows beyond the bound, and rows that
    arrive after a newer event of the same user. Rows without a user count, but are in no order.

    The running maximum per user is cut into chunks of arrival time. A chunk's rows are
    ordered in one task; the maximum of all earlier chunks comes from one summary row per
    chunk, so a user with a large part of all rows is spread over many tasks.
    """
    rows = events.select(
        F.coalesce("userId", F.lit("")).alias("userId"),
        "eventId",
        F.unix_millis("timestamp").alias("arrival"),
        F.unix_millis("event_ts").alias("event_ms"),
    ).withColumn("chunk", bucket(F.col("arrival"), chunk_ms))
    inside = Window.partitionBy("userId", "chunk").orderBy("arrival", "eventId")
    marked = rows.select(
        *rows.columns,
        F.max("event_ms").over(inside.rowsBetween(Window.unboundedPreceding, -1)).alias("newest_before"),
        F.lead("arrival").over(inside).isNull().alias("chunk_end"),
    )
    earlier_chunks = Window.partitionBy("userId").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = marked.filter("chunk_end").select(
        "userId", "chunk", F.max(F.greatest("newest_before", "event_ms")).over(earlier_chunks).alias("carry")
    )
    marked = marked.join(carried, ["userId", "chunk"])
    late = (F.col("event_ms") < F.greatest("newest_before", "carry")) & (F.col("userId") != "")
    delay = F.col("arrival") - F.col("event_ms")
    counts = marked.groupBy(utc_day(F.col("arrival")).alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(delay > 0).alias("delayed"),
        F.count_if(late).alias("out_of_order"),
        F.count_if(delay > bound_ms).alias("beyond_bound"),
        F.max(F.greatest(delay, F.lit(0))).alias("max_delay_ms"),
        *[F.percentile_approx(delay, q).alias(f"delay_p{round(q * 100)}") for q in quantiles],
    )
    return counts.withColumn("out_of_order_share", F.col("out_of_order") / F.col("n"))


def _earlier_max(rows: DataFrame, at: str, value: str, width: int, levels: int = 48) -> DataFrame:
    """``at, earlier``: for each place, a multiple of ``width``, the largest value at smaller places; the first has none.

    Places are the leaves of a binary tree whose nodes hold maxima. What is before a place is one node on each
    level where the place's number has a one. So ``levels`` rows for each place are grouped, and none is ordered.
    """
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    leaves = rows.select(at, value, (F.col(at) / width + 2.0 ** (levels - 1)).cast("bigint").alias("number"), level)
    nodes = leaves.groupBy("level", F.expr("shiftright(number, level)").alias("node")).agg(F.max(value).alias("earlier"))
    asked = leaves.filter("shiftright(number, level) % 2 = 1").selectExpr(f"`{at}`", "level", "shiftright(number, level) - 1 AS node")
    return asked.join(nodes, ["level", "node"]).groupBy(at).agg(F.max("earlier").alias("earlier"))


def lateness_profile_global(
    events: DataFrame, *, bound_ms: int = LATENESS_BOUND_MS, chunk_ms: int = 1000, chunks: int = 4096
) -> DataFrame:
    """Per arrival day: delayed rows, largest delay, rows beyond the bound, and rows that arrive after a newer
    event of anyone. Rows arriving at the same time are in the order of their event ids.

    The running maximum has three levels: the rows of a chunk of arrival time, the chunks of a block, and the
    blocks, so that nothing is ordered in one task.
    """
    rows = events.select(
        "eventId", F.unix_millis("timestamp").alias("arrival"), F.unix_millis("event_ts").alias("event_ms")
    ).withColumn("chunk", bucket(F.col("arrival"), chunk_ms))
    inside = Window.partitionBy("chunk").orderBy("arrival", "eventId")
    marked = rows.select(
        *rows.columns,
        F.max("event_ms").over(inside.rowsBetween(Window.unboundedPreceding, -1)).alias("newest_before"),
        F.lead("arrival").over(inside).isNull().alias("chunk_end"),
    )
    newest = marked.filter("chunk_end").select("chunk", F.greatest("newest_before", "event_ms").alias("newest"))
    newest = newest.withColumn("block", bucket(F.col("chunk"), chunk_ms * chunks))
    in_block = Window.partitionBy("block").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = newest.groupBy("block").agg(F.max("newest").alias("newest"))
    carried = newest.select("chunk", "block", F.max("newest").over(in_block).alias("in_block")).join(
        _earlier_max(blocks, "block", "newest", chunk_ms * chunks), "block", "left"
    )
    marked = marked.join(carried.select("chunk", F.greatest("in_block", "earlier").alias("carry")), "chunk")
    delay = F.col("arrival") - F.col("event_ms")
    counts = marked.groupBy(utc_day(F.col("arrival")).alias("day")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(delay > 0).alias("delayed"),
        F.count_if(F.col("event_ms") < F.greatest("newest_before", "carry")).alias("out_of_order"),
        F.count_if(delay > bound_ms).alias("beyond_bound"),
        F.max(F.greatest(delay, F.lit(0))).alias("max_delay_ms"),
    )
    return counts.withColumn("out_of_order_share", F.col("out_of_order") / F.col("n"))
