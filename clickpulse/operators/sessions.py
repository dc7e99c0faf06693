"""Sessions by inactivity, and funnels over them.

A user may own a large part of all rows, so no step orders all rows of a user in one task.
Rows are spread by (user, time chunk), with chunks no wider than the gap, so that a break by
inactivity can only lie at the border of two chunks. Each chunk gives one summary row, and
only these summaries, whose number per user is bounded by the time range, are ordered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.times import bucket, duration_ms
from clickpulse.schema import SESSION_GAP_MS

#: Keys over which rows without a user are spread.
NOBODIES = 4096


def sessionize(
    events: DataFrame,
    gap_ms: int = SESSION_GAP_MS,
    *,
    user: str = "userId",
    time: str = "event_ts",
    tie: str = "eventId",
    keep: tuple[str, ...] = (),
    chunk_ms: int = 60_000,
) -> DataFrame:
    """``user, tie, event_ms, behavior`` and ``session_no`` (1, 2, ... per user). A session ends
    after more than ``gap_ms`` without a row, and after a purchase. At the same millisecond a
    purchase comes last.

    A row's number is one plus the purchases and the inactivity breaks before it; a break
    right after a purchase is not counted twice. Rows without a user belong to no session: they are kept
    with a null number, and spread over many keys on their way. Without ``keep`` columns the rows and
    the summaries come from one shuffle of one scan.
    """
    spread = F.pmod(F.xxhash64(tie, time), F.lit(NOBODIES)).cast("string")
    rows = events.select(
        F.col(user).isNull().alias("nobody"),
        F.coalesce(F.col(user).cast("string"), spread).alias("owner"),
        tie,
        F.coalesce("behavior", F.lit("")).alias("behavior"),
        F.unix_millis(time).alias("event_ms"),
        *keep,
    ).withColumn("chunk", bucket(F.col("event_ms"), min(gap_ms, chunk_ms)))
    who = ["nobody", "owner"]
    buy = F.col("behavior") == "buy"
    inside = Window.partitionBy(*who, "chunk").orderBy("event_ms", buy, tie)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.select(
        *rows.columns,
        F.sum(buy.cast("int")).over(so_far).alias("buys"),
        F.first("event_ms").over(so_far).alias("first"),
        F.lead("event_ms").over(inside).isNull().alias("chunk_end"),
    )
    summary = marked.filter("chunk_end").select(
        *who, "chunk", "first", F.col("event_ms").alias("last"), buy.alias("ends_in_buy"), "buys"
    )
    by_chunk = Window.partitionBy(*who).orderBy("chunk")
    idle = (F.col("first") - F.lag("last").over(by_chunk) > gap_ms) & ~F.lag("ends_in_buy").over(by_chunk)
    breaks = summary.withColumn("idle", F.coalesce(idle, F.lit(False)).cast("int"))
    through = by_chunk.rowsBetween(Window.unboundedPreceding, 0)
    base = breaks.select(
        *who, "chunk", (F.sum(F.col("idle") + F.col("buys")).over(through) - F.col("buys")).alias("base")
    )
    number = F.when(~F.col("nobody"), F.col("base") + F.col("buys") - buy.cast("int") + 1)
    return marked.join(base, [*who, "chunk"]).select(
        F.when(~F.col("nobody"), F.col("owner")).alias(user),
        tie, "event_ms", "behavior", *keep, number.cast("bigint").alias("session_no"),
    )


def session_windows(events: DataFrame, gap: str = "5 minutes", *, user: str = "userId") -> DataFrame:
    """Inactivity sessions without the cut at a purchase: ``session_start``, ``session_end``
    (last row plus the gap) and the number of rows.

    Batch rows are reduced per (user, gap-sized bucket) first. A stream uses Spark's own
    session window.
    """
    # the event time keeps this behind a stream's watermark, which all records advance
    known = events.filter(F.when(F.col("event_ts").isNotNull(), F.col(user).isNotNull()))
    if events.isStreaming:
        return (
            known.groupBy(F.session_window("event_ts", gap).alias("w"), user)
            .agg(F.count(F.lit(1)).alias("n_events"))
            .select(
                user,
                F.unix_millis("w.start").alias("session_start"),
                F.unix_millis("w.end").alias("session_end"),
                "n_events",
            )
        )
    gap_ms = duration_ms(gap)
    ms = F.unix_millis("event_ts")
    summary = (
        known.select(user, ms.alias("ms"))
        .groupBy(user, bucket(F.col("ms"), gap_ms).alias("chunk"))
        .agg(F.min("ms").alias("first"), F.max("ms").alias("last"), F.count(F.lit(1)).alias("n"))
    )
    by_chunk = Window.partitionBy(user).orderBy("chunk")
    fresh = F.coalesce(F.col("first") - F.lag("last").over(by_chunk) > gap_ms, F.lit(True))
    return (
        summary.withColumn("fresh", fresh.cast("int"))
        .withColumn("no", F.sum("fresh").over(by_chunk.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(user, "no")
        .agg(
            F.min("first").alias("session_start"),
            (F.max("last") + gap_ms).alias("session_end"),
            F.sum("n").alias("n_events"),
        )
        .drop("no")
    )


def session_funnel(sessions: DataFrame, *, user: str = "userId") -> DataFrame:
    """Sessions that reach search, then click, then buy, from rows of :func:`sessionize`; those in no session
    are left out.

    A purchase ends its session, so it is the last row and at most one. The order can then
    be told from first and last times alone: a click follows the first search if the last
    click is not older, and a purchase follows whatever else the session holds.
    """

    def times(step: str):
        return F.when(F.col("behavior") == step, F.col("event_ms"))

    per_session = sessions.filter("session_no IS NOT NULL").groupBy(user, "session_no").agg(
        F.min(times("search")).alias("first_search"),
        F.max(times("click")).alias("last_click"),
        F.max(times("buy")).alias("buy"),
    )
    searched = F.col("first_search").isNotNull()
    clicked = searched & F.coalesce(F.col("last_click") >= F.col("first_search"), F.lit(False))
    bought = clicked & F.col("buy").isNotNull()
    steps = per_session.agg(
        F.count(F.lit(1)).alias("sessions"),
        F.count_if(searched).alias("searched"),
        F.count_if(clicked).alias("clicked"),
        F.count_if(bought).alias("bought"),
    )
    return steps
