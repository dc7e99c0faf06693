"""Per-user and per-item summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.functions.times import bucket
from clickpulse.operators.ranking import top_n
from clickpulse.schema import DEFAULT_LEVEL


CUBE_PARTS = "country string, level string, userId string, amount decimal(38,10), buys bigint"


def cube_parts(events: DataFrame) -> DataFrame:
    """Amount and purchases per (country, level, user): what :func:`gmv_cube` sums, in rows that add up."""
    buy = F.col("behavior") == "buy"
    return events.groupBy(
        F.coalesce("countryCode", F.lit("")).alias("country"),
        F.coalesce("level", F.lit(DEFAULT_LEVEL)).alias("level"),
        "userId",
    ).agg(
        F.sum(F.when(buy, F.col("priceCNY"))).cast("decimal(38,10)").alias("amount"),
        F.count_if(buy).alias("buys"),
    )


def merged_parts(parts: DataFrame) -> DataFrame:
    """Parts of several runs as one row for each of their keys."""
    totals = F.sum("amount").cast("decimal(38,10)").alias("amount"), F.sum("buys").alias("buys")
    return parts.groupBy("country", "level", "userId").agg(*totals)


def cube_of(parts: DataFrame) -> DataFrame:
    """The cube over parts with one row for each of their keys."""
    return (
        parts.cube("country", "level")
        .agg(
            F.grouping_id().alias("gid"),
            F.sum("amount").alias("amount"),
            F.sum("buys").alias("buys"),
            F.count_distinct("userId").alias("users"),
        )
        .select(
            "country", "level", F.col("gid").cast("int").alias("gid"),
            F.coalesce(F.col("amount").cast("double"), F.lit(0.0)).alias("gmv"), "buys", "users",
        )
    )


def gmv_cube(events: DataFrame) -> DataFrame:
    """GMV, purchases and distinct users by country and level with all subtotals.

    Rows are reduced per (country, level, user) before the cube multiplies them.
    """
    return cube_of(cube_parts(events))


def user_profile(events: DataFrame) -> DataFrame:
    """Per user: rows by behaviour, spend, last seen, and the item touched most (ties by id).

    Both aggregations combine on the map side, so a user with very many items is no hot spot.
    """
    known = events.filter(F.col("userId").isNotNull())
    touch = F.col("behavior").isin("click", "buy") & (F.col("itemId") != "")
    per_item = known.groupBy("userId", F.when(touch, F.col("itemId")).alias("item")).agg(
        F.count_if(F.col("behavior") == "search").alias("searches"),
        F.count_if(F.col("behavior") == "click").alias("clicks"),
        F.count_if(F.col("behavior") == "buy").alias("buys"),
        F.sum(F.when(F.col("behavior") == "buy", F.col("priceCNY"))).alias("spend"),
        F.max(F.unix_millis("event_ts")).alias("last_seen"),
        F.count(F.lit(1)).alias("n"),
    )
    favourite = F.when(F.col("item").isNotNull(), F.struct((-F.col("n")).alias("neg"), F.col("item").alias("item")))
    return per_item.groupBy("userId").agg(
        F.sum("searches").alias("searches"),
        F.sum("clicks").alias("clicks"),
        F.sum("buys").alias("buys"),
        F.coalesce(F.sum("spend").cast("double"), F.lit(0.0)).alias("spend"),
        F.max("last_seen").alias("last_seen"),
        F.min(favourite)["item"].alias("favourite_item"),
    )


def item_cooccurrence(events: DataFrame, k: int = 10, *, chunk_ms: int = 60_000) -> DataFrame:
    """For each item, the ``k`` items most often next to it in a user's clicks and purchases.

    A row pairs with the row before it, so the pairs grow with the rows and not with their
    square, and no user's history needs a cap. Histories are cut into time chunks; pairs
    across a border come from the first and last item of neighbouring chunks.
    """
    touched = events.filter(
        F.col("behavior").isin("click", "buy") & (F.col("itemId") != "") & F.col("userId").isNotNull()
    ).select("userId", "eventId", "itemId", F.unix_millis("event_ts").alias("ms"))
    rows = touched.withColumn("chunk", bucket(F.col("ms"), chunk_ms))
    inside = Window.partitionBy("userId", "chunk").orderBy("ms", "eventId")
    marked = rows.select(
        "userId",
        "chunk",
        F.col("itemId").alias("item"),
        F.lag("itemId").over(inside).alias("previous"),
        F.first("itemId").over(inside.rowsBetween(Window.unboundedPreceding, 0)).alias("chunk_first"),
        F.lead("ms").over(inside).isNull().alias("chunk_end"),
    )
    by_chunk = Window.partitionBy("userId").orderBy("chunk")
    borders = marked.filter("chunk_end").select(
        F.col("chunk_first").alias("item"), F.lag("item").over(by_chunk).alias("previous")
    )
    pairs = (
        marked.select("item", "previous")
        .unionByName(borders)
        .filter(F.col("previous").isNotNull() & (F.col("previous") != F.col("item")))
    )
    return _best_pairs(pairs, k)


def _best_pairs(pairs: DataFrame, k: int) -> DataFrame:
    """From rows of two items to each item's ``k`` most frequent others."""
    counted = pairs.groupBy(
        F.least("item", "previous").alias("a"), F.greatest("item", "previous").alias("b")
    ).agg(F.count(F.lit(1)).alias("n"))
    sides = F.explode(
        F.array(
            F.struct(F.col("a").alias("item_id"), F.col("b").alias("other_id")),
            F.struct(F.col("b").alias("item_id"), F.col("a").alias("other_id")),
        )
    )
    both = counted.select(sides.alias("s"), "n").select("s.item_id", "s.other_id", "n")
    best = top_n(both, ["item_id"], [F.desc("n"), F.asc("other_id")], k)
    return best.select("item_id", "rank", "other_id", "n")


def item_pairs(
    events: DataFrame,
    reach: int = 3,
    k: int = 10,
    *,
    span_ms: int | None = None,
    chunk_ms: int = 60_000,
    piece: int = 1024,
) -> DataFrame:
    """For each item, the ``k`` items most often within ``reach`` steps of it in a user's clicks and purchases,
    and, with ``span_ms``, no further away in time.

    Every pair within reach counts, whatever a history's length: pairs grow with ``reach`` times the
    rows. A row's place in its history is its place in a time chunk plus the rows of the chunks before. The
    history is then cut into pieces of ``piece`` places, each with the last ``reach`` rows of the piece before
    it, so a user with a large part of all rows is spread over many tasks.
    """
    touched = events.filter(
        F.col("behavior").isin("click", "buy") & (F.col("itemId") != "") & F.col("userId").isNotNull()
    ).select("userId", "eventId", F.col("itemId").alias("item"), F.unix_millis("event_ts").alias("ms"))
    rows = touched.withColumn("chunk", bucket(F.col("ms"), chunk_ms))
    inside = Window.partitionBy("userId", "chunk").orderBy("ms", "eventId")
    numbered = rows.select(
        "userId", "chunk", "item", "ms",
        F.row_number().over(inside).cast("bigint").alias("no"), F.lead("ms").over(inside).isNull().alias("chunk_end"),
    )
    by_chunk = Window.partitionBy("userId").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    before = numbered.filter("chunk_end").select("userId", "chunk", (F.sum("no").over(by_chunk) - F.col("no")).alias("before"))
    place = (F.col("before") + F.col("no") - 1).alias("place")
    placed = numbered.join(before, ["userId", "chunk"]).select("userId", "item", "ms", place)
    size = max(piece, reach)
    own = F.floor(F.col("place") / size)
    # the last rows of a piece are also what the next piece looks back on
    pieces = F.when(F.pmod("place", F.lit(size)) >= size - reach, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = placed.select("*", own.alias("own"), F.explode(pieces).alias("piece"))
    earlier = Window.partitionBy("userId", "piece").orderBy("place").rowsBetween(-reach, -1)
    looked = dealt.select("*", F.collect_list(F.struct("item", "ms")).over(earlier).alias("earlier")).filter("own = piece")
    pairs = looked.select("item", "ms", F.explode("earlier").alias("e")).filter(F.col("e.item") != F.col("item"))
    if span_ms is not None:
        pairs = pairs.filter(F.col("ms") - F.col("e.ms") <= span_ms)
    return _best_pairs(pairs.select("item", F.col("e.item").alias("previous")), k)
