"""Currency, site and profile columns from lookup joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.schema import DEFAULT_AGE, DEFAULT_LEVEL, SITE_PREFIX, rate_table


def with_cny(rows: DataFrame, price: str = "price", currency: str = "currency", out: str = "price_cny") -> DataFrame:
    """Adds price times rate as a decimal, null for a currency without a rate. The rate table
    is a literal of eight rows, so it is broadcast."""
    rates = rate_table(rows.sparkSession).select(F.col("currency").alias("_currency"), "rate")
    joined = rows.join(F.broadcast(rates), F.col(currency) == F.col("_currency"), "left")
    amount = F.col(price).cast("decimal(24,8)") * F.col("rate")
    return joined.withColumn(out, amount.cast("decimal(36,12)")).drop("_currency", "rate")


def with_site(rows: DataFrame, country: str = "countryCode", prefix: str = SITE_PREFIX, out: str = "site") -> DataFrame:
    """Adds the site id made from the country."""
    return rows.withColumn(out, F.concat(F.lit(prefix), F.col(country)))


def gmv_by_day_country(archive: DataFrame) -> DataFrame:
    """CNY revenue and purchases by day and country from archive rows, which hold price and
    currency only."""
    buys = archive.filter(F.col("behavior") == "buy")
    return (
        with_cny(buys)
        .groupBy("dt", "country_code")
        .agg(F.count(F.lit(1)).alias("buys"), F.sum("price_cny").cast("double").alias("gmv"))
    )


def profile_enrich(events: DataFrame, profiles: DataFrame, user: str = "userId") -> DataFrame:
    """Profile columns ``age`` and ``level`` joined on the user; a user without a profile keeps
    the event's own values, then the defaults. ``profiles`` holds one row per user: a second one
    would double the user's events.

    No hint is given: Spark broadcasts the profiles only where their measured size is under
    its limit. Beyond it this is a shuffle join whose hot users are split at run time.
    """
    known = profiles.select(
        F.col("user_id").alias("_user"), F.col("age").alias("_age"), F.col("level").alias("_level")
    )
    joined = events.join(known, F.col(user) == F.col("_user"), "left")
    return (
        joined.withColumn("has_profile", F.col("_user").isNotNull())
        .withColumn("age", F.coalesce("_age", "age", F.lit(DEFAULT_AGE)))
        .withColumn("level", F.coalesce("_level", "level", F.lit(DEFAULT_LEVEL)))
        .drop("_user", "_age", "_level")
    )


