"""Behaviour records derived from the ``events`` and ``customer`` tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.schema import SITE_PREFIX, rate_table


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


# Fixed rules, the first that fits: an event's line without its user, with a time or an amount that is no number.
DAMAGE = """CASE WHEN event_id % 89 = 1 THEN regexp_replace(line, '"userId":"[^"]*"', '"userId":""')
     WHEN event_id % 83 = 2 THEN regexp_replace(line, '"ts":[0-9]+', '"ts":"zz"')
     WHEN event_id % 79 = 3 THEN regexp_replace(line, '"priceCNY":[0-9.]+', '"priceCNY":"x"') ELSE line END"""


def records_from(events: DataFrame, customers: DataFrame, *, damaged: bool = False) -> DataFrame:
    """Raw records: every event as one JSON line keyed by its user, with an arrival time. ``damaged`` makes some
    lines break each of the rules for clean rows.

    The customer join carries no hint. The line comes out of a one-element ``inline``, so
    that filters on it stay above and do not build the line again.
    """
    users = customers.selectExpr("c_custkey AS user_id", "pmod(c_nationkey, 8) AS idx")
    named = events.selectExpr(
        "event_id",
        "user_id",
        "CAST(ts AS date) AS day",
        "unix_millis(CAST(ts AS timestamp)) AS ms",
        "CASE event_type WHEN 'view' THEN 'search' WHEN 'purchase' THEN 'buy' ELSE event_type END AS behavior",
        "CAST(get_json_object(props, '$.k') AS int) AS k",
        "CAST(CASE WHEN event_type = 'purchase' THEN value ELSE 0 END AS decimal(12,2)) AS price",
        "concat('U', user_id + 1000) AS key",
    )
    joined = named.join(users, "user_id").join(F.broadcast(rate_table(events.sparkSession)), "idx")
    lines = joined.selectExpr(
        "key",
        f"""to_json(named_struct(
            'userId', key,
            'eventId', CAST(event_id AS string),
            'sessionId', concat('S', user_id, '-', day),
            'countryCode', country_code,
            'siteId', concat('{SITE_PREFIX}', country_code),
            'behavior', behavior,
            'itemId', if(behavior IN ('click', 'buy'), concat('ITEM-', k + 10000), ''),
            'searchTerm', if(behavior = 'search', concat('kw_', k % 20), ''),
            'age', if(event_id % 13 <> 0, user_id % 42 + 18, NULL),
            'level', if(event_id % 17 <> 0, elt(CAST(user_id % 4 + 1 AS int), 'Bronze', 'Silver', 'Gold', 'Diamond'), NULL),
            'price', price,
            'currency', currency,
            'priceCNY', CAST(price * rate AS decimal(18,6)),
            'ts', ms)) AS line""",
        "event_id",
        "event_id % 97 = 0 AS cut",
        "timestamp_millis(ms + if(event_id % 10 = 0, event_id % 5000, 0)) AS timestamp",
    )
    if damaged:
        lines = lines.withColumn("line", F.expr(DAMAGE))
    value = "if(cut, left(line, length(line) - 1), line)"
    return lines.selectExpr("key", f"inline(array(named_struct('value', {value})))", "timestamp")


def behavior_records(spark: SparkSession, sf_dir: str, *, damaged: bool = False) -> DataFrame:
    return records_from(load(spark, sf_dir, "events"), load(spark, sf_dir, "customer"), damaged=damaged)


def customer_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User profiles from the customer table: ``user_id, age, level``."""
    return load(spark, sf_dir, "customer").selectExpr(
        "concat('U', c_custkey + 1000) AS user_id",
        "CAST(c_custkey % 42 + 18 AS int) AS age",
        "CASE WHEN c_acctbal < 0 THEN 'Bronze' WHEN c_acctbal < 3000 THEN 'Silver' "
        "WHEN c_acctbal < 6000 THEN 'Gold' ELSE 'Diamond' END AS level",
    )
