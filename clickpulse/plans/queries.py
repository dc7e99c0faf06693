"""The named queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators import archive, enrich, monitor, parse, profile, ranking, search, sessions, stored_index, windows
from clickpulse.plans import streams, tables
from clickpulse.session import checkpoint_root
from clickpulse.sources import catalog

Query = Callable[[SparkSession, str], DataFrame]

# 2024-01-20 00:00:30 UTC, between the arrival and the commit of that day.
AS_OF_MS = 1_705_708_830_000
WIDE_GAP_MS = 12 * 3_600_000
SEARCH_TERMS = ("the", "for", "la", "que", "une", "und", "der", "los")


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return tables.behavior_records(spark, sf_dir)


def _events(spark, sf_dir, fields, **options) -> DataFrame:
    return parse.parse_behavior(_raw(spark, sf_dir), fields, **options)


def _buys(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir, ["behavior", "priceCNY"], only="buy")


def _searches(spark, sf_dir) -> DataFrame:
    return _events(spark, sf_dir, ["behavior", "searchTerm"], only="search")


def _doubles(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _hot(spark, sf_dir, size="30 seconds", slide="10 seconds") -> DataFrame:
    return windows.hot_word_counts(_searches(spark, sf_dir), size, slide)


def _top(spark, sf_dir, size="30 seconds", slide="10 seconds") -> DataFrame:
    return ranking.hot_search_topn(_hot(spark, sf_dir, size, slide))


def parse_behavior(spark, sf_dir):
    rows = _doubles(_events(spark, sf_dir, None), "price", "priceCNY")
    return rows.withColumn("event_ms", F.unix_millis("event_ts")).drop("event_ts", "timestamp")


def behavior_to_kafka(spark, sf_dir):
    encoded = parse.encode_behavior(_events(spark, sf_dir, None))
    fields = "eventId string, behavior string, itemId string, age int, level string, priceCNY double, ts bigint"
    back = encoded.select("key", F.from_json("value", fields).alias("r")).select("key", "r.*")
    return back


def dwd_rows_sql(spark, sf_dir):
    catalog.register_source_view(_raw(spark, sf_dir), "behavior_source")
    return spark.sql(catalog.archive_query("behavior_source"))


def dwd_partition_commits(spark, sf_dir):
    rows = parse.archive_rows(_raw(spark, sf_dir), keep=["timestamp"])
    return archive.partition_commits(rows, AS_OF_MS)


def currency_to_cny(spark, sf_dir):
    rows = _events(spark, sf_dir, ["eventId", "countryCode", "behavior", "price", "currency"], only="buy")
    priced = enrich.with_site(enrich.with_cny(rows), out="site_id")
    return _doubles(priced.select("eventId", "countryCode", "site_id", "currency", "price", "price_cny"),
                    "price", "price_cny")


def profile_enrich(spark, sf_dir):
    rows = _events(spark, sf_dir, ["userId", "eventId", "age", "level"])
    joined = enrich.profile_enrich(rows, tables.customer_profiles(spark, sf_dir))
    return joined.select("userId", "eventId", "age", "level", "has_profile")


def _session_rows(spark, sf_dir, gap_ms):
    rows = _events(spark, sf_dir, ["userId", "eventId", "behavior"])
    return sessions.sessionize(rows, gap_ms)


def sessionize(spark, sf_dir, gap_ms=300_000):
    return _session_rows(spark, sf_dir, gap_ms).select("userId", "eventId", "event_ms", "behavior", "session_no")


def session_windows(spark, sf_dir, gap="5 minutes"):
    return sessions.session_windows(_events(spark, sf_dir, ["userId"]), gap)


def session_funnel(spark, sf_dir):
    return sessions.session_funnel(_session_rows(spark, sf_dir, WIDE_GAP_MS))


def lateness_profile(spark, sf_dir):
    return monitor.lateness_profile(_events(spark, sf_dir, ["userId", "eventId"]))


def lateness_profile_global(spark, sf_dir):
    return monitor.lateness_profile_global(_events(spark, sf_dir, ["eventId"]))


def search_stored_index(spark, sf_dir):
    """Builds the stored index of all documents and asks it."""
    name = f"index_{uuid.uuid4().hex}"
    stored_index.build_index(_documents(spark, sf_dir), name, f"{checkpoint_root(spark)}/{name}")
    return stored_index.search_index(spark, name, SEARCH_TERMS)


def gmv_by_day_country(spark, sf_dir):
    return enrich.gmv_by_day_country(parse.archive_rows(_raw(spark, sf_dir)))


def gmv_cube(spark, sf_dir):
    return profile.gmv_cube(_events(spark, sf_dir, ["userId", "countryCode", "level", "behavior", "priceCNY"]))


def user_profile(spark, sf_dir):
    return profile.user_profile(_events(spark, sf_dir, ["userId", "behavior", "itemId", "priceCNY"]))


def sales_ranking(spark, sf_dir):
    rows = _events(spark, sf_dir, ["countryCode", "behavior", "itemId", "priceCNY"], only="buy")
    return ranking.sales_ranking(rows)


def _documents(spark, sf_dir):
    return tables.load(spark, sf_dir, "documents")


BATCH: dict[str, Query] = {
    # rows
    "parse_behavior": parse_behavior,
    "event_time_fallback": lambda s, d: parse.event_time_fallback(_raw(s, d)),
    "reject_report": lambda s, d: parse.reject_report(_raw(s, d)),
    "reject_outcomes": lambda s, d: parse.reject_report(tables.behavior_records(s, d, damaged=True)),
    # revenue
    "gmv_tumbling": lambda s, d: windows.gmv_tumbling(_buys(s, d)),
    "gmv_tumbling_1h": lambda s, d: windows.gmv_tumbling(_buys(s, d), "1 hour"),
    "gmv_report": lambda s, d: windows.gmv_report(windows.gmv_tumbling(_buys(s, d))),
    # hot search
    "hot_word_counts": _hot,
    "hot_word_counts_3h": lambda s, d: _hot(s, d, "3 hours", "1 hour"),
    "hot_word_counter": lambda s, d: windows.hot_word_counter(_hot(s, d)),
    "hot_search_topn": _top,
    "hot_search_topn_3h": lambda s, d: _top(s, d, "3 hours", "1 hour"),
    "hot_search_report": lambda s, d: ranking.hot_search_report(_top(s, d, "3 hours", "1 hour")),
    "hot_search_latest": lambda s, d: ranking.hot_search_newest(_hot(s, d)),
    "hot_search_by_rank": lambda s, d: ranking.hot_search_by_rank(_top(s, d, "3 hours", "1 hour")),
    # sinks' rows
    "olap_rows": lambda s, d: parse.olap_rows(_raw(s, d)),
    "dwd_rows": lambda s, d: parse.archive_rows(_raw(s, d)),
    "dwd_rows_sql": dwd_rows_sql,
    "dwd_partition_commits": dwd_partition_commits,
    "raw_events": lambda s, d: parse.raw_documents(_raw(s, d)),
    "behavior_to_kafka": behavior_to_kafka,
    # monitor
    "monitor_intervals": lambda s, d: monitor.monitor_intervals(_raw(s, d)),
    "monitor_intervals_1h": lambda s, d: monitor.monitor_intervals(_raw(s, d), 3600, fill_empty=True),
    "funnel_rates": lambda s, d: monitor.funnel_rates(_events(s, d, ["countryCode", "behavior"])),
    "lateness_profile": lateness_profile,
    "lateness_profile_global": lateness_profile_global,
    "backlog_alarm": lambda s, d: monitor.backlog_alarm(monitor.monitor_intervals(_raw(s, d)), 4000, 0.9),
    # lookups
    "currency_to_cny": currency_to_cny,
    "gmv_by_day_country": gmv_by_day_country,
    "profile_enrich": profile_enrich,
    # sessions
    "sessionize": sessionize,
    "sessionize_12h": lambda s, d: sessionize(s, d, WIDE_GAP_MS),
    "session_windows": session_windows,
    "session_windows_12h": lambda s, d: session_windows(s, d, "12 hours"),
    "session_funnel": session_funnel,
    # summaries
    "gmv_cube": gmv_cube,
    "online_users": lambda s, d: windows.online_users(_events(s, d, ["userId"])),
    "online_users_sketch": lambda s, d: windows.sketched_users(windows.user_sketches(_events(s, d, ["userId"]))),
    "daily_users_sketch": lambda s, d: windows.sketched_users(
        windows.user_sketches(_events(s, d, ["userId"])), "1 day", "1 day"
    ),
    "hot_products_topn": lambda s, d: ranking.hot_products_topn(_events(s, d, ["behavior", "itemId"])),
    "sales_ranking": sales_ranking,
    "user_profile": user_profile,
    "item_cooccurrence": lambda s, d: profile.item_cooccurrence(
        _events(s, d, ["userId", "eventId", "behavior", "itemId"])
    ),
    "item_pairs": lambda s, d: profile.item_pairs(_events(s, d, ["userId", "eventId", "behavior", "itemId"])),
    "item_pairs_12h": lambda s, d: profile.item_pairs(
        _events(s, d, ["userId", "eventId", "behavior", "itemId"]), 5, span_ms=WIDE_GAP_MS
    ),
    "inverted_index": lambda s, d: search.inverted_index(_documents(s, d)),
    "search_documents": lambda s, d: search.search_documents(_documents(s, d), SEARCH_TERMS),
    "search_stored_index": search_stored_index,
}


def all_queries() -> dict[str, Query]:
    return {**BATCH, **streams.registered()}
