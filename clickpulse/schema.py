"""Column contracts and fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Amounts are decimals inside the library, so a sum does not depend on row order.
MONEY = "decimal(30,10)"

# Fields of one behaviour event, in JSON, and the type each is read as.
EVENT_FIELDS = {
    "userId": "string",
    "eventId": "string",
    "sessionId": "string",
    "countryCode": "string",
    "siteId": "string",
    "behavior": "string",
    "itemId": "string",
    "searchTerm": "string",
    "age": "int",
    "level": "string",
    "price": MONEY,
    "currency": "string",
    "priceCNY": MONEY,
    "ts": "bigint",
}

RAW_SCHEMA = "key string, value string, timestamp timestamp"

OLAP_SCHEMA = (
    "user_id string, event_type string, item_id string, ts bigint, "
    "age smallint, level string, session_id string"
)

ARCHIVE_SCHEMA = (
    "user_id string, behavior string, item_id string, ts bigint, country_code string, "
    "site_id string, price double, currency string, dt string"
)

# Defaults of the OLAP row when a key is absent.
DEFAULT_AGE = 18
DEFAULT_LEVEL = "Bronze"

# Window sizes, session gap and lateness bound.
GMV_WINDOW = "5 seconds"
HOT_WINDOW = "30 seconds"
HOT_SLIDE = "10 seconds"
MONITOR_INTERVAL_S = 2
LATENESS_BOUND_MS = 5000
SESSION_GAP_MS = 300_000
COMMIT_DELAY_MS = 60_000
HOT_TOP_N = 3

# Country, currency and rate to CNY.
RATES = (
    (0, "US", "USD", "7.2"),
    (1, "DE", "EUR", "7.8"),
    (2, "UK", "GBP", "9.2"),
    (3, "JP", "JPY", "0.048"),
    (4, "AU", "AUD", "4.7"),
    (5, "CA", "CAD", "5.3"),
    (6, "CN", "CNY", "1.0"),
    (7, "KR", "KRW", "0.0054"),
)

# Fixed value: prefix of the site id.
SITE_PREFIX = "TEMU_"

# Event times outside years 1 to 9999 are treated as unreadable.
TS_MIN_MS = -62_135_596_800_000
TS_MAX_MS = 253_402_300_799_999


def rate_table(spark: SparkSession) -> DataFrame:
    """The eight-row rate table as a literal relation."""
    rows = ", ".join(f"({i}, '{c}', '{cur}', {r}BD)" for i, c, cur, r in RATES)
    return spark.sql(
        "SELECT idx, country_code, currency, CAST(rate AS decimal(10,4)) AS rate "
        f"FROM VALUES {rows} AS t(idx, country_code, currency, rate)"
    )
