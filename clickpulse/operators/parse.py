"""From raw JSON lines to typed rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.functions.json_fields import (
    coerce,
    extract_object,
    has_key,
    may_contain,
    to_int,
    to_long,
    unreadable,
)
from clickpulse.functions.times import event_time, utc_day
from clickpulse.schema import DEFAULT_AGE, DEFAULT_LEVEL, EVENT_FIELDS

KNOWN_BEHAVIORS = ("search", "click", "buy")


def parse_behavior(
    raw: DataFrame,
    fields: Iterable[str] | None = None,
    *,
    keep: Iterable[str] = ("timestamp",),
    on_error: str = "drop",
    only: str | None = None,
) -> DataFrame:
    """Typed event rows plus ``event_ts`` (event time, arrival time where ``ts`` is unreadable).

    ``fields`` limits the JSON members that are read. ``on_error`` says what a line
    that is no JSON object does: ``drop`` leaves it out, ``fail`` ends the job,
    ``keep`` keeps it with null fields and ``is_object`` false. ``only`` keeps one
    behaviour and skips most other lines before the parse.
    """
    if on_error not in ("drop", "fail", "keep"):
        raise ValueError(f"on_error: {on_error!r}")
    wanted = list(fields or EVENT_FIELDS)
    read = list(dict.fromkeys([*wanted, "ts", *(["behavior"] if only else [])]))
    if only and on_error == "drop":
        raw = raw.filter(may_contain("value", only))
    kept = [*keep, "timestamp", *(["value"] if on_error == "fail" else [])]
    rows = extract_object(raw, read, kept, drop_broken=on_error == "drop")
    if on_error == "fail":
        message = F.concat(F.lit("not a JSON object: "), F.coalesce("value", F.lit("null")))
        rows = rows.filter(F.when(F.col("is_object"), F.lit(True)).otherwise(F.raise_error(message).cast("boolean")))
    if only:
        rows = rows.filter(F.col("behavior") == only)
    return rows.select(
        *keep,
        *[coerce(F.col(n), EVENT_FIELDS.get(n, "string")).alias(n) for n in wanted],
        event_time(to_long(F.col("ts")), F.col("timestamp")).alias("event_ts"),
        *(["is_object"] if on_error == "keep" else []),
    )


def event_time_fallback(raw: DataFrame) -> DataFrame:
    """Event time of every record, broken lines included."""
    rows = parse_behavior(raw, ["ts"], keep=("key", "timestamp"), on_error="keep")
    return rows.select(
        F.col("key").alias("user_id"),
        F.unix_millis("timestamp").alias("arrival_ms"),
        F.unix_millis("event_ts").alias("event_ms"),
        F.col("ts").isNull().alias("used_arrival"),
    )


def olap_rows(raw: DataFrame, *, keep: Iterable[str] = (), event_id: bool = False) -> DataFrame:
    """Seven-column OLAP row. Absent keys take defaults; a present value that cannot be
    read drops the row, and so does an explicit null age or an age outside 0 to 255. With ``event_id``
    the id comes before them, or a digest of the line where there is none."""
    names = ["userId", "behavior", "itemId", "ts", "age", "level", "sessionId", *(["eventId"] if event_id else [])]
    rows = extract_object(raw, names, [*keep, "value"], drop_broken=True)
    value = F.col("value")
    ts = F.coalesce(to_long(F.col("ts")), F.when(~unreadable(F.col("ts"), "bigint"), F.lit(0).cast("bigint")))
    age = F.when(F.col("age").isNotNull(), to_int(F.col("age"))).when(~has_key(value, "age"), F.lit(DEFAULT_AGE))
    level = F.when(F.col("level").isNotNull(), F.col("level")).when(~has_key(value, "level"), F.lit(DEFAULT_LEVEL))
    # A digest of the line instead of a random id, so a replayed task writes the same row.
    session = F.when(F.col("sessionId").isNotNull(), F.col("sessionId")).when(
        ~has_key(value, "sessionId"), F.sha2(value, 256)
    )
    typed = rows.select(
        *keep,
        *([F.coalesce("eventId", F.sha2(value, 256)).alias("event_id")] if event_id else []),
        F.col("userId").alias("user_id"),
        F.col("behavior").alias("event_type"),
        F.col("itemId").alias("item_id"),
        ts.alias("ts"),
        F.when(age.between(0, 255), age.cast("smallint")).alias("age"),
        level.alias("level"),
        session.alias("session_id"),
    )
    return typed.filter(F.col("ts").isNotNull() & F.col("age").isNotNull())


def archive_rows(raw: DataFrame, *, keep: Iterable[str] = ()) -> DataFrame:
    """Archive row with its day. An unreadable ``ts`` is null and so is its ``dt``."""
    names = ["userId", "behavior", "itemId", "ts", "countryCode", "siteId", "price", "currency"]
    rows = extract_object(raw, names, keep, drop_broken=True)
    ts = to_long(F.col("ts"))
    return rows.select(
        *keep,
        F.col("userId").alias("user_id"),
        "behavior",
        F.col("itemId").alias("item_id"),
        ts.alias("ts"),
        F.col("countryCode").alias("country_code"),
        F.col("siteId").alias("site_id"),
        F.col("price").try_cast("double").alias("price"),
        "currency",
        utc_day(ts).alias("dt"),
    )


def raw_documents(raw: DataFrame, *, keep: Iterable[str] = ()) -> DataFrame:
    """Every line with a document id, as a text index takes it. The id is the event id, or
    a digest of the line where there is none, so that a replay overwrites itself."""
    rows = extract_object(raw, ["eventId"], [*keep, "value"])
    return rows.select(*keep, F.coalesce("eventId", F.sha2("value", 256)).alias("event_id"), "value")


def reject_reason(raw: DataFrame) -> DataFrame:
    """The raw columns plus ``reason``: null for a clean row, else the first rule it breaks."""
    names = ["userId", "behavior", "ts", "priceCNY"]
    rows = extract_object(raw, names, raw.columns)
    buy = F.col("behavior") == "buy"
    reason = (
        F.when(~F.col("is_object"), "malformed")
        .when(F.coalesce("userId", F.lit("")) == "", "missing_user")
        .when(to_long(F.col("ts")).isNull(), "bad_ts")
        .when(~F.coalesce(F.col("behavior").isin(*KNOWN_BEHAVIORS), F.lit(False)), "unknown_behavior")
        .when(buy & coerce(F.col("priceCNY"), EVENT_FIELDS["priceCNY"]).isNull(), "bad_price")
    )
    return rows.select(*raw.columns, reason.alias("reason"))


def split_rejects(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean records, and rejected records with their reason."""
    tagged = reject_reason(raw)
    return tagged.filter("reason IS NULL").drop("reason"), tagged.filter("reason IS NOT NULL")


def reject_report(raw: DataFrame) -> DataFrame:
    """Rows per outcome, clean ones as ``ok``."""
    return reject_reason(raw).groupBy(F.coalesce("reason", F.lit("ok")).alias("reason")).agg(
        F.count(F.lit(1)).alias("n")
    )


def encode_behavior(events: DataFrame, key: str = "userId") -> DataFrame:
    """``key`` and ``value`` for a topic: each row as one JSON object without its null fields."""
    names = [n for n in EVENT_FIELDS if n in events.columns]
    money = {n for n in names if EVENT_FIELDS[n].startswith("decimal")}
    body = F.struct(*[(F.col(n).cast("double") if n in money else F.col(n)).alias(n) for n in names])
    return events.select(F.col(key).alias("key"), F.to_json(body).alias("value"))
