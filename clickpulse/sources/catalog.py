"""Databases, tables and views for work in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators.parse import parse_behavior
from clickpulse.schema import ARCHIVE_SCHEMA, OLAP_SCHEMA, TS_MAX_MS, TS_MIN_MS

ARCHIVE_COLUMNS = ["userId", "behavior", "itemId", "ts", "countryCode", "siteId", "price", "currency"]


def create_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def create_archive_table(spark: SparkSession, table: str, path: str) -> None:
    """Day-partitioned Parquet table over what the archive writer puts under ``path``.

    Days show in it once :func:`clickpulse.streaming.sinks.commit_days` has published them.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({ARCHIVE_SCHEMA}) USING parquet PARTITIONED BY (dt) LOCATION '{path}'"
    )


def create_olap_table(spark: SparkSession, table: str, path: str) -> None:
    """Parquet table over all that the OLAP writer puts under ``path``, sorted by ``ts`` in each file.

    It has no partitions to publish: the folders of all batches are read.
    """
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({OLAP_SCHEMA}) "
        f"USING parquet OPTIONS (recursiveFileLookup 'true') LOCATION '{path}'"
    )


def register_source_view(raw: DataFrame, name: str) -> None:
    """A view over raw records with the archive's source columns and ``proctime``. Lines that
    are no object are left out; a field that cannot be read is null."""
    rows = parse_behavior(raw, ARCHIVE_COLUMNS)
    rows.select(
        *[c for c in ARCHIVE_COLUMNS if c != "price"],
        F.col("price").cast("double").alias("price"),
        F.current_timestamp().alias("proctime"),
    ).createOrReplaceTempView(name)


def archive_query(view: str) -> str:
    """The archive projection in SQL over :func:`register_source_view`, its day in UTC as in ``archive_rows``."""
    return f"""
        SELECT userId AS user_id, behavior, itemId AS item_id, ts, countryCode AS country_code,
               siteId AS site_id, price, currency,
               CASE WHEN ts BETWEEN {TS_MIN_MS} AND {TS_MAX_MS}
                    THEN CAST(date_add(DATE '1970-01-01', CAST(floor(ts / 86400000) AS int)) AS string) END AS dt
        FROM {view}
    """
