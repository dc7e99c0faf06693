"""Partition commits of the day-partitioned archive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.schema import COMMIT_DELAY_MS


def partition_commits(archive: DataFrame, as_of_ms: int, delay_ms: int = COMMIT_DELAY_MS) -> DataFrame:
    """When each day may be committed, and whether that is so at ``as_of_ms``. A day is ready
    ``delay_ms`` after its first row arrived. ``archive`` carries the arrival ``timestamp``."""
    return (
        archive.groupBy("dt")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.unix_millis("timestamp")).alias("first_arrival"))
        .withColumn("commit_ts", F.col("first_arrival") + F.lit(delay_ms))
        .withColumn("committed", F.col("commit_ts") <= F.lit(as_of_ms))
    )
