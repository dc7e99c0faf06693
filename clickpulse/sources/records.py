"""Sources of raw records: ``key string, value string, timestamp timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.schema import RAW_SCHEMA

# Fixed value: the topic every job reads.
TOPIC = "global_behavior_log"


def as_records(topic_rows: DataFrame) -> DataFrame:
    """The three record columns out of rows as the topic source gives them."""
    return topic_rows.select(
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        F.col("timestamp"),
    )


def topic_options(servers: str, topic: str = TOPIC, starting: str = "latest", **more: str) -> dict[str, str]:
    """Source options. ``starting`` is ``latest`` for revenue, rows, archive and monitor, and
    ``earliest`` for hot search."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting, **more}


def topic_stream(spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "latest", **more: str) -> DataFrame:
    """Records from the topic as a stream. Needs the topic connector on the classpath."""
    reader = spark.readStream.format("kafka").options(**topic_options(servers, topic, starting, **more))
    return as_records(reader.load())


def topic_batch(spark: SparkSession, servers: str, topic: str = TOPIC, **more: str) -> DataFrame:
    """All records now in the topic, as a batch."""
    reader = spark.read.format("kafka").options(**topic_options(servers, topic, "earliest", **more))
    return as_records(reader.load())


def file_stream(
    spark: SparkSession, path: str, *, fmt: str = "json", schema: str = RAW_SCHEMA, files_per_trigger: int | None = None
) -> DataFrame:
    """Records from a folder of files as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def file_batch(spark: SparkSession, path: str, *, fmt: str = "json", schema: str = RAW_SCHEMA) -> DataFrame:
    return spark.read.format(fmt).schema(schema).load(path)
