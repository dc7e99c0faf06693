"""Queries that run the streaming jobs over the tables to their end, and read back what they wrote."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickpulse.operators import parse, ranking
from clickpulse.plans import tables
from clickpulse.schema import TS_MAX_MS
from clickpulse.session import checkpoint_root
from clickpulse.sources import catalog
from clickpulse.streaming import jobs, sinks

#: Micro-batches that a stream reads a table in, by arrival: so many, and more where one would hold over so many events.
MICRO_BATCHES, BATCH_EVENTS = 3, 4_000_000
_cut: dict[tuple[str, str], tuple[str, int]] = {}


def _in_order(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """A folder with the events in files by arrival, whose modification times rise, and the files of a micro-batch:
    one for each core, so that none of them is one task's work. Made once in a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _cut:
        folder = f"{checkpoint_root(spark)}/arrivals-{uuid.uuid4().hex}"
        late = F.when(F.col("event_id") % 10 == 0, F.col("event_id") % 5000).otherwise(0)
        arrival = F.unix_millis(F.col("ts").cast("timestamp")) + late
        events = tables.load(spark, sf_dir, "events")
        batches = max(MICRO_BATCHES, -(-events.count() // BATCH_EVENTS))
        events.repartitionByRange(batches * spark.sparkContext.defaultParallelism, arrival).write.parquet(folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        names = sorted(f.getPath().getName() for f in system.listStatus(path))
        files = [n for n in names if n.startswith("part-")]
        for number, name in enumerate(files):
            system.setTimes(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, name), 1_000_000_000_000 + 1000 * number, -1)
        _cut[key] = folder, max(1, len(files) // batches)
    return _cut[key]


def stream_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records in order of arrival, in several micro-batches."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    schema = tables.load(spark, sf_dir, "events").schema
    folder, files = _in_order(spark, sf_dir)
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).option("pathGlobFilter", "part-*")
    return tables.records_from(reader.parquet(folder), tables.load(spark, sf_dir, "customer"))


def _drain(make: Callable[[DataFrame], DataFrame], wrap=None, shape: Callable[[DataFrame], DataFrame] | None = None):
    """A query that runs the stream over everything there is and reads back its output."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = make(stream_records(spark, sf_dir))
        like = shape(rows) if shape else rows
        base = f"{checkpoint_root(spark)}/stream-{uuid.uuid4().hex}"
        write = sinks.file_writer(f"{base}/out")
        running = jobs.start(rows, wrap(write, base) if wrap else write, f"{base}/checkpoint", jobs.ALL)
        running.awaitTermination()
        return sinks.read_files(spark, f"{base}/out", like)

    return query


def _typed(raw: DataFrame) -> DataFrame:
    rows = parse.parse_behavior(raw)
    money = {n: F.col(n).cast("double") for n in ("price", "priceCNY")}
    return rows.withColumns(money).withColumn("event_ms", F.unix_millis("event_ts")).drop("event_ts", "timestamp")


def _amounts(raw: DataFrame) -> DataFrame:
    return jobs.priced(raw).select(
        "eventId", "countryCode", "site_id", "currency",
        F.col("price").cast("double").alias("price"), F.col("price_cny").cast("double").alias("price_cny"),
    )


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "stream_gmv_tumbling": _drain(jobs.gmv),
        "stream_hot_search_topn": _drain(jobs.hot_words, lambda write, _: jobs.ranked(write), lambda rows: _ranked_shape(rows)),
        "stream_hot_search_chained": _drain(lambda raw: jobs.hot_top(raw, size="3 hours", slide="1 hour")),
        "stream_olap_rows": _drain(parse.olap_rows),
        "stream_dwd_rows": _drain(parse.archive_rows),
        "stream_monitor_intervals": _drain(lambda raw: jobs.monitored(raw, 3600)),
        "stream_parse_behavior": _drain(_typed),
        "stream_event_time_fallback": _drain(parse.event_time_fallback),
        "stream_hot_word_counts": _drain(jobs.hot_words),
        "stream_raw_events": _drain(parse.raw_documents),
        "stream_currency_to_cny": _drain(_amounts),
        "stream_session_windows": _drain(lambda raw: jobs.user_sessions(raw, "12 hours")),
        "stream_online_users": _drain(jobs.online),
        "stream_sessionize": _drain(jobs.numbered_sessions),
        "stream_olap_rows_once": _drain(lambda raw: jobs.olap_once(raw.unionByName(raw), jobs.REPLAYED)),
        "stream_monitor_filled": _drain(lambda raw: jobs.monitored(raw, 3600), _filled),
        "kept_cube": _kept_cube_query,
        "olap_table": olap_table,
        "dwd_table": dwd_table,
    }


def _filled(write: sinks.BatchWriter, base: str) -> sinks.BatchWriter:
    return sinks.filling_writer(write, f"{base}/last", 3_600_000)


def _kept_cube_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cube job over all records, then the cube it has kept."""
    base = f"{checkpoint_root(spark)}/cube-{uuid.uuid4().hex}"
    jobs.cube_job(stream_records(spark, sf_dir), f"{base}/parts", f"{base}/checkpoint", jobs.ALL).awaitTermination()
    return jobs.kept_cube(spark, f"{base}/parts")


def olap_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The OLAP job over all records, read back through the catalog's table."""
    base = f"{checkpoint_root(spark)}/olap-{uuid.uuid4().hex}"
    jobs.olap_job(stream_records(spark, sf_dir), sinks.olap_writer(f"{base}/out"), f"{base}/checkpoint", jobs.ALL).awaitTermination()
    table = f"olap_{uuid.uuid4().hex}"
    catalog.create_olap_table(spark, table, f"{base}/out")
    return spark.table(table)


def dwd_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive job over all records, every day published, read back through the catalog's table."""
    base = f"{checkpoint_root(spark)}/dwd-{uuid.uuid4().hex}"
    path, arrivals = f"{base}/out", f"{base}/arrivals"
    jobs.archive_job(stream_records(spark, sf_dir), path, arrivals, f"{base}/checkpoint", jobs.ALL).awaitTermination()
    table = f"dwd_{uuid.uuid4().hex}"
    catalog.create_archive_table(spark, table, path)
    sinks.commit_days(spark, path, arrivals, TS_MAX_MS, table=table)
    return spark.table(table)


def _ranked_shape(counts: DataFrame) -> DataFrame:
    """An empty frame with the columns that ranking the counts gives."""
    spark = counts.sparkSession
    return ranking.hot_search_topn(spark.createDataFrame([], counts.schema))
