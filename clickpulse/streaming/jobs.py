"""The streaming jobs: raw records in, a started query out.

Each takes the functions of ``clickpulse.operators`` unchanged and adds the watermark, the
checkpoint and the trigger. Windows are emitted once, when the watermark has passed them.
The watermark advances on all records of the source, before any filter.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clickpulse.operators import enrich, monitor, parse, profile, ranking, sessions, windows
from clickpulse.schema import GMV_WINDOW, HOT_SLIDE, HOT_TOP_N, HOT_WINDOW, MONITOR_INTERVAL_S, SESSION_GAP_MS
from clickpulse.session import DEFAULT_STORE, SETTINGS, STATE_STORE
from clickpulse.streaming import kept, keyed, sinks

LATENESS = "5 seconds"
#: How long after its first arrival a record that comes again is known.
REPLAYED = "1 hour"
ALL = {"availableNow": True}

# How often each job commits its progress.
HOT_TRIGGER = {"processingTime": "5 seconds"}
SINK_TRIGGER = {"processingTime": "10 seconds"}
JDBC_TRIGGER = {"processingTime": "2 seconds"}
MONITOR_TRIGGER = {"processingTime": "2 seconds"}


def start(
    rows: DataFrame, write: sinks.BatchWriter, checkpoint: str, trigger: dict | None = None, name: str | None = None
) -> StreamingQuery:
    """Starts an append-mode query that hands each micro-batch to ``write``.

    In a session that keeps Spark's default state store the query takes the one of
    :data:`clickpulse.session.SETTINGS`: the default holds all state in memory and no state of several parts, as
    :mod:`clickpulse.streaming.keyed` has it. A query that goes on from a checkpoint keeps the store that wrote it.
    """
    writer = rows.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    if name:
        writer = writer.queryName(name)
    conf = rows.sparkSession.conf
    replaced = conf.get(STATE_STORE) == DEFAULT_STORE
    if replaced:
        conf.set(STATE_STORE, SETTINGS[STATE_STORE])
    try:  # a started query has a copy of the settings
        return writer.trigger(**(trigger or {"processingTime": "0 seconds"})).start()
    finally:
        if replaced:
            conf.set(STATE_STORE, DEFAULT_STORE)


def _all_records(raw: DataFrame, fields: list[str]) -> DataFrame:
    """Typed rows of every record behind a watermark that all of them advance, whatever their behaviour.

    A line that cannot be read counts by its arrival time. Every line is parsed for that, which a
    filter on the text would save: the price of windows that close on time when, say, nobody buys.
    """
    events = parse.parse_behavior(raw, fields, on_error="keep")
    return events.withWatermark("event_ts", LATENESS)


def gmv(raw: DataFrame, size: str = GMV_WINDOW) -> DataFrame:
    return windows.gmv_tumbling(_all_records(raw, ["behavior", "priceCNY"]), size)


def hot_words(raw: DataFrame, size: str = HOT_WINDOW, slide: str = HOT_SLIDE) -> DataFrame:
    return windows.hot_word_counts(_all_records(raw, ["behavior", "searchTerm"]), size, slide)


def hot_top(raw: DataFrame, n: int = HOT_TOP_N, size: str = HOT_WINDOW, slide: str = HOT_SLIDE) -> DataFrame:
    """Ranked terms of each closed window, in one query that any sink takes."""
    return keyed.topn_stream(hot_words(raw, size, slide), n)


def monitored(raw: DataFrame, seconds: int = MONITOR_INTERVAL_S) -> DataFrame:
    return monitor.monitor_intervals(raw.withWatermark("timestamp", LATENESS), seconds)


def online(raw: DataFrame, size: str = "5 minutes", slide: str = "1 minute") -> DataFrame:
    return windows.online_users(_all_records(raw, ["userId"]), size, slide)


def numbered_sessions(raw: DataFrame, gap_ms: int = SESSION_GAP_MS) -> DataFrame:
    """Each row with its user's session number, a purchase ending its session."""
    rows = _all_records(raw, ["userId", "eventId", "behavior"]).filter("is_object")
    return keyed.sessionize_stream(rows, gap_ms)


def user_sessions(raw: DataFrame, gap: str = "5 minutes") -> DataFrame:
    return sessions.session_windows(_all_records(raw, ["userId"]), gap)


def priced(raw: DataFrame) -> DataFrame:
    """Purchases with their amount in CNY, row by row."""
    fields = ["eventId", "countryCode", "behavior", "price", "currency"]
    return enrich.with_site(enrich.with_cny(parse.parse_behavior(raw, fields, only="buy")), out="site_id")


def ranked(
    write: sinks.BatchWriter, n: int = HOT_TOP_N, rank: Callable[[DataFrame, int], DataFrame] = ranking.hot_search_topn
) -> sinks.BatchWriter:
    """Ranks a batch of window counts before writing. All counts of a window come in one
    micro-batch, so the ranks are complete."""

    def rank_and_write(batch: DataFrame, batch_id: int) -> None:
        write(rank(batch, n), batch_id)

    return rank_and_write


def reported(
    every: Sequence[sinks.BatchWriter], newest: Sequence[sinks.BatchWriter] = (), n: int = HOT_TOP_N
) -> sinks.BatchWriter:
    """Makes the report of each window of a batch. Writers in ``every`` get them all, those in
    ``newest`` the latest one, under its hash field."""

    def report_and_write(batch: DataFrame, batch_id: int) -> None:
        reports = ranking.hot_search_report(ranking.hot_search_topn(batch, n)).persist()
        try:
            for write in every:
                write(reports, batch_id)
            latest = ranking.hot_search_latest(reports)
            for write in newest:
                write(latest, batch_id)
        finally:
            reports.unpersist()

    return report_and_write


def by_rank(writers: Sequence[sinks.BatchWriter], n: int = HOT_TOP_N) -> sinks.BatchWriter:
    """Hands the newest line of each rank, under the field before its colon, to several writers."""

    def rank_and_write(batch: DataFrame, batch_id: int) -> None:
        lines = ranking.hot_search_by_rank(ranking.hot_search_topn(batch, n)).persist()
        try:
            for write in writers:
                write(lines, batch_id)
        finally:
            lines.unpersist()

    return rank_and_write


def gmv_job(
    raw: DataFrame, write: sinks.BatchWriter, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """A line per closed window; with :func:`clickpulse.streaming.sinks.printer` it prints them."""
    return start(windows.gmv_report(gmv(raw)), write, checkpoint, trigger)


def monitor_job(
    raw: DataFrame, write: sinks.BatchWriter, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """The dashboard's numbers, every interval once."""
    return start(monitored(raw), write, checkpoint, trigger or MONITOR_TRIGGER)


def delivered_once(rows: DataFrame) -> DataFrame:
    """Rows with an ``event_id`` and, under a watermark, their arrival ``timestamp``: of those with the same id
    that arrive within the watermark's bound, the first. An id is forgotten once the bound has passed it."""
    return rows.dropDuplicatesWithinWatermark(["event_id"])


def olap_once(raw: DataFrame, within: str) -> DataFrame:
    """OLAP rows of events that come again ``within`` a time, as after a replay of the topic, once."""
    rows = parse.olap_rows(raw.withWatermark("timestamp", within), keep=["timestamp"], event_id=True)
    return delivered_once(rows).drop("event_id", "timestamp")


def documents_once(raw: DataFrame, within: str) -> DataFrame:
    """Raw documents, each id once ``within`` a time."""
    rows = parse.raw_documents(raw.withWatermark("timestamp", within), keep=["timestamp"])
    return delivered_once(rows).drop("timestamp")


def olap_job(
    raw: DataFrame, write: sinks.BatchWriter, checkpoint: str, trigger: dict | None = None, within: str | None = None
) -> StreamingQuery:
    """``within`` leaves out events that have come before in that time: the target table has no key to do so."""
    return start(olap_once(raw, within) if within else parse.olap_rows(raw), write, checkpoint, trigger or JDBC_TRIGGER)


def cube_parts_kept(spark: SparkSession, path: str) -> kept.Kept:
    """The parts of the cube, kept up to date under ``path``."""
    return kept.Kept(spark, path, profile.CUBE_PARTS, profile.merged_parts)


def cube_job(raw: DataFrame, path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keeps the cube's parts under ``path``; :func:`kept_cube` reads the cube at any time."""
    events = parse.parse_behavior(raw, ["userId", "countryCode", "level", "behavior", "priceCNY"])
    write = cube_parts_kept(raw.sparkSession, path).writer(profile.cube_parts)
    return start(events, write, checkpoint, trigger or SINK_TRIGGER)


def kept_cube(spark: SparkSession, path: str) -> DataFrame:
    """The cube over all batches so far: that of :func:`clickpulse.operators.profile.gmv_cube`."""
    return profile.cube_of(cube_parts_kept(spark, path).read())


def archive_job(
    raw: DataFrame, path: str, arrivals: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    rows = parse.archive_rows(raw, keep=["timestamp"])
    return start(rows, sinks.archive_writer(path, arrivals), checkpoint, trigger or SINK_TRIGGER)


def index_job(
    raw: DataFrame, write: sinks.BatchWriter, checkpoint: str, trigger: dict | None = None, within: str | None = None
) -> StreamingQuery:
    """``within`` leaves out documents that have come before in that time; an index would overwrite them."""
    rows = documents_once(raw, within) if within else parse.raw_documents(raw)
    return start(rows, write, checkpoint, trigger or HOT_TRIGGER)


def hot_search_job(
    raw: DataFrame,
    checkpoint: str,
    *,
    every: Sequence[sinks.BatchWriter] = (),
    newest: Sequence[sinks.BatchWriter] = (),
    ranks: Sequence[sinks.BatchWriter] = (),
    n: int = HOT_TOP_N,
    trigger: dict | None = None,
) -> StreamingQuery:
    """The ranking job: each report to ``every``, the newest to ``newest``, each rank's newest line to
    ``ranks``. A listener sees ``total_search_count`` of each batch under the metric ``hot_search``."""
    report, line = reported(every, newest, n), by_rank(ranks, n)

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = batch.persist()
        try:
            report(counts, batch_id)
            if ranks:
                line(counts, batch_id)
        finally:
            counts.unpersist()

    return start(windows.with_search_metric(hot_words(raw)), write, checkpoint, trigger or HOT_TRIGGER)
