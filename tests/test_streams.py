"""Streams against their batch twins, replays, and the writers."""

from __future__ import annotations

import json
import os

import pytest
from conftest import SMALL, instant
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from clickpulse.operators import parse, ranking, sessions, windows
from clickpulse.plans import tables
from clickpulse.schema import RAW_SCHEMA
from clickpulse.session import checkpoint_root
from clickpulse.sources import catalog, endpoints, records as record_sources
from clickpulse.streaming import jobs, keyed, sinks

NOW = {"availableNow": True}
FAR = 4_000_000_000_000


def write_files(folder, groups):
    """One JSON file of records per group, with rising modification times."""
    os.makedirs(folder, exist_ok=True)
    for i, rows in enumerate(groups):
        path = os.path.join(folder, f"part-{i:03d}.json")
        with open(path, "w", encoding="utf-8") as out:
            for key, value, ms in rows:
                stamp = instant(ms).strftime("%Y-%m-%dT%H:%M:%S.%f")[:-3] + "Z"
                out.write(json.dumps({"key": key, "value": value, "timestamp": stamp}) + "\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    return str(folder)


def sentinel(behavior):
    value = json.dumps({"behavior": behavior, "userId": "Z", "searchTerm": "z", "priceCNY": 0, "ts": FAR})
    return [("Z", value, FAR)]


@pytest.fixture(scope="module")
def history(spark):
    """All records of the small tables in order of arrival."""
    rows = tables.behavior_records(spark, SMALL).orderBy("timestamp").collect()
    return [(r["key"], r["value"], int(r["timestamp"].timestamp() * 1000 + 0.5)) for r in rows]


def chunks(rows, n=4):
    size = len(rows) // n + 1
    return [rows[i : i + size] for i in range(0, len(rows), size)]


def batch(spark, rows):
    return spark.createDataFrame([(k, v, instant(ms)) for k, v, ms in rows], RAW_SCHEMA)


def drain(spark, folder, rows_of, tmp_path, write_of=None, name="out"):
    raw = record_sources.file_stream(spark, folder, files_per_trigger=1)
    rows = rows_of(raw)
    write = sinks.file_writer(f"{tmp_path}/{name}")
    query = jobs.start(rows, write_of(write) if write_of else write, f"{tmp_path}/{name}-ck", NOW)
    query.awaitTermination()
    return f"{tmp_path}/{name}", rows


def same(a, b):
    columns = sorted(b.columns)
    left, right = (sorted(map(tuple, df.select(columns).collect()), key=repr) for df in (a, b))
    return left == right


@pytest.mark.parametrize("behavior, make, end", [
    ("buy", lambda raw: jobs.gmv(raw, "1 hour"), "window_end"),
    ("search", lambda raw: jobs.hot_words(raw, "3 hours", "1 hour"), "window_end"),
    ("click", lambda raw: jobs.monitored(raw, 3600), "window_start"),
    ("click", lambda raw: jobs.user_sessions(raw, "12 hours"), "session_end"),
])
def test_windowed_twins(spark, history, tmp_path, behavior, make, end):
    """Real windows are all closed by a row far in the future, whose own windows stay open."""
    folder = write_files(tmp_path / "in", [*chunks(history), sentinel(behavior)])
    path, rows = drain(spark, folder, make, tmp_path)
    assert same(sinks.read_files(spark, path, rows), make(batch(spark, history)).filter(F.col(end) < FAR - 10**9))


@pytest.mark.parametrize("make", [parse.olap_rows, parse.archive_rows, parse.raw_documents, parse.event_time_fallback])
def test_row_twins(spark, history, tmp_path, make):
    folder = write_files(tmp_path / "in", chunks(history))
    path, rows = drain(spark, folder, make, tmp_path)
    assert same(sinks.read_files(spark, path, rows), make(batch(spark, history)))


def test_ranking_in_each_batch(spark, history, tmp_path):
    folder = write_files(tmp_path / "in", [*chunks(history), sentinel("search")])
    make = lambda raw: jobs.hot_words(raw, "3 hours", "1 hour")
    path, _ = drain(spark, folder, make, tmp_path, jobs.ranked)
    want = ranking.hot_search_topn(make(batch(spark, history)))
    assert same(sinks.read_files(spark, path, want), want)


def test_online_users_stream(spark, history, tmp_path):
    folder = write_files(tmp_path / "in", [*chunks(history), sentinel("click")])
    path, rows = drain(spark, folder, jobs.online, tmp_path)
    exact = windows.online_users(parse.parse_behavior(batch(spark, history), ["userId"]))
    got = {r["window_end"]: r["users"] for r in sinks.read_files(spark, path, rows).collect()}
    assert got == {r["window_end"]: r["users"] for r in exact.collect()}


class MetricListener(StreamingQueryListener):
    """Adds up the job's metric over all micro-batches."""

    def __init__(self):
        self.total = 0

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        if "hot_search" in event.progress.observedMetrics:
            self.total += event.progress.observedMetrics["hot_search"]["total_search_count"]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass


def event(behavior, ts, arrival=None, **more):
    value = json.dumps({"behavior": behavior, "userId": "U", "ts": ts, **more})
    return ("U", value, ts if arrival is None else arrival)


@pytest.mark.parametrize("behavior, make", [("buy", jobs.gmv), ("search", jobs.hot_words)])
@pytest.mark.parametrize("later", [
    lambda ts: event("click", ts),
    lambda ts: event("error", ts),
    lambda ts: ("U", "broken {", ts),
    lambda ts: event("click", "unreadable", ts),
])
def test_every_record_advances_the_watermark(spark, tmp_path, behavior, make, later):
    """A purchase or a search is followed by other records only; its windows close all the same."""
    first = event(behavior, 1000, priceCNY=5, searchTerm="a")
    folder = write_files(tmp_path / "in", [[first], [later(3_600_000)], [later(7_200_000)]])
    path, rows = drain(spark, folder, make, tmp_path)
    ends = sorted(r["window_end"] for r in sinks.read_files(spark, path, rows).collect())
    assert ends == ([5000] if behavior == "buy" else [10_000, 20_000, 30_000])


def test_late_rows_within_the_bound_count_and_later_ones_do_not(spark, tmp_path):
    """Window 0 to 5 s closes once 10 s are reached; Spark's filter follows one micro-batch later."""
    buys = [event("buy", ts, priceCNY=1) for ts in (1000, 9900, 2000, 60_000, 61_000, 3000, 120_000)]
    folder = write_files(tmp_path / "in", [[b] for b in buys])
    path, rows = drain(spark, folder, jobs.gmv, tmp_path)
    got = {r["window_end"]: r["gmv"] for r in sinks.read_files(spark, path, rows).collect()}
    # 2 s came 7.9 s late but before the window closed; 3 s came after two batches beyond 10 s
    assert got == {5000: 2.0, 10_000: 1.0, 65_000: 2.0}


def test_gmv_and_monitor_jobs_write_every_window(spark, tmp_path):
    rows = [event("buy", 1000, priceCNY=2.345), event("click", 2500), event("buy", 8000, priceCNY=1), event("click", 60_000)]
    folder = write_files(tmp_path / "in", [rows[:2], rows[2:]])
    lines = []
    raw = record_sources.file_stream(spark, folder, files_per_trigger=1)
    jobs.gmv_job(raw, sinks.printer("line", out=lines.append), f"{tmp_path}/ck", NOW).awaitTermination()
    assert lines == ["GMV (CNY): 2.35", "GMV (CNY): 1.00"]
    raw = record_sources.file_stream(spark, folder, files_per_trigger=1)
    jobs.monitor_job(raw, sinks.file_writer(f"{tmp_path}/mon"), f"{tmp_path}/ck2", NOW).awaitTermination()
    got = {r["window_start"]: r["cnt"] for r in spark.read.parquet(f"{tmp_path}/mon").collect()}
    assert got == {0: 1, 2000: 1, 8000: 1}


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Session:
        sparkContext = Context

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(Session)


def test_latest_report_goes_to_the_hash(spark, tmp_path):
    rows = [("U", json.dumps({"behavior": "search", "searchTerm": w, "ts": ts}), ts)
            for w, ts in (("a", 1000), ("b", 61_000), ("b", 62_000))]
    folder = write_files(tmp_path / "in", [rows[:1], rows[1:], sentinel("search")])
    store = {}
    files = sinks.file_writer(f"{tmp_path}/out")
    printed, ranks = [], {}
    raw = record_sources.file_stream(spark, folder, files_per_trigger=1)
    seen = MetricListener()
    spark.streams.addListener(seen)
    try:
        jobs.hot_search_job(
            raw,
            f"{tmp_path}/ck",
            every=[sinks.printer("report", out=printed.append)],
            newest=[sinks.upsert_writer(store.__setitem__), files],
            ranks=[sinks.upsert_writer(ranks.__setitem__, "line")],
            trigger=NOW,
        ).awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    finally:
        spark.streams.removeListener(seen)
    # a at 1 s is in the windows that end at 10, 20 and 30 s, both b in those that end at 70, 80 and 90 s
    assert [p.split("\n")[1] for p in printed] == ["Top 1: a (1)"] * 3 + ["Top 1: b (2)"] * 3
    assert ranks == {"Top 1": "Top 1: b (2)"} and seen.total == 6
    want = "Hot search 1970-01-01 00:01:30\nTop 1: b (2)"
    assert store == {"last_hot_search_result": want}
    stored = spark.read.parquet(f"{tmp_path}/out")
    assert [r["report"] for r in sinks.latest_value(stored).collect()] == [want]


def test_restart_reads_only_new_files(spark, history, tmp_path):
    parts = chunks(history)
    folder = write_files(tmp_path / "in", parts[:2])
    drain(spark, folder, parse.raw_documents, tmp_path)
    drain(spark, folder, parse.raw_documents, tmp_path)
    write_files(tmp_path / "in", parts)
    path, rows = drain(spark, folder, parse.raw_documents, tmp_path)
    assert same(sinks.read_files(spark, path, rows), parse.raw_documents(batch(spark, history)))


def test_failed_batch_leaves_no_duplicates(spark, history, tmp_path):
    """The writer stores its rows and then fails once; Spark runs the batch again."""
    folder = write_files(tmp_path / "in", chunks(history, 2))
    state = {"failed": False}

    def flaky(write):
        def run(rows, batch_id):
            write(rows, batch_id)
            if batch_id == 1 and not state["failed"]:
                state["failed"] = True
                raise RuntimeError("lost after the write")

        return run

    with pytest.raises(Exception):
        drain(spark, folder, parse.olap_rows, tmp_path, flaky)
    path, rows = drain(spark, folder, parse.olap_rows, tmp_path, flaky)
    assert state["failed"]
    assert same(sinks.read_files(spark, path, rows), parse.olap_rows(batch(spark, history)))


def test_archive_days_and_commits(spark, history, tmp_path):
    """The whole table, a day of rows without a time included, and a batch that runs twice."""
    lost = [("U", '{"behavior":"click","userId":"U","itemId":"x","ts":"zz"}', history[-1][2])] * 3
    everything = [*history, *lost]
    folder = write_files(tmp_path / "in", chunks(everything))
    path, arrivals = f"{tmp_path}/dwd", f"{tmp_path}/arrivals"
    write, runs = sinks.archive_writer(path, arrivals), []

    def twice(rows, batch_id):
        write(rows, batch_id)
        write(rows, batch_id)
        runs.append(batch_id)

    raw = record_sources.file_stream(spark, folder, files_per_trigger=1)
    rows = parse.archive_rows(raw, keep=["timestamp"])
    jobs.start(rows, twice, f"{tmp_path}/ck", NOW).awaitTermination()
    assert len(runs) == 4
    catalog.create_database(spark, "warehouse_db")
    table = "warehouse_db.behavior_dwd"
    catalog.create_archive_table(spark, table, path)
    want = parse.archive_rows(batch(spark, everything))
    arrived = parse.archive_rows(batch(spark, everything), keep=["timestamp"]).groupBy("dt")
    first = {r["dt"]: r["ms"] for r in arrived.agg(F.min(F.unix_millis("timestamp")).alias("ms")).collect()}
    days = sorted(d for d in first if d)
    as_of = first[days[4]] + 60_000
    assert sinks.commit_days(spark, path, arrivals, as_of, table=table) == days[:5]
    marked = sorted(d[3:] for d in os.listdir(path) if d.startswith("dt=") and os.path.exists(f"{path}/{d}/_SUCCESS"))
    assert marked == days[:5]
    assert same(spark.table(table), want.filter(F.col("dt").isin(days[:5])))
    for _ in range(2):
        assert sinks.commit_days(spark, path, arrivals, FAR, table=table) == [*days, None]
    assert same(spark.table(table), want)
    assert spark.sql(f"SHOW PARTITIONS {table}").count() == len(days) + 1
    assert spark.table(table).filter("dt IS NULL").count() == 3


def test_olap_table(spark, history, tmp_path):
    folder = write_files(tmp_path / "in", chunks(history, 2))
    raw = record_sources.file_stream(spark, folder, files_per_trigger=1)
    jobs.olap_job(raw, sinks.olap_writer(f"{tmp_path}/olap"), f"{tmp_path}/ck", NOW).awaitTermination()
    catalog.create_database(spark, "olap_db")
    catalog.create_olap_table(spark, "olap_db.behavior_olap", f"{tmp_path}/olap")
    stored = spark.read.parquet(f"{tmp_path}/olap")
    assert same(spark.table("olap_db.behavior_olap"), parse.olap_rows(batch(spark, history)))
    file = stored.inputFiles()[0]
    ts = [r["ts"] for r in spark.read.parquet(file).collect()]
    assert ts == sorted(ts)


def test_sql_path_matches_the_operator(spark, history):
    raw = batch(spark, history)
    catalog.register_source_view(raw, "src")
    assert same(spark.sql(catalog.archive_query("src")), parse.archive_rows(raw))
    assert "proctime" in spark.table("src").columns


def test_search_metric(spark, history):
    from pyspark.sql import Observation

    counts = windows.hot_word_counts(parse.parse_behavior(batch(spark, history), only="search"))
    seen = Observation("hot")
    n = counts.observe(seen, F.count(F.lit(1)).alias("total_search_count")).count()
    assert seen.get["total_search_count"] == n
    assert windows.with_search_metric(counts).columns == counts.columns


class Recorder:
    """Stands in for a DataFrame and keeps what a connector writer would be told."""

    def __init__(self):
        self.calls = {}

    def __getattr__(self, name):
        if name == "write":
            return self

        def call(*args, **kwargs):
            self.calls[name] = args or kwargs
            return self

        return call


def test_connector_options():
    jdbc, index, topic = Recorder(), Recorder(), Recorder()
    sinks.jdbc_writer("jdbc:x", "t", driver="d")(jdbc, 0)
    assert jdbc.calls["options"] == {"url": "jdbc:x", "dbtable": "t", "batchsize": "500", "driver": "d"}
    sinks.index_writer("behavior", "host")(index, 0)
    assert index.calls["options"]["es.batch.size.entries"] == "50" and index.calls["save"] == ("behavior",)
    sinks.topic_writer("b:9092", "t")(topic, 0)
    assert topic.calls["options"] == {"kafka.bootstrap.servers": "b:9092", "topic": "t"}
    assert record_sources.topic_options("b:9092", starting="earliest")["startingOffsets"] == "earliest"


def test_endpoints(monkeypatch):
    monkeypatch.delenv("KAFKA_BOOTSTRAP_SERVERS", raising=False)
    assert endpoints.endpoint("KAFKA_BOOTSTRAP_SERVERS") == "localhost:9092"
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "kafka:9092")
    assert endpoints.endpoint("KAFKA_BOOTSTRAP_SERVERS") == "kafka:9092"


def test_sessions_stream_uses_the_gap(spark, tmp_path):
    rows = [("U", json.dumps({"userId": "U", "ts": ts}), ts) for ts in (0, 300_000, 600_001)]
    raw = batch(spark, rows)
    got = sessions.session_windows(parse.parse_behavior(raw, ["userId"])).count()
    assert got == 2


def numbered(rows):
    return sorted((r["userId"] or "", r["eventId"], r["event_ms"], r["behavior"], r["session_no"]) for r in rows)


def test_numbered_sessions_equal_the_batch_over_shuffled_micro_batches(spark, history, tmp_path):
    """Rows are shuffled inside each file and change places with neighbouring files within the bound."""
    import random

    rng, rows = random.Random(7), [*history]
    nobody = json.dumps({"behavior": "click", "eventId": "nobody", "ts": rows[5][2]})
    rows.insert(6, (None, nobody, rows[5][2]))
    groups = chunks(rows, 5)
    for group in groups:
        rng.shuffle(group)
    folder = write_files(tmp_path / "in", [*groups, sentinel("click")])
    out, like = drain(spark, folder, lambda raw: jobs.numbered_sessions(raw, 3_600_000), tmp_path)
    got = [r for r in sinks.read_files(spark, out, like).collect() if r["userId"] != "Z"]
    want = sessions.sessionize(parse.parse_behavior(batch(spark, rows)), 3_600_000).collect()
    assert numbered(got) == numbered(want) and len(got) > 900


def test_numbered_sessions_go_on_after_a_restart_and_keep_no_passed_rows(spark, tmp_path):
    def event(n, ms, behavior="click"):
        return ("U1", json.dumps({"userId": "U1", "eventId": f"e{n}", "behavior": behavior, "ts": ms}), ms)

    rows = [event(0, 1_000), event(1, 2_000, "buy"), event(2, 2_500), event(3, 400_000), event(4, 400_000, "buy"), event(5, 400_001)]
    folder = tmp_path / "in"
    write_files(folder, [rows[:2], rows[2:3]])

    def run():
        raw = record_sources.file_stream(spark, str(folder), files_per_trigger=1)
        like = jobs.numbered_sessions(raw)
        query = jobs.start(like, sinks.file_writer(f"{tmp_path}/out"), f"{tmp_path}/ck", NOW)
        query.awaitTermination()
        return like, query.lastProgress

    like, _ = run()
    assert sinks.read_files(spark, f"{tmp_path}/out", like).count() == 0  # the bound has passed none
    write_files(folder, [rows[:2], rows[2:3], rows[3:], sentinel("click")])
    like, progress = run()
    got = {r["eventId"]: r["session_no"] for r in sinks.read_files(spark, f"{tmp_path}/out", like).collect()}
    # a purchase at the same time comes last, and ends the session
    assert got == {"e0": 1, "e1": 1, "e2": 2, "e3": 3, "e4": 3, "e5": 4}
    # what stays: one row for U1, and the waiting row, its timer and key of the sentinel's user
    assert sum(o["numRowsTotal"] for o in progress["stateOperators"]) <= 6


def test_numbered_sessions_hold_and_call_for_groups_and_read_the_records_once(spark, history, tmp_path):
    """Each row was a value of the state, each user's micro-batch several calls to it, and the records read twice."""
    many = [(f"{k}{n % 50}", v.replace('"userId":"', f'"userId":"{n % 50}-'), ms) for n, (k, v, ms) in enumerate(history)]
    folder = write_files(tmp_path / "in", [*chunks(many, 3), sentinel("click")])
    raw = record_sources.file_stream(spark, folder, files_per_trigger=1)
    events = jobs._all_records(raw, ["userId", "eventId", "behavior"]).filter("is_object")
    rows = keyed.sessionize_stream(events, 3_600_000, groups=5)
    assert rows._jdf.queryExecution().analyzed().toString().count("StreamingRelation") == 1
    query = jobs.start(rows, sinks.file_writer(f"{tmp_path}/out"), f"{tmp_path}/ck", NOW)
    query.awaitTermination()
    states = [sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in query.recentProgress]
    got = [r for r in sinks.read_files(spark, f"{tmp_path}/out", rows).collect() if r["userId"] != "Z"]
    want = sessions.sessionize(parse.parse_behavior(batch(spark, many)), 3_600_000).collect()
    assert numbered(got) == numbered(want) and len({r["userId"] for r in got}) > 200
    assert 0 < max(states) <= 5 * 8  # of a group: the rows of few frames, the sessions, a timer and its key


def test_numbered_sessions_leave_out_late_rows_of_users_only(spark, tmp_path):
    def event(event, user, ms, arrival):
        value = {"eventId": event, "behavior": "click", "ts": ms} | ({"userId": user} if user else {})
        return (user, json.dumps(value, ensure_ascii=False), arrival)

    day = 86_400_000
    groups = [
        [event("a", "Ü\"1", day, day), event("b", None, day, day)],
        [event("c", "Ü\"1", 2 * day, 2 * day), event(None, "Ü\"1", 2 * day, 2 * day)],
        [event("d", "U2", 3 * day, 3 * day)],
        [event("late", "U2", 1_000, 3 * day), event("late nobody", None, 1_000, 3 * day), event(None, None, 3 * day, 3 * day)],
        sentinel("click"),
    ]
    out, like = drain(spark, write_files(tmp_path / "in", groups), jobs.numbered_sessions, tmp_path)
    rows = sinks.read_files(spark, out, like).collect()
    got = sorted((r["userId"] or "", r["eventId"] or "", r["event_ms"], r["session_no"]) for r in rows)
    nobody = [("", "", 3 * day, None), ("", "b", day, None), ("", "late nobody", 1_000, None)]
    assert got == [*nobody, ("U2", "d", 3 * day, 1), ("Ü\"1", "", 2 * day, 2), ("Ü\"1", "a", day, 1), ("Ü\"1", "c", 2 * day, 2)]


def test_chained_top_n_equals_the_ranked_batch(spark, history, tmp_path):
    folder = write_files(tmp_path / "in", [*chunks(history), sentinel("search")])
    out, like = drain(spark, folder, lambda raw: jobs.hot_top(raw, 3, "12 hours", "6 hours"), tmp_path)
    counts = windows.hot_word_counts(parse.parse_behavior(batch(spark, history)), "12 hours", "6 hours")
    want = ranking.hot_search_topn(counts, 3)
    assert same(sinks.read_files(spark, out, like), want) and want.count() > 100


DEFAULT_STORE = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
STORE = "spark.sql.streaming.stateStore.providerClass"


@pytest.mark.parametrize("rows_of", [jobs.numbered_sessions, lambda raw: jobs.hot_top(raw, 3, "12 hours", "6 hours")])
def test_keyed_streams_run_in_a_session_with_sparks_default_state_store(spark, history, tmp_path, rows_of):
    folder = write_files(tmp_path / "in", [*chunks(history, 2), sentinel("search")])
    own = spark.conf.get(STORE)
    spark.conf.set(STORE, DEFAULT_STORE)
    try:
        out, like = drain(spark, folder, rows_of, tmp_path)
        assert sinks.read_files(spark, out, like).count() > 100 and spark.conf.get(STORE) == DEFAULT_STORE
    finally:
        spark.conf.set(STORE, own)


def test_processors_need_no_import_where_they_run():
    """As in a worker that cannot import this package."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    from clickpulse.streaming import keyed

    code = "import pickle, sys; p = pickle.load(sys.stdin.buffer); print(type(p).__name__, p.n, 'clickpulse' in sys.modules)"
    data = cloudpickle.dumps(keyed.Largest(3, True))
    done = subprocess.run([sys.executable, "-c", code], input=data, capture_output=True, cwd="/", env={**os.environ, "PYTHONPATH": ""})
    assert done.stdout.split() == [b"Largest", b"3", b"False"], done.stderr


def test_a_micro_batch_of_the_events_is_a_file_for_each_core_and_bounded(spark, monkeypatch):
    """One file a micro-batch was one task's work, and three micro-batches whatever the table held as well."""
    from clickpulse.plans import streams

    events = tables.load(spark, SMALL, "events").count()
    monkeypatch.setattr(streams, "_cut", {})
    monkeypatch.setattr(streams, "BATCH_EVENTS", events // 5, raising=False)
    folder, files = streams._in_order(spark, SMALL)
    parts = spark.read.parquet(folder).select("event_id", "ts", F.input_file_name().alias("file"))
    cores = spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in parts.groupBy("file").count().collect()]
    assert files > 1 and len(sizes) > 4 * cores and max(sizes) < events / cores and sum(sizes) == events
    names = sorted(f"{folder}/{n}" for n in os.listdir(folder) if n.startswith("part-"))
    assert names == sorted(names, key=os.path.getmtime) and len({os.path.getmtime(n) for n in names}) == len(names)
