"""Kept tables, delivery once, filled gaps, the archive's files and the command line."""

from __future__ import annotations

import json
import os
import random

import pytest
from conftest import instant
from pyspark.sql import functions as F
from test_streams import FAR, NOW, batch, chunks, history, same, sentinel, write_files  # noqa: F401

from clickpulse import __main__ as command
from clickpulse.operators import monitor, parse, profile, windows
from clickpulse.sources import records as record_sources
from clickpulse.streaming import jobs, kept, sinks


def run(spark, folder, rows_of, write, checkpoint):
    raw = record_sources.file_stream(spark, str(folder), files_per_trigger=1)
    query = jobs.start(rows_of(raw), write, str(checkpoint), NOW)
    query.awaitTermination()
    return query


def totals(rows):
    return rows.groupBy("k").agg(F.sum("n").alias("n"))


@pytest.fixture
def sums(spark, tmp_path):
    return kept.Kept(spark, str(tmp_path / "kept"), "k string, n bigint", totals, every=3)


def add(spark, table, batch_id, *pairs):
    table.add(spark.createDataFrame(list(pairs), "k string, n bigint"), batch_id)


def content(table):
    return sorted(map(tuple, table.read().collect()))


def test_kept_table_merges_replaces_and_stays_small(spark, sums, tmp_path):
    assert content(sums) == []
    add(spark, sums, 0, ("a", 1), ("a", 2))
    add(spark, sums, 1, ("b", 5))
    add(spark, sums, 1, ("b", 6))  # runs again
    assert content(sums) == [("a", 3), ("b", 6)]
    add(spark, sums, 2, ("a", 10))  # the third batch merges
    assert sinks.listed(spark, f"{tmp_path}/kept/base") == ["upto=2"] and sinks.listed(spark, f"{tmp_path}/kept/new") == []
    add(spark, sums, 2, ("a", 99))  # the base has it
    add(spark, sums, 5, ("c", 1))
    assert content(sums) == [("a", 13), ("b", 6), ("c", 1)]
    assert sums.has(1) and sums.has(5) and not sums.has(6)


def test_a_broken_merge_is_made_again(spark, sums, tmp_path):
    for n in range(2):
        add(spark, sums, n, ("a", 1))
    sums.compact()
    add(spark, sums, 2, ("a", 1))
    os.makedirs(tmp_path / "kept/base/upto=2")  # without its mark
    assert content(sums) == [("a", 3)]
    sums.compact()
    assert content(sums) == [("a", 3)] and sinks.listed(spark, f"{tmp_path}/kept/base") == ["upto=2"]


@pytest.mark.parametrize("seed", [1, 2])
def test_kept_cube_equals_the_batch_after_any_split(spark, history, tmp_path, seed):  # noqa: F811
    rng = random.Random(seed)
    cuts = sorted(rng.sample(range(1, len(history)), 5))
    parts = [history[a:z] for a, z in zip([0, *cuts], [*cuts, len(history)])]
    table = jobs.cube_parts_kept(spark, str(tmp_path / "parts"))
    table.every = 3
    fields = ["userId", "countryCode", "level", "behavior", "priceCNY"]
    for n, part in enumerate(parts):
        for _ in range(1 + rng.randrange(2)):  # some run twice
            table.add(profile.cube_parts(parse.parse_behavior(batch(spark, part), fields)), n)
    want = profile.gmv_cube(parse.parse_behavior(batch(spark, history), fields))
    assert same(jobs.kept_cube(spark, str(tmp_path / "parts")), want)


def test_replayed_events_add_no_row_and_are_forgotten(spark, history, tmp_path):  # noqa: F811
    parts = chunks(history, 3)
    folder = write_files(tmp_path / "in", [parts[0], parts[0], parts[1][:50] * 2, parts[1], parts[2], parts[0][-5:]])
    write = sinks.file_writer(f"{tmp_path}/out")
    progress = run(spark, folder, lambda raw: jobs.olap_once(raw, "60 days"), write, tmp_path / "ck").lastProgress
    like = parse.olap_rows(batch(spark, history))
    assert same(sinks.read_files(spark, f"{tmp_path}/out", like), like)
    held = progress["stateOperators"][0]["numRowsTotal"]
    assert held == like.count()
    far = json.dumps({"userId": "Z", "behavior": "click", "eventId": "far", "ts": FAR})
    write_files(tmp_path / "in", [parts[0], parts[0], parts[1][:50] * 2, parts[1], parts[2], parts[0][-5:], [("Z", far, FAR)]])
    progress = run(spark, folder, lambda raw: jobs.olap_once(raw, "60 days"), write, tmp_path / "ck").lastProgress
    assert progress["stateOperators"][0]["numRowsTotal"] <= 1


def test_documents_once(spark, tmp_path):
    rows = [("U", '{"eventId":"a"}', 1000), ("U", "bad", 1000)]
    folder = write_files(tmp_path / "in", [rows, rows])
    run(spark, folder, lambda raw: jobs.documents_once(raw, "1 hour"), sinks.file_writer(f"{tmp_path}/out"), tmp_path / "ck")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


def records_at(*seconds):
    return [("U", json.dumps({"behavior": "click", "ts": s * 1000}), s * 1000) for s in seconds]


def test_gaps_across_micro_batches_are_filled(spark, tmp_path):
    """Gaps inside a batch and across batches, empty batches, and each batch run twice."""
    groups = [records_at(0, 1, 9), records_at(30), records_at(31, 32), records_at(90, 91, 4000)]
    folder = write_files(tmp_path / "in", [*groups, [("Z", "far", FAR)]])
    write = sinks.filling_writer(sinks.file_writer(f"{tmp_path}/out"), f"{tmp_path}/last", 2000)

    def twice(rows, batch_id):
        write(rows, batch_id)
        write(rows, batch_id)

    run(spark, folder, lambda raw: jobs.monitored(raw, 2), twice, tmp_path / "ck")
    want = monitor.monitor_intervals(batch(spark, [r for g in groups for r in g]), 2, fill_empty=True)
    assert same(sinks.read_files(spark, f"{tmp_path}/out", want), want) and want.count() == 2001
    assert len(os.listdir(tmp_path / "last")) < 6


@pytest.mark.parametrize("seconds, times", [(2, [0]), (2, [5, 3601, 90_000, 90_003, 900_000]), (3600, [0, 400_000, 9_000_000]), (7, [1, 50_000])])
def test_filled_intervals_are_all_there(spark, seconds, times):
    got = monitor.monitor_intervals(batch(spark, records_at(*times)), seconds, fill_empty=True).collect()
    step, first = seconds * 1000, times[0] // seconds * seconds * 1000
    starts = list(range(first, times[-1] // seconds * seconds * 1000 + 1, step))
    assert sorted(r["window_start"] for r in got) == starts
    assert {r["window_start"] for r in got if r["cnt"]} == {t // seconds * step for t in times}
    assert all(r["clicks"] == r["cnt"] and r["qps"] == r["cnt"] / seconds for r in got)


def test_filled_intervals_read_the_records_once(spark, history, tmp_path):  # noqa: F811
    batch(spark, history).write.parquet(str(tmp_path / "raw"))
    rows = monitor.monitor_intervals(spark.read.parquet(str(tmp_path / "raw")), 3600, fill_empty=True)
    rows.collect()
    text = rows._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert text.count("FileScan") == 1 and text.count("from_json(") == 1


def test_commits_read_new_arrivals_only(spark, history, tmp_path):  # noqa: F811
    path, arrivals = f"{tmp_path}/dwd", f"{tmp_path}/arrivals"
    write = sinks.archive_writer(path, arrivals)
    rows = parse.archive_rows(batch(spark, history), keep=["timestamp"]).persist()
    days = sorted(r["dt"] for r in rows.select("dt").distinct().collect())
    for n in range(4):
        write(rows.filter(F.pmod(F.xxhash64("ts"), F.lit(4)) == n), n)
    assert len(sinks.listed(spark, f"{arrivals}/new")) == 4
    assert sinks.commit_days(spark, path, arrivals, FAR) == days
    assert sinks.listed(spark, f"{arrivals}/new") == [] and sinks.listed(spark, f"{arrivals}/base") == ["upto=3"]
    late = parse.archive_rows(batch(spark, [("U", '{"userId":"U","ts":4102444800000}', 5)]), keep=["timestamp"])
    write(late, 4)
    write(rows.filter(F.pmod(F.xxhash64("ts"), F.lit(4)) == 2), 2)  # an old batch runs again
    assert len(sinks.first_arrivals(spark, arrivals).read().inputFiles()) < 10
    assert sinks.commit_days(spark, path, arrivals, FAR) == [*days, "2100-01-01"]
    stored = spark.read.parquet(path).withColumn("dt", F.col("dt").cast("string"))
    assert same(stored, rows.drop("timestamp").unionByName(late.drop("timestamp")))


def test_archive_files_bear_their_batch_and_nothing_is_moved(spark, history, tmp_path, monkeypatch):  # noqa: F811
    path, arrivals = f"{tmp_path}/dwd", f"{tmp_path}/arrivals"
    write = sinks.archive_writer(path, arrivals)
    rows = parse.archive_rows(batch(spark, history[:300]), keep=["timestamp"])

    def lost(*_):
        raise RuntimeError("lost between the rows and the arrivals")

    with monkeypatch.context() as broken:
        broken.setattr(kept.Kept, "add", lost)
        with pytest.raises(RuntimeError):
            write(rows, 1)
    write(rows, 1)
    write(rows, 11)
    names = [f for d, _, files in os.walk(path) for f in files if f.endswith(".parquet") and "dt=" in d]
    assert {n.split("-")[1] for n in names} == {"1", "11"} and all(n.startswith("batch-") for n in names)
    assert spark.read.parquet(path).count() == 2 * rows.count()
    assert sinks.listed(spark, f"{path}/_begun") == []


def test_sketches_stay_within_their_error(spark):
    events = spark.range(300_000).select(
        F.concat(F.lit("u"), F.col("id") % 100_000).alias("userId"), F.timestamp_millis(F.col("id") % 600_000).alias("event_ts")
    )
    panes = windows.user_sketches(events)
    assert panes.count() == 5
    exact = {r["window_end"]: r["users"] for r in windows.online_users(events).collect()}
    near = {r["window_end"]: r["users"] for r in windows.sketched_users(panes).collect()}
    assert near.keys() == exact.keys() and all(abs(near[w] - n) < 0.03 * n + 1 for w, n in exact.items())
    (day,) = windows.sketched_users(panes, "1 day", "1 day").collect()
    assert day["window_end"] == 86_400_000 and abs(day["users"] - 100_000) < 3_000


def test_sketches_of_a_stream(spark, tmp_path, history):  # noqa: F811
    def rows_of(raw):
        return windows.user_sketches(jobs._all_records(raw, ["userId"]), "1 hour")

    folder = write_files(tmp_path / "in", [*chunks(history), sentinel("click")])
    run(spark, folder, rows_of, sinks.file_writer(f"{tmp_path}/out"), tmp_path / "ck")
    got = windows.sketched_users(spark.read.parquet(f"{tmp_path}/out"), "3 hours", "1 hour")
    assert same(got, windows.online_users(parse.parse_behavior(batch(spark, history)), "3 hours", "1 hour"))


@pytest.mark.parametrize("job, made", [("gmv", "lines"), ("hot", "reports"), ("olap", "rows"), ("archive", "rows"),
                                       ("monitor", "intervals"), ("cube", "parts")])
def test_jobs_run_from_the_command(spark, tmp_path, job, made):
    values = [("search", 1000), ("click", 2000), ("buy", 3000), ("search", 90_000), ("buy", 95_000)]
    rows = [("U", json.dumps({"userId": "U", "eventId": str(n), "behavior": b, "searchTerm": "a", "priceCNY": 2, "ts": ms}), ms)
            for n, (b, ms) in enumerate(values)]
    folder = write_files(tmp_path / "in", [rows, sentinel("buy")])
    command.run(spark, job, str(tmp_path / "out"), folder, once=True).awaitTermination()
    assert os.listdir(tmp_path / "out" / made)
    if job == "cube":
        totals_row = jobs.kept_cube(spark, f"{tmp_path}/out/parts").filter("gid = 3").first()
        assert (totals_row["gmv"], totals_row["buys"], totals_row["users"]) == (4.0, 3, 2)


def test_the_topic_is_at_the_endpoint_of_the_environment(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(record_sources, "topic_stream", lambda s, servers, starting: seen.update(at=servers, starting=starting))
    command.source(spark, None, command.JOBS["hot"][1])
    assert seen == {"at": "localhost:9092", "starting": "earliest"}
    monkeypatch.setenv("KAFKA_BOOTSTRAP_SERVERS", "broker:1")
    command.source(spark, None, command.JOBS["gmv"][1])
    assert seen == {"at": "broker:1", "starting": "latest"}
    assert instant(0).year == 1970
