"""Hand-written rows, one per rule of the event contract."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clickpulse.operators import archive, enrich, monitor, parse, profile, ranking, sessions, windows
from clickpulse.schema import RATES
from clickpulse.sources import catalog


def lines(*events, start=0):
    return [(json.dumps(e, ensure_ascii=False), start) for e in events]


def buy(ts, price=1.0, **more):
    return {"behavior": "buy", "priceCNY": price, "ts": ts, **more}


def term(word, ts):
    return {"behavior": "search", "searchTerm": word, "ts": ts}


def gmv(raw):
    rows = windows.gmv_tumbling(parse.parse_behavior(raw, ["behavior", "priceCNY"], only="buy")).collect()
    return {r["window_start"]: r["gmv"] for r in rows}


def counts(raw):
    return windows.hot_word_counts(parse.parse_behavior(raw, ["behavior", "searchTerm"], only="search"))


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_window_end_is_exclusive(records):
    assert gmv(records(*lines(buy(1000, 10.5), buy(5000, 1)))) == {0: 10.5, 5000: 1.0}


def test_quoted_and_fractional_numbers(records):
    raw = records(
        ('{"behavior":"buy","priceCNY":"2.5","ts":"1001"}', 1001),
        ('{"behavior":"click","ts":12.9}', 12),
        ('{"behavior":"click","ts":1.7e12}', 12),
    )
    rows = parse.parse_behavior(raw, ["behavior", "priceCNY", "ts"]).collect()
    assert [(r["ts"], None if r["priceCNY"] is None else float(r["priceCNY"])) for r in rows] == [
        (1001, 2.5), (12, None), (1_700_000_000_000, None),
    ]


def test_unreadable_ts_falls_back_and_hides_the_buy_in_the_monitor(records):
    raw = records(('{"behavior":"buy","priceCNY":1,"ts":"zz"}', 2000))
    assert one(parse.event_time_fallback(raw))["event_ms"] == 2000
    assert gmv(raw) == {0: 1.0}
    row = one(monitor.monitor_intervals(raw))
    assert (row["cnt"], row["buys"], row["gmv"]) == (1, 0, 0.0)


def test_absent_ts(records):
    raw = records(('{"behavior":"search","searchTerm":"a"}', 3000))
    assert one(parse.event_time_fallback(raw))["event_ms"] == 3000
    assert one(parse.olap_rows(raw))["ts"] == 0
    assert one(parse.archive_rows(raw))["dt"] is None


def test_ts_outside_the_calendar_does_not_fail(records):
    raw = records(('{"behavior":"buy","priceCNY":1,"ts":9000000000000000000}', 2000))
    assert one(parse.event_time_fallback(raw))["event_ms"] == 2000
    assert one(parse.archive_rows(raw))["dt"] is None


def test_null_and_unreadable_price(records):
    raw = records(
        ('{"behavior":"buy","priceCNY":null,"ts":1000}', 1000),
        ('{"behavior":"buy","priceCNY":"x","ts":1000}', 1500),
    )
    assert gmv(raw) == {}
    row = one(monitor.monitor_intervals(raw))
    assert (row["buys"], row["gmv"], row["max_delay_ms"]) == (2, 0.0, 0)


def test_unreadable_price_hides_the_delay_only(records):
    late = records(
        ('{"behavior":"buy","priceCNY":"x","ts":100}', 1500), ('{"behavior":"click","ts":1200}', 1500)
    )
    row = one(monitor.monitor_intervals(late))
    assert (row["buys"], row["clicks"], row["max_delay_ms"]) == (1, 1, 300)


def test_null_term_is_dropped(records):
    assert counts(records(('{"behavior":"search","searchTerm":null,"ts":1000}', 1000))).count() == 0


def test_olap_defaults_need_an_absent_key(records):
    raw = records(
        ('{"userId":"absent","ts":1}', 1),
        ('{"userId":"null_age","age":null,"ts":1}', 1),
        ('{"userId":"null_level","level":null,"ts":1}', 1),
        ('{"userId":"bad_age","age":"x","ts":1}', 1),
        ('{"userId":"old","age":256,"ts":1}', 1),
        ('{"userId":"bad_ts","ts":"zz"}', 1),
        ('{"userId":"null_ts","ts":null}', 1),
    )
    rows = {r["user_id"]: r for r in parse.olap_rows(raw).collect()}
    assert set(rows) == {"absent", "null_level", "null_ts"}
    assert (rows["absent"]["age"], rows["absent"]["level"]) == (18, "Bronze")
    assert rows["null_level"]["level"] is None
    assert rows["null_ts"]["ts"] == 0


def test_session_default_is_stable(records):
    raw = records(('{"userId":"U1","ts":1}', 1), ('{"userId":"U1","ts":2,"sessionId":"s"}', 1))
    first = sorted(r["session_id"] for r in parse.olap_rows(raw).collect())
    assert first == sorted(r["session_id"] for r in parse.olap_rows(raw).collect())
    assert "s" in first and len(max(first, key=len)) == 64


NOT_OBJECTS = ["[1]", "null", '"x"', "", "bad", '{"behavior":"buy"', '{"ts":1}{"ts":2}', '{"ts":1},{"ts":2}',
               '{"ts":1} trailing', '[{"ts":1}]', '{"behavior":"bu',
               '{"behavior":"buy","priceCNY":5,"ts":1},"x":1', '{"ts":1},"x":{"a":1}', '{"ts":1}],"y":[{"a":1}',
               '{"a":{"b":1},"ts":1},"x":{}']


def test_lines_that_are_no_object(records):
    raw = records(*[(v, 1) for v in NOT_OBJECTS])
    assert parse.parse_behavior(raw).count() == 0
    assert parse.olap_rows(raw).count() == 0
    assert parse.archive_rows(raw).count() == 0
    assert one(monitor.monitor_intervals(raw))["cnt"] == len(NOT_OBJECTS)
    assert parse.parse_behavior(raw, ["behavior"], on_error="keep").filter("NOT is_object").count() == len(NOT_OBJECTS)
    assert one(parse.reject_report(raw))["reason"] == "malformed"
    assert parse.raw_documents(raw).filter(F.length("event_id") == 64).count() == len(NOT_OBJECTS)


def test_objects_with_braces_inside_are_no_splices(records):
    values = ['{"behavior":"buy","x":{"a":{}},"ts":1}', '{"behavior":"buy","x":"},\\"y\\":{","ts":1}', ' {"behavior":"buy","ts":1} \t']
    assert parse.parse_behavior(records(*[(v, 1) for v in values]), only="buy").count() == len(values)


@pytest.mark.parametrize("word, line", [
    ("a/b", r'{"behavior":"a\/b","ts":1}'),
    ('a"b', r'{"behavior":"a\"b","ts":1}'),
    ("a\tb", r'{"behavior":"a\tb","ts":1}'),
    ("a\\b", r'{"behavior":"a\\b","ts":1}'),
    ("buy", r'{"behavior":"\u0062uy","ts":1}'),
])
def test_only_finds_escaped_words(records, word, line):
    assert json.loads(line)["behavior"] == word
    assert parse.parse_behavior(records((line, 1), ('{"behavior":"other","ts":1}', 1)), only=word).count() == 1


def test_amounts_that_do_not_fit_are_rejected_and_counted(records):
    raw = records(*lines({"userId": "U", "behavior": "buy", "ts": 1, "priceCNY": 1e21}, buy(2, userId="U")))
    assert {r["reason"]: r["n"] for r in parse.reject_report(raw).collect()} == {"bad_price": 1, "ok": 1}


def test_fail_mode_raises(records):
    good, bad = records(('{"ts":1}', 1)), records(("bad", 1))
    assert parse.parse_behavior(good, ["ts"], on_error="fail").count() == 1
    with pytest.raises(Exception, match="not a JSON object"):
        parse.parse_behavior(bad, ["ts"], on_error="fail").collect()


def test_prefilter_sees_escaped_letters(records):
    raw = records(('{"behavior":"\\u0062uy","priceCNY":1,"ts":1}', 1), ('{"behavior":"click","ts":1}', 1))
    assert gmv(raw) == {0: 1.0}


def test_utf16_length(records):
    assert one(monitor.monitor_intervals(records(('{"searchTerm":"é🔥"}', 1))))["chars"] == 20


def test_negative_delay_is_zero(records):
    assert one(monitor.monitor_intervals(records(('{"behavior":"click","ts":9000}', 8000))))["max_delay_ms"] == 0


def test_monitor_rates(records):
    raw = records(*lines(term("a", 1), term("b", 1), {"behavior": "click", "ts": 1}))
    row = one(monitor.monitor_intervals(raw))
    assert (row["qps"], row["click_rate"], row["buy_rate"]) == (1.5, 50.0, 0.0)
    assert row["kb_per_s"] == row["chars"] / 1024 / 2


def test_monitor_fills_empty_intervals(records):
    raw = records(('{"behavior":"click","ts":1}', 0), ('{"behavior":"click","ts":1}', 7_204_000))
    rows = monitor.monitor_intervals(raw, fill_empty=True).orderBy("window_start").collect()
    assert [r["window_start"] for r in rows] == list(range(0, 7_204_001, 2000))
    assert sum(r["cnt"] for r in rows) == 2 and rows[1]["qps"] == 0.0


def test_alarm(records):
    raw = records(('{"behavior":"click","ts":1}', 6000), ('{"behavior":"click","ts":8000}', 8000))
    rows = monitor.backlog_alarm(monitor.monitor_intervals(raw)).collect()
    assert [(r["window_start"], r["reason"]) for r in rows] == [(6000, "delay")]


def test_ties_break_by_word(records):
    raw = records(*lines(*[term(w, 1000) for w in "badc"]))
    top = ranking.hot_search_topn(counts(raw))
    assert [r["word"] for r in top.filter("window_end = 10000").orderBy("rank").collect()] == ["a", "b", "c"]


def test_sliding_cover(records):
    rows = counts(records(*lines(term("x", 29_000), term("y", 30_000)))).collect()
    assert sorted(r["window_end"] for r in rows if r["word"] == "x") == [30_000, 40_000, 50_000]
    assert sorted(r["window_end"] for r in rows if r["word"] == "y") == [40_000, 50_000, 60_000]


def test_reports(records):
    raw = records(*lines(term("a:b", 1000), term("a:b", 1000), term("c", 1000), term("d", 12_000)))
    top = ranking.hot_search_topn(counts(raw))
    latest = one(ranking.hot_search_latest(ranking.hot_search_report(top)))
    assert latest["report"] == "Hot search 1970-01-01 00:00:40\nTop 1: d (1)"
    assert latest["field"] == "last_hot_search_result"
    by_rank = {r["field"]: r["line"] for r in ranking.hot_search_by_rank(top).collect()}
    assert by_rank == {"Top 1": "Top 1: d (1)", "Top 2": "Top 2: c (1)", "Top 3": "Top 3: d (1)"}
    assert one(windows.hot_word_counter(counts(raw)))["total_search_count"] == 9


def test_no_report_without_searches(records):
    top = ranking.hot_search_topn(counts(records(*lines(buy(1)))))
    assert ranking.hot_search_latest(ranking.hot_search_report(top)).count() == 0


def test_gmv_report_rounds_half_up(records):
    raw = records(*lines(buy(1, 2.675)))
    gmv_rows = windows.gmv_tumbling(parse.parse_behavior(raw))
    assert one(windows.gmv_report(gmv_rows))["line"] == "GMV (CNY): 2.68"


def user_events(*steps, user="U1"):
    return [
        {"userId": user, "eventId": f"e{i}", "behavior": b, "ts": ts, "itemId": item}
        for i, (b, ts, item) in enumerate(steps)
    ]


def test_session_gap_is_strict(records):
    raw = records(*lines(*user_events(("click", 0, "i"), ("click", 300_000, "i"), ("click", 600_001, "i"))))
    rows = sessions.sessionize(parse.parse_behavior(raw)).orderBy("event_ms").collect()
    assert [r["session_no"] for r in rows] == [1, 1, 2]
    spans = sessions.session_windows(parse.parse_behavior(raw)).orderBy("session_start").collect()
    assert [(r["session_start"], r["session_end"], r["n_events"]) for r in spans] == [
        (0, 600_000, 2), (600_001, 900_001, 1),
    ]


def test_buy_ends_the_session(records):
    raw = records(*lines(*user_events(("search", 0, ""), ("buy", 1000, "i"), ("click", 2000, "i"))))
    rows = sessions.sessionize(parse.parse_behavior(raw)).orderBy("event_ms").collect()
    assert [r["session_no"] for r in rows] == [1, 1, 2]


def test_break_after_buy_counts_once(records):
    raw = records(*lines(*user_events(("buy", 0, "i"), ("click", 900_000, "i"), ("click", 2_000_000, "i"))))
    rows = sessions.sessionize(parse.parse_behavior(raw)).orderBy("event_ms").collect()
    assert [r["session_no"] for r in rows] == [1, 2, 3]


def test_funnel_needs_the_order(records):
    raw = records(
        *lines(*user_events(("search", 0, ""), ("click", 1000, "i"), ("buy", 2000, "i"), user="A")),
        *lines(*user_events(("click", 0, "i"), ("search", 1000, ""), ("buy", 2000, "i"), user="B")),
        *lines(*user_events(("click", 0, "i"), user="C")),
    )
    row = one(sessions.session_funnel(sessions.sessionize(parse.parse_behavior(raw))))
    assert row.asDict() == {"sessions": 3, "searched": 2, "clicked": 1, "bought": 1}


def test_day_boundary(records, spark):
    """Both forms of the archive give UTC days in any session, also before 1970 and beyond the calendar."""
    stamps = [1_704_067_199_999, 1_704_067_200_000, 1_704_063_600_000, -1, 0, 9 * 10**18, -9 * 10**18]
    raw = records(*lines(*({"ts": t} for t in stamps)))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        catalog.register_source_view(raw, "tokyo")
        days = {r["ts"]: r["dt"] for r in parse.archive_rows(raw).collect()}
        in_sql = {r["ts"]: r["dt"] for r in spark.sql(catalog.archive_query("tokyo")).collect()}
        top = spark.createDataFrame([(1_704_067_199_999, 1, "a", 2)], "window_end long, rank int, word string, n long")
        report = one(ranking.hot_search_report(top))["report"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    want = ["2023-12-31", "2024-01-01", "2023-12-31", "1969-12-31", "1970-01-01", None, None]
    assert days == in_sql == dict(zip(stamps, want))
    assert report.startswith("Hot search 2023-12-31 23:59:59\n")


def test_fixed_rates():
    """The rates of the contract, written out, as the SQL oracle takes them from the same place as the code."""
    assert {(c, cur): float(r) for _, c, cur, r in RATES} == {
        ("US", "USD"): 7.2, ("DE", "EUR"): 7.8, ("UK", "GBP"): 9.2, ("JP", "JPY"): 0.048,
        ("AU", "AUD"): 4.7, ("CA", "CAD"): 5.3, ("CN", "CNY"): 1.0, ("KR", "KRW"): 0.0054,
    }


@pytest.mark.parametrize("as_of, committed", [(59_999, False), (60_000, True)])
def test_commit_delay(records, as_of, committed):
    rows = parse.archive_rows(records(*lines({"ts": 1})), keep=["timestamp"])
    assert one(archive.partition_commits(rows, as_of))["committed"] is committed


def test_zero_base_funnel(records):
    raw = records(*lines(buy(1, countryCode="US")))
    row = one(monitor.funnel_rates(parse.parse_behavior(raw)))
    assert (row["buys"], row["click_rate"], row["buy_rate"]) == (1, 0.0, 0.0)


def test_unknown_user_keeps_row_and_defaults(records, spark):
    raw = records(*lines({"userId": "A", "ts": 1, "age": 30}, {"userId": "B", "ts": 1}))
    profiles = spark.createDataFrame([("Z", 50, "Gold")], "user_id string, age int, level string")
    rows = {r["userId"]: r for r in enrich.profile_enrich(parse.parse_behavior(raw), profiles).collect()}
    assert (rows["A"]["age"], rows["A"]["level"], rows["A"]["has_profile"]) == (30, "Bronze", False)
    assert rows["B"]["age"] == 18


def test_currency_without_rate(records):
    raw = records(*lines({"price": 100, "currency": "JPY", "countryCode": "JP"}, {"price": 1, "currency": "XXX"}))
    rows = enrich.with_site(enrich.with_cny(parse.parse_behavior(raw))).collect()
    assert {r["currency"]: (None if r["price_cny"] is None else float(r["price_cny"])) for r in rows} == {
        "JPY": 4.8, "XXX": None,
    }
    assert {r["site"] for r in rows} == {"TEMU_JP", None}


def test_encode_leaves_nulls_out(records):
    raw = records(*lines({"userId": "U1", "behavior": "click", "ts": 5}))
    row = one(parse.encode_behavior(parse.parse_behavior(raw)))
    assert row["key"] == "U1" and json.loads(row["value"]) == {"userId": "U1", "behavior": "click", "ts": 5}


def test_rows_without_a_user_are_in_no_session_and_no_order(records):
    raw = records(*[(json.dumps({"behavior": "click", "eventId": str(i), "ts": 10 - i}), 20 + i) for i in range(3)])
    events = parse.parse_behavior(raw)
    numbered = sessions.sessionize(events)
    assert [(r["userId"], r["session_no"]) for r in numbered.collect()] == [(None, None)] * 3
    assert sessions.session_windows(events).count() == 0
    assert one(sessions.session_funnel(numbered))["sessions"] == 0
    row = one(monitor.lateness_profile(events))
    assert (row["n"], row["out_of_order"]) == (3, 0)


def test_rows_without_a_user_share_no_chunk_with_a_user_of_that_name(records):
    named = [json.dumps({"userId": str(n), "behavior": "click", "eventId": f"n{n}", "ts": 5}) for n in range(5000)]
    nobody = [json.dumps({"behavior": "buy", "eventId": f"x{n}", "ts": 4}) for n in range(300)]
    rows = sessions.sessionize(parse.parse_behavior(records(*[(v, 9) for v in named + nobody]))).collect()
    assert sorted(r["eventId"] for r in rows if r["session_no"] is None) == sorted(f"x{n}" for n in range(300))
    assert {r["session_no"] for r in rows if r["userId"] is not None} == {1}


@pytest.mark.parametrize("head", ["null", "1", '"x"', "[]", " null", "\\tnull", "true", "{}", '{"r":1}', "-1.5"])
def test_members_spliced_behind_another_value_are_malformed(records, head):
    member = '"r":{"userId":"N","behavior":"buy","ts":1,"priceCNY":1}'
    raw = records((f"{head},{member}", 1), (f"{head},{member[:-1]}", 1), (f"{head} ,{member} ", 1))
    assert parse.parse_behavior(raw).count() == 0
    assert [r["reason"] for r in parse.reject_reason(raw).collect()] == ["malformed"] * 3


def test_split_rejects(records):
    raw = records(
        ('{"userId":"U1","behavior":"buy","ts":1,"priceCNY":"x"}', 1),
        ('{"userId":"U1","behavior":"click","ts":1}', 1),
        ('{"behavior":"click","ts":1}', 1),
        ('{"userId":"U1","behavior":"click"}', 1),
        ('{"userId":"U1","behavior":"cart","ts":1}', 1),
    )
    clean, rejected = parse.split_rejects(raw)
    assert clean.count() == 1
    assert sorted(r["reason"] for r in rejected.collect()) == ["bad_price", "bad_ts", "missing_user", "unknown_behavior"]


def test_favourite_item_ties(records):
    raw = records(*lines(*user_events(("click", 1, "b"), ("click", 2, "a"), ("search", 3, ""), ("buy", 4, "c"))))
    row = one(profile.user_profile(parse.parse_behavior(raw)))
    assert (row["favourite_item"], row["clicks"], row["buys"], row["searches"], row["last_seen"]) == ("a", 2, 1, 1, 4)
