"""Ordered operators against plain Python on random histories with a dominant user."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from clickpulse.operators import monitor, parse, profile, search, sessions, stored_index

SCHEMA = "userId string, eventId string, behavior string, itemId string, event_ms bigint, arrival bigint"


def history(seed, n=1500):
    """Rows of which a third and more belong to one user, with equal times among them."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        user = "hot" if rng.random() < 0.4 else f"u{rng.randrange(20)}"
        ms = rng.randrange(0, 3_000_000) // 500 * 500
        kind = rng.choices(["search", "click", "buy", None], [4, 4, 2, 1])[0]
        item = f"i{rng.randrange(12)}" if kind in ("click", "buy") else ""
        rows.append((user, f"e{i:05d}", kind, item, ms, ms + rng.choice([0, 0, 0, 4000, 7000])))
    return rows


@pytest.fixture(params=[1, 2, 3])
def rows(request):
    return history(request.param)


@pytest.fixture
def events(spark, rows):
    frame = spark.createDataFrame(rows, SCHEMA)
    return frame.withColumn("event_ts", F.timestamp_millis("event_ms")).withColumn(
        "timestamp", F.timestamp_millis("arrival")
    )


def by_user(rows, key):
    users = defaultdict(list)
    for r in rows:
        users[r[0]].append(r)
    return {u: sorted(rs, key=key) for u, rs in users.items()}


@pytest.mark.parametrize("gap_ms", [1000, 20_000, 400_000])
def test_sessionize(events, rows, gap_ms):
    want = {}
    for user, mine in by_user(rows, lambda r: (r[4], r[2] == "buy", r[1])).items():
        no, last, after_buy = 1, None, False
        for r in mine:
            if last is not None and (after_buy or r[4] - last > gap_ms):
                no += 1
            want[r[1]] = no
            last, after_buy = r[4], r[2] == "buy"
    got = {r["eventId"]: r["session_no"] for r in sessions.sessionize(events, gap_ms).collect()}
    assert got == want


def test_session_keeps_columns(events, rows):
    got = sessions.sessionize(events, keep=("itemId",)).collect()
    assert {(r["eventId"], r["itemId"]) for r in got} == {(r[1], r[3]) for r in rows}


@pytest.mark.parametrize("gap, gap_ms", [("1 second", 1000), ("1 minute", 60_000)])
def test_session_windows(events, rows, gap, gap_ms):
    want = Counter()
    for user, mine in by_user(rows, lambda r: r[4]).items():
        start = last = None
        for r in mine:
            if start is None or r[4] - last > gap_ms:
                start = r[4]
            want[(user, start)] += 1
            last = r[4]
    got = {(r["userId"], r["session_start"]): r["n_events"] for r in sessions.session_windows(events, gap).collect()}
    assert got == dict(want)


def test_funnel(events, rows):
    gap = 20_000
    groups = defaultdict(list)
    for r in sessions.sessionize(events, gap).collect():
        groups[(r["userId"], r["session_no"])].append((r["event_ms"], r["behavior"]))
    want = Counter(sessions=len(groups))
    for steps in groups.values():
        def first(kind, after):
            return min((t for t, b in steps if b == kind and t >= after), default=None)

        s = first("search", -1)
        c = None if s is None else first("click", s)
        b = None if c is None else first("buy", c)
        want["searched"] += s is not None
        want["clicked"] += c is not None
        want["bought"] += b is not None
    row = sessions.session_funnel(sessions.sessionize(events, gap)).collect()[0].asDict()
    assert row == dict(want)


def test_lateness(events, rows):
    late = 0
    for mine in by_user(rows, lambda r: (r[5], r[1])).values():
        newest = None
        for r in mine:
            late += newest is not None and r[4] < newest
            newest = r[4] if newest is None else max(newest, r[4])
    row = monitor.lateness_profile(events, chunk_ms=10_000, quantiles=(0.5, 0.95)).collect()[0]
    assert row["out_of_order"] == late and late > 0
    assert row["n"] == len(rows)
    assert row["delayed"] == sum(r[5] > r[4] for r in rows)
    assert row["beyond_bound"] == sum(r[5] - r[4] > 5000 for r in rows)
    assert row["delay_p95"] == 7000 and row["max_delay_ms"] == 7000


def test_cooccurrence(events, rows):
    pairs = Counter()
    for mine in by_user(rows, lambda r: (r[4], r[1])).values():
        items = [r[3] for r in mine if r[3]]
        for a, b in zip(items, items[1:]):
            if a != b:
                pairs[(a, b)] += 1
                pairs[(b, a)] += 1
    want = {}
    for item in {a for a, _ in pairs}:
        best = sorted(((-n, b) for (a, b), n in pairs.items() if a == item))[:3]
        want.update({(item, i + 1): (b, -n) for i, (n, b) in enumerate(best)})
    got = {(r["item_id"], r["rank"]): (r["other_id"], r["n"])
           for r in profile.item_cooccurrence(events, 3, chunk_ms=10_000).collect()}
    assert got == want


def test_index_with_a_common_word(spark):
    rng = random.Random(7)
    docs = []
    for i in range(300):
        words = ["the"] * rng.randrange(1, 4) + [f"w{rng.randrange(50)}" for _ in range(rng.randrange(30))]
        rng.shuffle(words)
        docs.append((i, rng.choice(["en", "de", None]), "  ".join(words) + "! É été"))
    docs += [(300, "en", ""), (301, "en", None), (302, "de", "...")]
    frame = spark.createDataFrame(docs, "doc_id bigint, lang string, text string")
    tf = Counter()
    for doc, lang, text in docs:
        for word in (text or "").replace("!", " ").replace(".", " ").lower().split():
            tf[(lang or "", word, doc)] += 1
    df = Counter((lang, word) for lang, word, _ in tf)
    got = {(r["lang"], r["token"], r["doc_id"]): (r["tf"], r["df"]) for r in search.inverted_index(frame).collect()}
    assert got == {k: (n, df[k[:2]]) for k, n in tf.items()}


def test_a_word_has_more_keys_where_it_is_more_of_the_rows(spark):
    """Words of long documents keep one key each; a word that is a document by itself is spread."""
    long = [(i, "en", " ".join(f"w{j}" for j in range(200))) for i in range(100)]
    short = [(1000 + i, "en", "the") for i in range(400)]
    frame = spark.createDataFrame(long + short + [(None, "en", "The")], "doc_id bigint, lang string, text string")
    rows = search.salted_postings(frame, 32).groupBy("token").agg(F.countDistinct("salt").alias("keys"), F.count("*").alias("n"))
    got = {r["token"]: (r["keys"], r["n"]) for r in rows.collect()}
    assert got == {"the": (32, 401)} | {f"w{j}": (1, 100) for j in range(200)}


def test_index_postings_are_not_sorted(spark):
    frame = spark.createDataFrame([(1, "en", "a b")], "doc_id bigint, lang string, text string")
    text = search.inverted_index(frame)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in text and "SortMergeJoin" not in text


def test_rows_without_a_user_are_kept(records):
    raw = records(('{"behavior":"click","eventId":"a","ts":1}', 1), ('{"behavior":"click","eventId":"b","ts":2}', 2))
    events = parse.parse_behavior(raw)
    assert sessions.sessionize(events).count() == 2
    assert monitor.lateness_profile(events).collect()[0]["n"] == 2


@pytest.mark.parametrize("reach, span, piece", [(1, None, 1024), (3, None, 7), (5, 30_000, 5), (40, 100_000, 8)])
def test_item_pairs(events, rows, reach, span, piece):
    """Every pair within reach of every history, the long one included, whatever the pieces."""
    want = defaultdict(Counter)
    for mine in by_user(rows, lambda r: (r[4], r[1])).values():
        items = [(r[3], r[4]) for r in mine if r[2] in ("click", "buy")]
        for i, (item, ms) in enumerate(items):
            for other, before in items[max(0, i - reach) : i]:
                if other != item and (span is None or ms - before <= span):
                    want[item][other] += 1
                    want[other][item] += 1
    got = defaultdict(list)
    for r in profile.item_pairs(events, reach, 4, span_ms=span, piece=piece).collect():
        got[r["item_id"]].append((r["rank"], r["other_id"], r["n"]))
    assert {i: sorted(rs) for i, rs in got.items()} == {
        i: [(k + 1, o, n) for k, (o, n) in enumerate(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:4])] for i, c in want.items()
    }


def test_one_step_pairs_are_the_neighbours(events):
    assert sorted(profile.item_pairs(events, 1).collect()) == sorted(profile.item_cooccurrence(events).collect())


@pytest.mark.parametrize("chunk_ms, chunks", [(1000, 4096), (1000, 3), (500, 1)])
def test_lateness_across_users(events, rows, chunk_ms, chunks):
    newest, late = None, 0
    for r in sorted(rows, key=lambda r: (r[5], r[1])):
        late += newest is not None and r[4] < newest
        newest = r[4] if newest is None else max(newest, r[4])
    row = monitor.lateness_profile_global(events, chunk_ms=chunk_ms, chunks=chunks).collect()[0]
    assert (row["out_of_order"], row["n"]) == (late, len(rows))
    assert row["delayed"] == sum(r[5] > r[4] for r in rows) and row["beyond_bound"] == sum(r[5] - r[4] > 5000 for r in rows)


def test_lateness_before_1970(spark):
    rows = [("a", -5_000_000, -5_000_000), ("b", -4_000_000, -6_000_000), ("c", 3_000_000, 3_000_000), ("d", 4_000_000, -9_000_000)]
    frame = spark.createDataFrame(rows, "eventId string, arrival bigint, ms bigint").select(
        "eventId", F.timestamp_millis("arrival").alias("timestamp"), F.timestamp_millis("ms").alias("event_ts")
    )
    assert sum(r["out_of_order"] for r in monitor.lateness_profile_global(frame, chunks=2).collect()) == 2


def test_a_hot_history_is_spread(spark):
    """A third of all rows are one user's; no task of the pairs gets more than a piece and what it looks back on."""
    rows = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('u', id)) AS userId", "CAST(id AS string) AS eventId", "'click' AS behavior",
        "concat('i', id % 50) AS itemId", "timestamp_millis(id * 10) AS event_ts",
    )
    text = profile.item_pairs(rows, 3, piece=100)._jdf.queryExecution().executedPlan().toString()
    assert "Window [collect_list" in text and "[userId" in text.split("Window [collect_list")[1][:200]
    assert "piece" in text.split("Window [collect_list")[1][:300]
    assert profile.item_pairs(rows, 3, piece=100).count() > 0


INDEX_TERMS = ("w1", "W2", "w17", "w40", "missing")


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    rng = random.Random(3)
    docs = []
    for i in range(3000):
        lang, size = rng.choice(["en", "en", "de", None]), rng.choice([3, 5, 8, 200 if rng.random() < 0.05 else 10])
        docs.append((i, " ".join(f"w{min(int(rng.expovariate(0.08)), 60)}" for _ in range(size)), lang))
    docs += [(9000 + i, docs[7][1], "en") for i in range(40)]  # equal scores
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, lang string")
    stored_index.build_index(frame, "test_index", str(tmp_path_factory.mktemp("index") / "i"), buckets=16, width=20)
    return frame


@pytest.mark.parametrize("k", [1, 10, 60, 5000])
def test_stored_index_ranks_as_a_search_of_all_texts(spark, index, k):
    want = sorted(search.search_documents(index, INDEX_TERMS, k).collect())
    assert sorted(stored_index.search_index(spark, "test_index", INDEX_TERMS, k).collect()) == want
    assert sorted(stored_index.search_index(spark, "test_index", INDEX_TERMS, k, early_stop=False).collect()) == want


def test_early_stop_scores_fewer_rows(spark, index):
    live = stored_index.live_postings(spark, "test_index", ["w1", "w2"], 5).count()
    assert 0 < live < 0.7 * stored_index.term_postings(spark, "test_index", ["w1", "w2"]).count()


def test_a_query_reads_the_buckets_of_its_terms_only(spark, index):
    text = stored_index.search_index(spark, "test_index", ["w1", "w17"])._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in text.splitlines() if "FileScan" in line and "token" in line]
    assert scans and all("SelectedBucketsCount: 2 out of 16" in line or "SelectedBucketsCount: 1 out of 16" in line for line in scans)
    files = stored_index.term_postings(spark, "test_index", ["w1"]).selectExpr("input_file_name() AS f").distinct().count()
    assert files <= 8 < spark.table("test_index").selectExpr("input_file_name() AS f").distinct().count()


def test_blocks_are_shown_from_the_postings(spark, index):
    """The index is written once; of each token and block one posting stands for all, also where documents come twice."""
    assert spark.catalog.getTable("test_index_blocks").tableType == "VIEW"
    own = spark.table("test_index").groupBy("lang", "token", "block")
    want = own.agg(F.max("tf").alias("max_tf"), F.count(F.lit(1)).alias("n"))
    got = spark.table("test_index_blocks").select(want.columns)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.agg(F.sum("n")).first()[0] == search.postings(index).count()


def test_stored_index_of_no_documents(spark, tmp_path):
    empty = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    stored_index.build_index(empty, "empty_index", str(tmp_path / "i"))
    assert stored_index.search_index(spark, "empty_index", ["a"]).collect() == []
