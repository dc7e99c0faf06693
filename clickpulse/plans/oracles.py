"""The same results in ANSI SQL over the plain table columns, for an independent check."""

from __future__ import annotations

from clickpulse.plans.queries import AS_OF_MS, SEARCH_TERMS, WIDE_GAP_MS
from clickpulse.schema import RATES

_RATES = ", ".join(f"({i}, '{c}', '{cur}', CAST({r} AS DECIMAL(10,4)))" for i, c, cur, r in RATES)

# One row per event with the fields of its JSON line; ok is false where the line is broken.
BASE = f"""
rates(idx, country, currency, rate) AS (VALUES {_RATES}),
e0 AS (
  SELECT e.event_id, e.user_id AS uid, epoch_us(e.ts) // 1000 AS ts, CAST(e.ts AS DATE) AS day,
         CASE e.event_type WHEN 'view' THEN 'search' WHEN 'purchase' THEN 'buy' ELSE e.event_type END AS behavior,
         CAST(json_extract(e.props, '$.k') AS INTEGER) AS k, e.value AS val,
         r.country, r.currency, r.rate
  FROM events e JOIN customer c ON c.c_custkey = e.user_id JOIN rates r ON r.idx = c.c_nationkey % 8
),
e1 AS (
  SELECT event_id, ts, behavior, country, currency, rate,
         'U' || (1000 + uid) AS user_id, CAST(event_id AS VARCHAR) AS eid,
         'S' || uid || '-' || CAST(day AS VARCHAR) AS session_id, 'TEMU_' || country AS site,
         CASE WHEN behavior IN ('click', 'buy') THEN 'ITEM-' || (10000 + k) ELSE '' END AS item,
         CASE WHEN behavior = 'search' THEN 'kw_' || (k % 20) ELSE '' END AS term,
         CASE WHEN event_id % 13 <> 0 THEN 18 + uid % 42 END AS age,
         CASE WHEN event_id % 17 <> 0 THEN
           CASE uid % 4 WHEN 0 THEN 'Bronze' WHEN 1 THEN 'Silver' WHEN 2 THEN 'Gold' ELSE 'Diamond' END END AS level,
         CAST(CASE WHEN behavior = 'buy' THEN val ELSE 0 END AS DECIMAL(12,2)) AS price,
         ts + CASE WHEN event_id % 10 = 0 THEN event_id % 5000 ELSE 0 END AS arrival,
         event_id % 97 <> 0 AS ok
  FROM e0
),
e AS (SELECT *, CAST(price * rate AS DECIMAL(18,6)) AS cny FROM e1),
b AS (SELECT * FROM e WHERE ok),
lines AS (
  SELECT *, CASE WHEN ok THEN line ELSE left(line, length(line) - 1) END AS value FROM (
    SELECT *, '{{"userId":"' || user_id || '","eventId":"' || eid || '","sessionId":"' || session_id
      || '","countryCode":"' || country || '","siteId":"' || site || '","behavior":"' || behavior
      || '","itemId":"' || item || '","searchTerm":"' || term || '"'
      || CASE WHEN age IS NULL THEN '' ELSE ',"age":' || age END
      || CASE WHEN level IS NULL THEN '' ELSE ',"level":"' || level || '"' END
      || ',"price":' || CAST(price AS VARCHAR) || ',"currency":"' || currency
      || '","priceCNY":' || CAST(cny AS VARCHAR) || ',"ts":' || ts || '}}' AS line FROM e)
)
"""


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([BASE, *ctes]) + body


def _gmv(size_ms: int) -> str:
    return f"""gmv AS (
  SELECT ts // {size_ms} * {size_ms} AS window_start, ts // {size_ms} * {size_ms} + {size_ms} AS window_end,
         SUM(cny) AS total
  FROM b WHERE behavior = 'buy' GROUP BY 1, 2)"""


def _slide(name: str, key: str, where: str, size_ms: int, slide_ms: int, value: str = "COUNT(*) AS n") -> str:
    """Windows holding t end at the slide borders in (t, t + size]."""
    return f"""{name} AS (
  SELECT {key + ' AS word, ' if key else ''}(ts // {slide_ms} + 1 + o.i) * {slide_ms} AS window_end, {value}
  FROM b, range({size_ms // slide_ms}) AS o(i) WHERE {where} GROUP BY {'1, 2' if key else '1'})"""


def _hot(size_ms: int, slide_ms: int) -> str:
    return _slide("hot", "term", "behavior = 'search'", size_ms, slide_ms)


_TOP = """top AS (
  SELECT window_end, word, n, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY window_end ORDER BY n DESC, word) AS rank FROM hot) WHERE rank <= 3)"""
_REPORT = """report AS (
  SELECT window_end, 'Hot search ' || strftime(make_timestamp(window_end * 1000), '%Y-%m-%d %H:%M:%S') || chr(10)
    || string_agg('Top ' || rank || ': ' || word || ' (' || n || ')', chr(10) ORDER BY rank) AS report
  FROM top GROUP BY window_end)"""

_30S = (30_000, 10_000)
_3H = (3 * 3_600_000, 3_600_000)


def _monitor(seconds: int) -> str:
    ms = seconds * 1000
    return f"""m AS (
  SELECT arrival // {ms} * {ms} AS window_start, COUNT(*) AS cnt, CAST(SUM(length(value)) AS BIGINT) AS chars,
         CAST(COALESCE(SUM(cny) FILTER (ok AND behavior = 'buy'), 0) AS DOUBLE) AS gmv,
         COUNT(*) FILTER (ok AND behavior = 'search') AS searches,
         COUNT(*) FILTER (ok AND behavior = 'click') AS clicks,
         COUNT(*) FILTER (ok AND behavior = 'buy') AS buys,
         GREATEST(COALESCE(MAX(arrival - ts) FILTER (ok), 0), 0) AS max_delay_ms
  FROM lines GROUP BY 1)"""


def _monitor_out(seconds: int, source: str = "m") -> str:
    return f"""
SELECT window_start, cnt, chars, gmv, searches, clicks, buys, max_delay_ms,
       cnt / {float(seconds)} AS qps, chars / 1024.0 / {float(seconds)} AS kb_per_s,
       CASE WHEN searches = 0 THEN 0.0 ELSE CAST(clicks AS DOUBLE) / searches * 100 END AS click_rate,
       CASE WHEN clicks = 0 THEN 0.0 ELSE CAST(buys AS DOUBLE) / clicks * 100 END AS buy_rate
FROM {source}"""


_FILLED = """filled AS (
  SELECT w.window_start, COALESCE(cnt, 0) AS cnt, COALESCE(chars, 0) AS chars, COALESCE(gmv, 0.0) AS gmv,
         COALESCE(searches, 0) AS searches, COALESCE(clicks, 0) AS clicks, COALESCE(buys, 0) AS buys,
         COALESCE(max_delay_ms, 0) AS max_delay_ms
  FROM (SELECT UNNEST(range((SELECT MIN(window_start) FROM m), (SELECT MAX(window_start) FROM m) + 1, 3600000))
        AS window_start) w LEFT JOIN m USING (window_start))"""


def _sessions(gap_ms: int) -> str:
    return f"""marks AS (
  SELECT *, CASE WHEN LAG(behavior) OVER w = 'buy' OR ts - LAG(ts) OVER w > {gap_ms} THEN 1 ELSE 0 END AS brk
  FROM b WINDOW w AS (PARTITION BY user_id ORDER BY ts, CASE WHEN behavior = 'buy' THEN 1 ELSE 0 END, eid)),
sess AS (
  SELECT *, CAST(1 + SUM(brk) OVER (PARTITION BY user_id
    ORDER BY ts, CASE WHEN behavior = 'buy' THEN 1 ELSE 0 END, eid) AS BIGINT) AS session_no FROM marks)"""


def _sessionize(gap_ms: int) -> str:
    return _with(
        """ SELECT user_id AS "userId", eid AS "eventId", ts AS event_ms, behavior, session_no FROM sess""",
        _sessions(gap_ms),
    )


def _session_windows(gap_ms: int) -> str:
    return _with(
        f"""
SELECT user_id AS "userId", MIN(ts) AS session_start, MAX(ts) + {gap_ms} AS session_end, COUNT(*) AS n_events
FROM (SELECT *, SUM(brk) OVER (PARTITION BY user_id ORDER BY ts, eid) AS no FROM (
  SELECT *, CASE WHEN ts - LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, eid) > {gap_ms} THEN 1 ELSE 0 END AS brk
  FROM b)) GROUP BY user_id, no"""
    )


_ARCHIVE = """ SELECT user_id, behavior, item AS item_id, ts, country AS country_code, site AS site_id,
 CAST(price AS DOUBLE) AS price, currency, CAST(CAST(make_timestamp(ts * 1000) AS DATE) AS VARCHAR) AS dt FROM b"""

_POSTINGS = r"""postings AS (
  SELECT lang, token, doc_id, COUNT(*) AS tf FROM (
    SELECT lang, doc_id, UNNEST(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS token FROM documents)
  WHERE token <> '' GROUP BY ALL)"""

_TERMS = ", ".join(f"'{t}'" for t in SEARCH_TERMS)


# Bound of a stream over all records: event time, or the arrival of a line that cannot be read.
_BOUND = "(SELECT MAX(CASE WHEN ok THEN ts ELSE arrival END) - 5000 FROM e)"


def _closed(inner: str, end: str = "window_end") -> str:
    """Windows a stream with a five-second bound has closed once all rows are read."""
    return f" SELECT * FROM ({inner}) WHERE {end} <= {_BOUND}"


_GMV_OUT = " SELECT window_start, window_end, CAST(total AS DOUBLE) AS gmv FROM gmv"
_TOP_OUT = " SELECT window_end, rank, word, n FROM top"
_OLAP = """ SELECT user_id, behavior AS event_type, item AS item_id, ts,
 CAST(COALESCE(age, 18) AS SMALLINT) AS age, COALESCE(level, 'Bronze') AS level, session_id FROM b"""


def _session_windows_closed(gap_ms: int) -> str:
    body = _session_windows(gap_ms)
    ctes = body[: body.index("\nSELECT user_id")]
    return ctes + _closed(body[len(ctes) :], "session_end")


def _pairs(reach: int, more: str = "") -> tuple[str, str, str]:
    return (
        """ SELECT item_id, CAST(rank AS INTEGER) AS rank, other_id, n FROM (
   SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY n DESC, other_id) AS rank FROM (
     SELECT item_id, other_id, COUNT(*) AS n FROM (
       SELECT item AS item_id, other AS other_id FROM near UNION ALL SELECT other, item FROM near)
     GROUP BY 1, 2)) WHERE rank <= 10""",
        """touched AS (
  SELECT user_id, item, ts, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts, eid) AS place
  FROM b WHERE behavior IN ('click', 'buy'))""",
        f"""near AS (
  SELECT a.item, b.item AS other FROM touched a JOIN touched b
  ON a.user_id = b.user_id AND b.place BETWEEN a.place - {reach} AND a.place - 1 AND a.item <> b.item{more})""",
    )


def all_oracles() -> dict[str, str]:
    batch = _batch()
    same = ("parse_behavior", "event_time_fallback", "raw_events", "currency_to_cny")
    return batch | _streams() | {f"stream_{name}": batch[name] for name in same}


def _streams() -> dict[str, str]:
    online = _slide("online", "", "TRUE", 300_000, 60_000, "COUNT(DISTINCT user_id) AS users")
    return {
        "stream_hot_word_counts": _with(_closed(" SELECT word, window_end, n FROM hot"), _hot(*_30S)),
        "stream_hot_search_chained": _with(_closed(_TOP_OUT), _hot(*_3H), _TOP),
        "stream_online_users": _with(_closed(" SELECT window_end, users FROM online"), online),
        "stream_session_windows": _session_windows_closed(WIDE_GAP_MS),
        "stream_sessionize": f"{_sessionize(300_000)} WHERE ts < {_BOUND}",
        "olap_table": _with(_OLAP),
        "stream_olap_rows_once": _with(_OLAP),
        "kept_cube": _batch()["gmv_cube"],
        "stream_monitor_filled": _with(
            f" SELECT * FROM ({_monitor_out(3600, 'filled')}) WHERE window_start <= (SELECT MAX(window_start) FROM m"
            " WHERE window_start + 3600000 <= (SELECT MAX(arrival) - 5000 FROM e))",
            _monitor(3600), _FILLED,
        ),
        "dwd_table": _with(_ARCHIVE),
    }


def _batch() -> dict[str, str]:
    found = {
        "parse_behavior": _with(
            """ SELECT user_id AS "userId", eid AS "eventId", session_id AS "sessionId", country AS "countryCode",
 site AS "siteId", behavior, item AS "itemId", term AS "searchTerm", CAST(age AS INTEGER) AS age, level,
 CAST(price AS DOUBLE) AS price, currency, CAST(cny AS DOUBLE) AS "priceCNY", ts, ts AS event_ms FROM b"""
        ),
        "event_time_fallback": _with(
            """ SELECT user_id, arrival AS arrival_ms, CASE WHEN ok THEN ts ELSE arrival END AS event_ms,
 NOT ok AS used_arrival FROM e"""
        ),
        "reject_report": _with(
            """ SELECT CASE WHEN NOT ok THEN 'malformed' WHEN behavior NOT IN ('search', 'click', 'buy')
 THEN 'unknown_behavior' ELSE 'ok' END AS reason, COUNT(*) AS n FROM e GROUP BY 1"""
        ),
        "reject_outcomes": _with(
            """ SELECT CASE WHEN NOT ok THEN 'malformed' WHEN event_id % 89 = 1 THEN 'missing_user'
 WHEN event_id % 83 = 2 THEN 'bad_ts' WHEN behavior NOT IN ('search', 'click', 'buy') THEN 'unknown_behavior'
 WHEN event_id % 79 = 3 AND behavior = 'buy' THEN 'bad_price' ELSE 'ok' END AS reason, COUNT(*) AS n FROM e GROUP BY 1"""
        ),
        "gmv_tumbling": _with(_GMV_OUT, _gmv(5000)),
        "gmv_tumbling_1h": _with(_GMV_OUT, _gmv(3_600_000)),
        "gmv_report": _with(
            """ SELECT window_end, 'GMV (CNY): ' || CAST(CAST(ROUND(total, 2) AS DECIMAL(28,2)) AS VARCHAR) AS line
 FROM gmv""",
            _gmv(5000),
        ),
        "hot_word_counts": _with(" SELECT word, window_end, n FROM hot", _hot(*_30S)),
        "hot_word_counts_3h": _with(" SELECT word, window_end, n FROM hot", _hot(*_3H)),
        "hot_word_counter": _with(" SELECT COUNT(*) AS total_search_count FROM hot", _hot(*_30S)),
        "hot_search_topn": _with(_TOP_OUT, _hot(*_30S), _TOP),
        "hot_search_topn_3h": _with(_TOP_OUT, _hot(*_3H), _TOP),
        "hot_search_report": _with(" SELECT window_end, report FROM report", _hot(*_3H), _TOP, _REPORT),
        "hot_search_latest": _with(
            """ SELECT 'last_hot_search_result' AS field, window_end, report FROM report
 WHERE window_end = (SELECT MAX(window_end) FROM report)""",
            _hot(*_30S), _TOP, _REPORT,
        ),
        "hot_search_by_rank": _with(
            """ SELECT 'Top ' || rank AS field, arg_max('Top ' || rank || ': ' || word || ' (' || n || ')', window_end)
 AS line FROM top GROUP BY rank""",
            _hot(*_3H), _TOP,
        ),
        "olap_rows": _with(_OLAP),
        "dwd_rows": _with(_ARCHIVE),
        "dwd_rows_sql": _with(_ARCHIVE),
        "dwd_partition_commits": _with(
            f""" SELECT dt, COUNT(*) AS n, MIN(arrival) AS first_arrival, MIN(arrival) + 60000 AS commit_ts,
 MIN(arrival) + 60000 <= {AS_OF_MS} AS committed
 FROM (SELECT *, CAST(CAST(make_timestamp(ts * 1000) AS DATE) AS VARCHAR) AS dt FROM b) GROUP BY dt"""
        ),
        "raw_events": _with(" SELECT CASE WHEN ok THEN eid ELSE sha256(value) END AS event_id, value FROM lines"),
        "behavior_to_kafka": _with(
            """ SELECT user_id AS key, eid AS "eventId", behavior, item AS "itemId", CAST(age AS INTEGER) AS age, level,
 CAST(cny AS DOUBLE) AS "priceCNY", ts FROM b"""
        ),
        "monitor_intervals": _with(_monitor_out(2), _monitor(2)),
        "monitor_intervals_1h": _with(_monitor_out(3600, "filled"), _monitor(3600), _FILLED),
        "funnel_rates": _with(
            """ SELECT grp, searches, clicks, buys,
 CASE WHEN searches = 0 THEN 0.0 ELSE CAST(clicks AS DOUBLE) / searches * 100 END AS click_rate,
 CASE WHEN clicks = 0 THEN 0.0 ELSE CAST(buys AS DOUBLE) / clicks * 100 END AS buy_rate
 FROM (SELECT country AS grp, COUNT(*) FILTER (behavior = 'search') AS searches,
   COUNT(*) FILTER (behavior = 'click') AS clicks, COUNT(*) FILTER (behavior = 'buy') AS buys
   FROM b GROUP BY 1)"""
        ),
        "lateness_profile": _with(
            """ SELECT day, COUNT(*) AS n, COUNT(*) FILTER (arrival > ts) AS delayed,
 COUNT(*) FILTER (ts < newest) AS out_of_order, COUNT(*) FILTER (arrival - ts > 5000) AS beyond_bound,
 MAX(GREATEST(arrival - ts, 0)) AS max_delay_ms,
 CAST(COUNT(*) FILTER (ts < newest) AS DOUBLE) / COUNT(*) AS out_of_order_share
 FROM (SELECT *, CAST(CAST(make_timestamp(arrival * 1000) AS DATE) AS VARCHAR) AS day,
   MAX(ts) OVER (PARTITION BY user_id ORDER BY arrival, eid
     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM b) GROUP BY day"""
        ),
        "lateness_profile_global": _with(
            """ SELECT day, COUNT(*) AS n, COUNT(*) FILTER (arrival > ts) AS delayed,
 COUNT(*) FILTER (ts < newest) AS out_of_order, COUNT(*) FILTER (arrival - ts > 5000) AS beyond_bound,
 MAX(GREATEST(arrival - ts, 0)) AS max_delay_ms,
 CAST(COUNT(*) FILTER (ts < newest) AS DOUBLE) / COUNT(*) AS out_of_order_share
 FROM (SELECT *, CAST(CAST(make_timestamp(arrival * 1000) AS DATE) AS VARCHAR) AS day,
   MAX(ts) OVER (ORDER BY arrival, eid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest FROM b) GROUP BY day"""
        ),
        "backlog_alarm": _with(
            """ SELECT window_start, cnt, max_delay_ms, cnt / 2.0 AS qps,
 CASE WHEN max_delay_ms >= 4000 THEN 'delay' ELSE 'rate' END AS reason
 FROM m WHERE max_delay_ms >= 4000 OR cnt / 2.0 >= 0.9""",
            _monitor(2),
        ),
        "currency_to_cny": _with(
            """ SELECT eid AS "eventId", country AS "countryCode", site AS site_id, currency,
 CAST(price AS DOUBLE) AS price, CAST(cny AS DOUBLE) AS price_cny FROM b WHERE behavior = 'buy'"""
        ),
        "gmv_by_day_country": _with(
            """ SELECT CAST(CAST(make_timestamp(ts * 1000) AS DATE) AS VARCHAR) AS dt, country AS country_code,
 COUNT(*) AS buys, CAST(SUM(cny) AS DOUBLE) AS gmv FROM b WHERE behavior = 'buy' GROUP BY 1, 2"""
        ),
        "profile_enrich": _with(
            """ SELECT b.user_id AS "userId", eid AS "eventId",
 CAST(COALESCE(p.age, b.age, 18) AS INTEGER) AS age, COALESCE(p.level, b.level, 'Bronze') AS level,
 p.user_id IS NOT NULL AS has_profile
 FROM b LEFT JOIN (
   SELECT 'U' || (c_custkey + 1000) AS user_id, c_custkey % 42 + 18 AS age,
     CASE WHEN c_acctbal < 0 THEN 'Bronze' WHEN c_acctbal < 3000 THEN 'Silver'
          WHEN c_acctbal < 6000 THEN 'Gold' ELSE 'Diamond' END AS level
   FROM customer) p ON p.user_id = b.user_id"""
        ),
        "sessionize": _sessionize(300_000),
        "sessionize_12h": _sessionize(WIDE_GAP_MS),
        "session_windows": _session_windows(300_000),
        "session_windows_12h": _session_windows(WIDE_GAP_MS),
        "session_funnel": _with(
            """ SELECT COUNT(*) AS sessions, COUNT(*) FILTER (s) AS searched, COUNT(*) FILTER (c) AS clicked,
 COUNT(*) FILTER (p) AS bought FROM (
   SELECT user_id, session_no, BOOL_OR(behavior = 'search') AS s,
     BOOL_OR(behavior = 'click' AND ts >= first_search) AS c,
     BOOL_OR(behavior = 'buy' AND ts >= first_click) AS p
   FROM (SELECT *, MIN(CASE WHEN behavior = 'click' AND ts >= first_search THEN ts END)
           OVER (PARTITION BY user_id, session_no) AS first_click
         FROM (SELECT *, MIN(CASE WHEN behavior = 'search' THEN ts END)
                 OVER (PARTITION BY user_id, session_no) AS first_search FROM sess))
   GROUP BY user_id, session_no)""",
            _sessions(WIDE_GAP_MS),
        ),
        "gmv_cube": _with(
            """ SELECT country, COALESCE(level, 'Bronze') AS level,
 CAST(GROUPING(country) * 2 + GROUPING(COALESCE(level, 'Bronze')) AS INTEGER) AS gid,
 CAST(COALESCE(SUM(cny) FILTER (behavior = 'buy'), 0) AS DOUBLE) AS gmv,
 COUNT(*) FILTER (behavior = 'buy') AS buys, COUNT(DISTINCT user_id) AS users
 FROM b GROUP BY CUBE (country, COALESCE(level, 'Bronze'))"""
        ),
        "online_users": _with(
            " SELECT window_end, users FROM online",
            _slide("online", "", "TRUE", 300_000, 60_000, "COUNT(DISTINCT user_id) AS users"),
        ),
        "daily_users_sketch": _with(
            """ SELECT (ts // 86400000 + 1) * 86400000 AS window_end, COUNT(DISTINCT user_id) AS users FROM b GROUP BY 1"""
        ),
        "hot_products_topn": _with(
            """ SELECT window_end, CAST(rank AS INTEGER) AS rank, word AS item_id, n FROM (
 SELECT *, ROW_NUMBER() OVER (PARTITION BY window_end ORDER BY n DESC, word) AS rank FROM hot) WHERE rank <= 10""",
            _slide("hot", "item", "behavior IN ('click', 'buy')", 3_600_000, 600_000),
        ),
        "sales_ranking": _with(
            """ SELECT country AS "countryCode", CAST(rank AS INTEGER) AS rank, item AS item_id, buys,
 CAST(amount AS DOUBLE) AS amount FROM (
   SELECT *, ROW_NUMBER() OVER (PARTITION BY country ORDER BY buys DESC, amount DESC, item) AS rank FROM (
     SELECT country, item, COUNT(*) AS buys, SUM(cny) AS amount FROM b WHERE behavior = 'buy' GROUP BY 1, 2))
 WHERE rank <= 10"""
        ),
        "user_profile": _with(
            """ SELECT u.user_id AS "userId", searches, clicks, buys, spend, last_seen, item AS favourite_item FROM (
   SELECT user_id, COUNT(*) FILTER (behavior = 'search') AS searches,
     COUNT(*) FILTER (behavior = 'click') AS clicks, COUNT(*) FILTER (behavior = 'buy') AS buys,
     CAST(COALESCE(SUM(cny) FILTER (behavior = 'buy'), 0) AS DOUBLE) AS spend, MAX(ts) AS last_seen
   FROM b GROUP BY user_id) u
 LEFT JOIN (
   SELECT user_id, item, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, item) AS rn
   FROM b WHERE behavior IN ('click', 'buy') GROUP BY user_id, item) f
 ON f.user_id = u.user_id AND f.rn = 1"""
        ),
        "item_cooccurrence": _with(
            """ SELECT item_id, CAST(rank AS INTEGER) AS rank, other_id, n FROM (
   SELECT *, ROW_NUMBER() OVER (PARTITION BY item_id ORDER BY n DESC, other_id) AS rank FROM (
     SELECT item_id, other_id, COUNT(*) AS n FROM (
       SELECT item AS item_id, prev AS other_id FROM steps UNION ALL SELECT prev, item FROM steps)
     GROUP BY 1, 2)) WHERE rank <= 10""",
            """steps AS (SELECT * FROM (
  SELECT item, LAG(item) OVER (PARTITION BY user_id ORDER BY ts, eid) AS prev
  FROM b WHERE behavior IN ('click', 'buy')) WHERE prev <> item)""",
        ),
        "item_pairs": _with(*_pairs(3)),
        "item_pairs_12h": _with(*_pairs(5, f" AND a.ts - b.ts <= {WIDE_GAP_MS}")),
        "inverted_index": f"""WITH {_POSTINGS}
SELECT lang, token, doc_id, tf, COUNT(*) OVER (PARTITION BY lang, token) AS df FROM postings""",
        "search_documents": f"""WITH {_POSTINGS},
found AS (SELECT * FROM postings WHERE token IN ({_TERMS})),
w AS (SELECT f.lang, token, CAST(ROUND(LN((total + 1) / CAST(df + 1 AS DOUBLE)), 6) AS DECIMAL(12,6)) AS idf
  FROM (SELECT lang, token, COUNT(*) AS df FROM found GROUP BY 1, 2) f
  JOIN (SELECT lang, COUNT(*) AS total FROM documents GROUP BY 1) s ON s.lang = f.lang)
SELECT lang, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS DOUBLE) AS score FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY lang ORDER BY score DESC, doc_id) AS rank FROM (
    SELECT f.lang, doc_id, SUM(tf * idf) AS score FROM found f JOIN w ON w.lang = f.lang AND w.token = f.token
    GROUP BY 1, 2)) WHERE rank <= 10""",
        "stream_gmv_tumbling": _with(_closed(_GMV_OUT), _gmv(5000)),
        "stream_hot_search_topn": _with(_closed(_TOP_OUT), _hot(*_30S), _TOP),
        "stream_olap_rows": _with(_OLAP),
        "stream_dwd_rows": _with(_ARCHIVE),
        "stream_monitor_intervals": _with(
            f" SELECT * FROM ({_monitor_out(3600)}) WHERE window_start + 3600000 <= (SELECT MAX(arrival) - 5000 FROM e)",
            _monitor(3600),
        ),
    }
    same = {"search_stored_index": "search_documents", "online_users_sketch": "online_users"}
    return found | {name: found[other] for name, other in same.items()}
