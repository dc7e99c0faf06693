"""SQL for the operators that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from clickpulse.llm import quality_rules


def _quality_rules() -> str:
    stops = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)
    ratio = {
        "mean_word_chars": "word_chars / n_words",
        "symbols_per_word": "n_symbols / n_words",
        "capital_ratio": "n_capitals / n_letters",
        "stop_word_ratio": "n_stop_words / n_words",
        "dup_line_ratio": "n_dup_lines / n_lines",
        "mean_line_words": "n_words / n_lines",
    }
    broken = []
    for rule in quality_rules.RULES:
        value = f"coalesce({ratio[rule.measure]}, 0)"
        tests = [f"{value} < {rule.least}"] if rule.least is not None else []
        tests += [f"{value} > {rule.most}"] if rule.most is not None else []
        broken.append(f"(n_words >= {rule.from_words} AND ({' OR '.join(tests)}))")
    return rf"""
    WITH split AS (
      SELECT doc_id, coalesce(text, '') AS body,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
      FROM documents),
    windows AS (
      SELECT doc_id, i, list_slice(words, i, i + 4) AS w
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split)),
    twice AS (
      SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, w) > 1),
    covered AS (
      SELECT doc_id, count(DISTINCT i + k)::BIGINT AS n
      FROM (SELECT doc_id, i, unnest(range(0, 5)) AS k FROM twice) GROUP BY doc_id),
    measures AS (
      SELECT s.doc_id, len(words)::BIGINT AS n_words,
             len(array_to_string(words, ''))::BIGINT AS word_chars,
             len(regexp_replace(body, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(c.n, 0)::BIGINT AS n_repeat_words,
             len(lines) AS n_lines,
             len(list_filter(words, lambda w: lower(w) IN ({stops}))) AS n_stop_words,
             len(regexp_replace(body, '[^\p{{L}}]', '', 'g')) AS n_letters,
             len(regexp_replace(body, '[^\p{{Lu}}]', '', 'g')) AS n_capitals
      FROM split s LEFT JOIN covered c USING (doc_id)),
    based AS (
      SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measures)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR {" OR ".join(broken)}) AS kept
    FROM based
    """


def _url_filters() -> str:
    """Rules by CASE; aliases by absolute canonical links, followed both ways by a recursive query."""

    def host(url: str) -> str:
        return f"lower(regexp_extract(coalesce({url}, ''), '^(?s:.*?)://([^/?#]*)', 1))"

    def path(url: str) -> str:
        return f"regexp_extract(coalesce({url}, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1)"

    # The rules of the contract, longest first.
    rules = (
        ("allow", "www.example.com", "/en/"),
        ("block", "example.com", "/en/"),
        ("block", "net", "/es/"),
        ("block", "net", "/fr/"),
        ("allow", "com", "/"),
    )

    def case(value: int) -> str:
        tests = "".join(
            f" WHEN ('.' || host) LIKE '%.{h}' AND starts_with(path, '{p}') THEN '{(v, h + p)[value]}'"
            for v, h, p in rules
        )
        return f"CASE{tests} END"

    address = f"""lower(regexp_extract(url, '^(.*?)://', 1)) || '://' || {host("url")} ||
        coalesce(nullif(regexp_extract(url, '^.*?://[^/?#]*([^#]*)', 1), ''), '/')"""
    return f"""
    WITH RECURSIVE judged AS (
      SELECT page_id, url, host, path, {case(1)} AS rule, {case(0)} AS own
      FROM (SELECT page_id, url, {host("url")} AS host, {path("url")} AS path FROM pages)),
    pairs AS (
      SELECT source, target FROM (
        SELECT {address} AS source, {address.replace("url", "link")} AS target
        FROM (SELECT url, regexp_extract(html, '<link rel="canonical" href="([^"]*)"', 1) AS link FROM pages)
        WHERE link LIKE '%://%' AND url LIKE '%://%')
      WHERE source <> target),
    links AS (SELECT source AS a, target AS b FROM pairs UNION SELECT target, source FROM pairs),
    reach AS (
      SELECT a, a AS b FROM links
      UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
    shared AS (
      SELECT a, min(own) AS verdict
      FROM (SELECT a, {case(0)} AS own FROM (SELECT a, {host("b")} AS host, {path("b")} AS path FROM reach)
            UNION ALL
            SELECT a, own FROM reach JOIN (SELECT {address} AS address, own FROM judged WHERE url LIKE '%://%') ON b = address)
      GROUP BY a)
    SELECT page_id, host, path, rule, coalesce(own, s.verdict, 'allow') AS verdict
    FROM (SELECT *, CASE WHEN url LIKE '%://%' THEN {address} END AS address FROM judged) j
    LEFT JOIN shared s ON s.a = j.address
    """


def llm_oracles() -> dict[str, str]:
    return {"op3_url_filters": _url_filters(), "op5_quality_rules": _quality_rules()}
