"""Quality rules against plain counts."""

from __future__ import annotations

import re
from collections import Counter

from clickpulse.llm import quality_rules as qr
from clickpulse.llm.queries import op5_quality_rules

TEXTS = [
    None,
    "",
    " \n\t ",
    "one two three",
    "the quick brown fox and the lazy dog were in the garden of a house",
    "a b c d e f a b c d e g a b c d e",
    "x x x x x x x x x x x x",
    "same line here\nsame line here\n\n \nother line and the rest of it is fine for now",
    "EVERY SINGLE WORD HERE IS WRITTEN IN LOUD CAPITALS FOR NO GOOD REASON AT ALL",
    "a*** b&&& c$$$ d%%% e### f||| g<<< h>>> i*** j&&& k$$$ l%%%",
    "é\x0bü\x0cö\r\nñ 🔥🔥 the and of it is in to a for as",
    "w" * 100_000 + " the",
    " ".join(f"w{i % 7}" for i in range(3000)),
    " ".join(f"word{i}" for i in range(400)),
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    many = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if many[w] > 1 for k in range(5)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def test_query_matches_plain_counts(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    rows = {r["doc_id"]: r.asDict() for r in op5_quality_rules(spark, str(tmp_path)).collect()}
    assert len(rows) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        want = plain(text)
        assert {k: rows[i][k] for k in want} == want, i
        assert rows[i]["base_failed"] == (want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"])
        assert not (rows[i]["base_failed"] and rows[i]["kept"])
    kept = {i for i, r in rows.items() if r["kept"]}
    assert {4, 7} <= kept and not kept & {8, 9, 10, 13}


def test_failed_rules_are_named_and_filters_measure_once(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    failed = {r["doc_id"]: r["failed_rules"] for r in qr.judge(df).collect()}
    assert failed[8] == ["capitals"] and failed[9] == ["symbols"] and failed[13] == ["stop_words"] and failed[4] == []
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for d in (qr.judge(df), qr.judge(df).where("kept"))]
    assert plans[0].count("array_sort") == plans[1].count("array_sort") > 0


def test_repeats_clashing_columns_and_empty_tables(spark):
    schema = "doc_id long, text string, kept string, measures int"
    df = spark.createDataFrame([(None, TEXTS[4], "x", 1)] * 3, schema)
    rows = qr.judge(df).collect()
    assert len(rows) == 3 and all(r["kept"] is True for r in rows)
    assert qr.judge(df.limit(0)).count() == 0
    assert qr.judge(df, rules=()).where("kept").count() == 3
