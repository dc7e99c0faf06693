"""Quality rules: a table of thresholds compiled into one projection, without user functions."""

from __future__ import annotations

from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
BLANK = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

# Very common words of the four languages of the corpus.
STOP_WORDS = (
    "the of and to in is it that for on with as was are be this an at by or "
    "der die das und ist in zu den von mit sich des auf für im dem nicht ein eine als "
    "le la les de des du et un une en est que qui pour dans par sur au pas avec "
    "el los las y en que del se por con una su para es al lo como"
).split()


class Rule(NamedTuple):
    """Rejects a text whose ``measure`` is below ``least`` or above ``most``, from ``from_words`` words on."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None
    from_words: int = 0


#: Lengths, symbols, stop words and lines. Ratios are of words, of characters in words, or of lines.
RULES = (
    Rule("word_length", "mean_word_chars", 2.0, 14.0, 10),
    Rule("symbols", "symbols_per_word", most=0.25, from_words=10),
    Rule("capitals", "capital_ratio", most=0.6, from_words=10),
    Rule("stop_words", "stop_word_ratio", least=0.002, from_words=200),
    Rule("duplicate_lines", "dup_line_ratio", most=0.5, from_words=10),
    Rule("words_per_line", "mean_line_words", least=1.2, from_words=50),
)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def _window_hashes(words: Column) -> Column:
    count = F.size(words) - (WINDOW - 1)
    starts = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(WINDOW))))


def _repeated_words(hashes: Column) -> Column:
    """Words that lie in a window of five which occurs twice or more in the text.

    Windows count as equal if their 64-bit hashes are; the words aren't looked at again, so two different
    windows of one text are taken for equal once in some 2 ** 64 pairs of windows. Most texts repeat
    none, which a distinct count of the hashes shows. For the
    others the hashes are sorted, so that equal ones are neighbours; no pairs are made.
    """
    order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = F.transform(F.array(order), lambda s: _covered(F.array_sort(_twice(s)))).getItem(0)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), found).otherwise(F.lit(0).cast("bigint"))


def _twice(windows: Column) -> Column:
    def again(x: Column, k: Column) -> Column:
        return (F.get(windows, k - 1)["h"] == x["h"]) | (F.get(windows, k + 1)["h"] == x["h"])

    return F.transform(F.filter(windows, lambda x, k: F.coalesce(again(x, k), F.lit(False))), lambda x: x["i"])


def _covered(starts: Column) -> Column:
    """Words covered by windows at these rising starts: each adds what the one before does not cover."""
    fold = F.aggregate(
        starts,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last")),
        lambda acc, i: F.struct(
            (acc["n"] + F.least(i - acc["last"], F.lit(WINDOW))).cast("bigint").alias("n"), i.alias("last")
        ),
    )
    return fold["n"]


def measured(documents: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``documents`` and a struct ``measures``. A null text counts as empty, ratios of nothing as 0."""
    ready = documents.withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    ready = ready.withColumn("__words", _words(F.col("__text")))
    ready = ready.withColumn(
        "__lines", F.filter(F.split("__text", "\n"), lambda x: F.length(F.translate(x, BLANK, "")) > 0)
    )
    ready = ready.withColumn("__joined", F.translate("__text", BLANK, ""))
    ready = ready.withColumn("__hashes", _window_hashes(F.col("__words")))
    ready = ready.withColumn("__letters", F.regexp_replace("__joined", r"[^\p{L}]+", ""))
    n_words, n_lines = F.size("__words").cast("bigint"), F.size("__lines").cast("bigint")
    symbols = F.char_length("__joined") - F.char_length(F.translate("__joined", SYMBOLS, ""))
    stops = F.size(F.filter("__words", lambda w: F.lower(w).isin(STOP_WORDS)))
    measures = F.struct(
        n_words.alias("n_words"),
        F.char_length("__joined").cast("bigint").alias("word_chars"),
        symbols.cast("bigint").alias("n_symbols"),
        (n_lines - F.size(F.array_distinct("__lines"))).cast("bigint").alias("n_dup_lines"),
        _repeated_words(F.col("__hashes")).alias("n_repeat_words"),
        n_lines.alias("n_lines"),
        stops.cast("bigint").alias("n_stop_words"),
        F.char_length("__letters").cast("bigint").alias("n_letters"),
        F.char_length(F.regexp_replace("__letters", r"[^\p{Lu}]+", "")).cast("bigint").alias("n_capitals"),
    )
    helpers = ("__text", "__words", "__lines", "__joined", "__hashes", "__letters")
    # out of a one-element array, so that a filter on the verdict stays above and measures nothing again
    return ready.withColumn("measures", F.explode(F.array(measures))).drop(*helpers)


def _ratios(m: Column) -> dict[str, Column]:
    def per(a: str, b: str) -> Column:
        return F.when(m[b] > 0, m[a] / m[b]).otherwise(F.lit(0.0))

    return {
        "mean_word_chars": per("word_chars", "n_words"),
        "symbols_per_word": per("n_symbols", "n_words"),
        "capital_ratio": per("n_capitals", "n_letters"),
        "stop_word_ratio": per("n_stop_words", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_lines"),
        "mean_line_words": per("n_words", "n_lines"),
    }


def judge(documents: DataFrame, rules: Iterable[Rule] = RULES, text: str = "text") -> DataFrame:
    """Adds ``measures``, ``base_failed``, ``failed_rules`` (names, in table order) and ``kept``.

    One row for each row of ``documents``, repeated and null rows included, in one projection over
    one scan. A null text counts as empty and fails the base rule. Columns of ``documents`` stay;
    one that is called like an added column gives way to it.
    """
    m = F.col("measures")
    ratios = _ratios(m)
    broken = []
    for rule in rules:
        value = ratios[rule.measure]
        out = F.lit(False)
        if rule.least is not None:
            out = out | (value < rule.least)
        if rule.most is not None:
            out = out | (value > rule.most)
        broken.append(F.when(out & (m["n_words"] >= rule.from_words), F.lit(rule.name)))
    rows = measured(documents, text)
    rows = rows.withColumn("base_failed", (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"]))
    rows = rows.withColumn("failed_rules", F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>"))
    return rows.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
