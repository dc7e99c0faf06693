"""Secret scans with built-in expressions only: three patterns and a sliding entropy test.

A pattern's matches come from ``regexp_extract_all`` and their places from ``split`` by the same
pattern: the gaps before the matches and the matches themselves add up to offsets. The entropy test
slides a window over each candidate string and keeps the sum of c * log2(c) over the window's
character counts; a step changes it by the counts of the two characters that enter and leave. Secret windows
that touch are one span.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: A run shorter than the least length never counts, so the search may start at long runs.
LONG_HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
SEGMENT = 256


class CharacterClass(NamedTuple):
    """Windows of ``width`` characters that all match ``only`` and ``having`` count as secret from ``bits`` on."""

    name: str
    only: str
    having: str
    width: int
    bits: float


#: Words give windows of mixed letters and digits too, but hold longer runs of letters, fewer digits, or all of them
#: in one place. The bits are what nearly all random keys reach in a window and such names don't.
CLASSES = (
    CharacterClass("hex", r"^[0-9A-Fa-f]+$", r"[0-9].*[A-Fa-f]|[A-Fa-f].*[0-9]", 20, 2.9),
    CharacterClass(
        "base64",
        r"^[A-Za-z0-9+/_=-]+$",
        r"^(?=.*[A-Z])(?=.*[a-z])(?=.*[0-9][^0-9].*[0-9])(?!.*[a-z]{6})(?!.*[A-Z]{6})",
        20,
        3.8,
    ),
    CharacterClass("lower", r"^[a-z0-9]+$", r"^(?=(?:.*[0-9]){4})(?=.*[0-9][a-z].*[0-9][a-z])(?!.*[a-z]{8})", 20, 3.7),
)
_WORD, _UUID = r"example|sample|placeholder|your[_-]?key", r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}"
#: Where a stand-in for a secret starts, or a part of a UUID, which is longer than a window.
_STARTS = rf"(?i:{_WORD}|{_UUID}|(?:-[0-9a-f]{{4}}){{2}}-|-[0-9a-f]{{4}}-[0-9a-f]{{12}})|(.)\1{{7}}"
_ENDS = "".join(f"(?<!(?i:{x}))" for x in ("example", "sample", "placeholder", "yourkey", "your_key", "your-key", _UUID))
#: Candidates that match one of these are no secrets: without letters, or with stand-ins that leave no
#: window's length of other characters in a row. They never remove a pattern's span.
ALLOWED = (
    r"^[0-9/_=+-]+$",
    rf"^(?!.*?(?:(?!{_STARTS}).{_ENDS}){{20}})",
)

SPAN = "array<struct<start:bigint,kind_no:int,end:bigint>>"


def _before(lengths: Column) -> Column:
    """Sum of all earlier elements, for each element, in about n * sqrt(n) steps."""
    width = F.ceil(F.sqrt(F.greatest(F.size(lengths), F.lit(1)))).cast("int")
    blocks = F.ceil(F.size(lengths) / width).cast("int")

    def total(values: Column) -> Column:
        return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)

    sums = F.transform(F.sequence(F.lit(0), blocks - 1), lambda b: total(F.slice(lengths, b * width + 1, width)))

    def inside(b: Column, base: Column) -> Column:
        part = F.slice(lengths, b * width + 1, width)
        return F.transform(part, lambda _, i: base + total(F.slice(lengths, b * width + 1, i)))

    def block(s: Column) -> Column:
        return F.flatten(
            F.transform(
                F.transform(s, lambda _, b: F.struct(b.alias("b"), total(F.slice(s, 1, b)).alias("base"))),
                lambda x: inside(x["b"], x["base"]),
            )
        )

    return F.when(F.size(lengths) > 0, F.transform(F.array(sums), block).getItem(0)).otherwise(
        F.array().cast("array<bigint>")
    )


def _matches(text: Column, pattern: str) -> Column:
    """``(hit, start)`` of each leftmost, non-overlapping match, in code points."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    steps = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(hits)),
        hits,
        lambda gap, hit: F.struct(
            F.length(gap).cast("bigint").alias("gap"), (F.length(gap) + F.length(hit)).cast("bigint").alias("step")
        ),
    )
    starts = F.transform(
        F.array(steps),
        lambda s: F.zip_with(_before(F.transform(s, lambda x: x["step"])), s, lambda at, x: at + x["gap"]),
    ).getItem(0)
    return F.zip_with(hits, starts, lambda hit, start: F.struct(hit.alias("hit"), start.alias("start")))


def _none() -> Column:
    return F.array().cast(SPAN)


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.struct(
        start.cast("bigint").alias("start"), F.lit(KINDS.index(kind)).alias("kind_no"), end.cast("bigint").alias("end")
    )


def _pattern_spans(text: Column, kind: str, pattern: str, keep, test: str) -> Column:
    found = F.filter(_matches(text, pattern), lambda m: keep(m["hit"]))
    spans = F.transform(found, lambda m: _span(kind, m["start"], m["start"] + F.length(m["hit"])))
    return F.when(text.rlike(test), spans).otherwise(_none())


def _weight(count: Column) -> Column:
    return F.when(count > 1, count * F.log2(count.cast("double"))).otherwise(F.lit(0.0))


def _count(window: Column, char: Column) -> Column:
    return F.length(window) - F.length(F.replace(window, char, F.lit("")))


def _secret_windows(segment: Column, kind: CharacterClass) -> Column:
    """Starts, from 0, of the windows of a segment whose entropy reaches the class's threshold."""
    w = kind.width
    least = F.lit(w * (math.log2(w) - kind.bits) + 1e-9)  # H = log2(w) - sum(c * log2 c) / w
    first = F.substring(segment, 1, w)
    start = F.aggregate(
        F.array_distinct(F.split(first, "")),
        F.lit(0.0),
        lambda s, c: s + _weight(_count(first, c)),
    )
    empty = F.array().cast("array<int>")

    def judged(weight: Column, window: Column, i: Column, found: Column) -> Column:
        good = (weight <= least) & window.rlike(kind.only) & window.rlike(kind.having)
        return F.when(good, F.array_append(found, i)).otherwise(found)

    def step(acc: Column, i: Column) -> Column:
        old, new = F.substring(segment, i, F.lit(w)), F.substring(segment, i + 1, F.lit(w))
        leaves, enters = F.substring(old, 1, 1), F.substring(new, w, 1)
        gone, come = _count(old, leaves), _count(new, enters)
        weight = F.when(leaves == enters, acc["weight"]).otherwise(
            acc["weight"] + _weight(gone - 1) - _weight(gone) + _weight(come) - _weight(come - 1)
        )
        return F.struct(weight.alias("weight"), judged(weight, new, i, acc["found"]).alias("found"))

    steps = F.when(
        F.length(segment) > w, F.sequence(F.lit(1), F.length(segment) - w)
    ).otherwise(empty)
    begin = F.transform(
        F.array(start),
        lambda s: F.struct(s.alias("weight"), judged(s, first, F.lit(0), empty).alias("found")),
    ).getItem(0)
    return F.when(F.length(segment) >= w, F.aggregate(steps, begin, step)["found"]).otherwise(empty)


def _entropy_of(candidate: Column, kinds: Sequence[CharacterClass]) -> Column:
    """Runs of secret windows of one candidate that touch or overlap, as (a, z)."""
    longest = max(k.width for k in kinds)
    parts = F.transform(
        F.sequence(F.lit(0), F.floor((F.length(candidate) - 1) / SEGMENT).cast("int")),
        lambda k: F.struct(
            (k * SEGMENT).alias("at"), F.substring(candidate, k * SEGMENT + 1, F.lit(SEGMENT + longest - 1)).alias("s")
        ),
    )

    def windows(kind: CharacterClass) -> Column:
        def within(part: Column) -> Column:
            return F.transform(
                _secret_windows(part["s"], kind),
                lambda i: F.struct((part["at"] + i).alias("a"), (part["at"] + i + kind.width).alias("z")),
            )

        return F.flatten(F.transform(parts, within))

    found = F.array_sort(F.concat(*(windows(k) for k in kinds)))

    def grown(runs: Column, w: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        longer = F.struct(last["a"].alias("a"), F.greatest(last["z"], w["z"]).alias("z"))
        touches = F.coalesce(last["z"] >= w["a"], F.lit(False))
        return F.when(touches, F.array_append(F.slice(runs, 1, F.size(runs) - 1), longer)).otherwise(F.array_append(runs, w))

    return F.aggregate(found, F.array().cast("array<struct<a:int,z:int>>"), grown)


def _entropy_spans(text: Column, kinds: Sequence[CharacterClass], allowed: Sequence[str]) -> Column:
    def suspicious(hit: Column) -> Column:
        test = hit.rlike("[0-9]") & hit.rlike("[A-Za-z]")
        for pattern in allowed:
            test = test & ~hit.rlike(pattern)
        return test

    found = F.filter(_matches(text, CANDIDATE), lambda m: suspicious(m["hit"]))
    placed = F.transform(found, lambda m: F.struct(m["start"].alias("start"), _entropy_of(m["hit"], kinds).alias("runs")))
    spans = F.flatten(
        F.transform(
            placed,
            lambda x: F.transform(x["runs"], lambda w: _span("entropy", x["start"] + w["a"], x["start"] + w["z"])),
        )
    )
    return F.when(text.rlike(CANDIDATE), spans).otherwise(_none())


def scan(
    documents: DataFrame,
    text: str = "text",
    kinds: Sequence[CharacterClass] = CLASSES,
    allowed: Sequence[str] = ALLOWED,
) -> DataFrame:
    """Adds ``secret_spans``: array of (start, kind_no, end) by start, then kind; ends are exclusive.

    One row for each row of ``documents``. A null or empty text has no spans. Spans of different
    kinds may overlap; entropy spans never remove a pattern's. A column called ``secret_spans`` is replaced.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    value = lambda hit: F.length(F.regexp_extract(hit, ASSIGN, 2)) >= 6
    spans = F.concat(
        _pattern_spans(body, "assign", ASSIGN, value, r"(?i:password|passwd|secret|token|api_?key)[\"' ]*[:=]"),
        _pattern_spans(body, "access", ACCESS, lambda hit: F.length(hit) >= 20, "AKIA[A-Z0-9]{16}"),
        _pattern_spans(body, "hex", LONG_HEX, lambda hit: F.length(hit) >= 24, "[0-9a-f]{24}"),
        _entropy_spans(body, kinds, allowed),
    )
    return documents.withColumn("secret_spans", F.array_sort(spans))


def rendered(spans: Column, kinds: Sequence[str] = KINDS) -> Column:
    """``kind:start:end`` of the spans of the named kinds, comma-joined."""
    wanted = F.filter(spans, lambda s: s["kind_no"].isin([KINDS.index(k) for k in kinds]))
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(wanted, lambda s: F.concat_ws(":", F.get(name, s["kind_no"]), s["start"], s["end"])), ","
    )


def redact(documents: DataFrame, text: str = "text", mark: str = "[SECRET]", **options) -> DataFrame:
    """Replaces every span of ``text``, overlapping ones together, by ``mark``; rows without spans stay as they are."""
    rows = scan(documents, text, **options)
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    body = F.col(text)

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(body, (acc["at"] + 1).cast("int"), F.greatest(s["start"] - acc["at"], F.lit(0)).cast("int"))
        out = F.when(s["start"] < acc["at"], acc["out"]).otherwise(F.concat(acc["out"], gap, F.lit(mark)))
        return F.struct(out.alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate(F.col("secret_spans"), start, step)
    tail = F.transform(
        F.array(done),
        lambda d: F.concat(d["out"], F.substring(body, (d["at"] + 1).cast("int"), F.length(body))),
    ).getItem(0)
    return rows.withColumn(text, F.when(F.size("secret_spans") > 0, tail).otherwise(body)).drop("secret_spans")
