"""Reading single fields out of JSON text with the event contract's coercion rules."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def may_contain(value: str, word: str) -> Column:
    """False only for lines that cannot hold ``word`` as a JSON string.

    A substring test is about three times cheaper than a parse. JSON may write any
    character of a string behind a backslash, so lines with one always pass.
    """
    return F.col(value).contains(word) | F.col(value).contains("\\")


def _single(line: Column) -> Column:
    """False where the line holds more than one JSON value.

    A line that begins with a brace and whose first closing one is its last character holds no second
    value; only the others are read again, as the elements of an array.
    """
    one = F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1
    framed = F.ltrim(line).startswith("{") & (F.locate("}", line) == F.length(F.rtrim(line)))
    return F.coalesce(framed | one, F.lit(False))


def extract_object(
    df: DataFrame, fields: Iterable[str], keep: Iterable[str], *, drop_broken: bool = False, value: str = "value"
) -> DataFrame:
    """``keep`` columns, the named JSON fields as text, and ``is_object``; with ``drop_broken``
    only the lines that are objects, without that column.

    The line is wrapped as the only member of an object, so trailing text, two
    glued records and roots that are not objects all fail the parse; what would
    splice further members into that frame is found by :func:`_single`. Only the
    named fields are materialised. The one-element ``inline`` keeps later
    filters above the parse: pushed below it, they would parse each line again.
    """
    names = list(fields)
    kept = list(dict.fromkeys(keep))
    members = ", ".join(f"`{n}` string" for n in names)
    schema = f"r struct<{members}>, bad string"
    parsed = F.from_json(
        F.concat(F.lit('{"r":'), F.col(value), F.lit("}")), schema, {"columnNameOfCorruptRecord": "bad"}
    )
    framed = df.select(*kept, parsed.alias("_json"), _single(F.col(value)).alias("_single"))
    rows = framed.selectExpr(*kept, "_single", "inline(array(_json))")
    ok = "bad IS NULL AND r IS NOT NULL AND _single"
    if drop_broken:
        return rows.filter(ok).selectExpr(*kept, *[f"r.`{n}` AS `{n}`" for n in names])
    return rows.selectExpr(*kept, *[f"if({ok}, r.`{n}`, NULL) AS `{n}`" for n in names], f"({ok}) AS is_object")


def to_long(text: Column) -> Column:
    """``1001``, ``"1001"`` and ``12.9`` give 1001, 1001 and 12; anything else is null."""
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,10)").try_cast("bigint"))


def to_int(text: Column) -> Column:
    return to_long(text).try_cast("int")


def coerce(text: Column, kind: str) -> Column:
    if kind == "string":
        return text
    if kind == "bigint":
        return to_long(text)
    if kind == "int":
        return to_int(text)
    return text.try_cast(kind)


def unreadable(text: Column, kind: str) -> Column:
    """True where a present value cannot be coerced; empty text and "null" count as no value."""
    blank = text.isNull() | F.lower(text).isin("", "null")
    return ~blank & coerce(text, kind).isNull()


def has_key(value: Column, key: str) -> Column:
    """Key presence, which is not the same as a non-null value. Parses the line again,
    so callers test it only where the field itself came back null."""
    return F.coalesce(F.array_contains(F.json_object_keys(value), key), F.lit(False))
