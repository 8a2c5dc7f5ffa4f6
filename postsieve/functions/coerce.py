"""Lenient conversion of loosely typed input columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from postsieve.functions.text import SP, hashtags_loose, strip

# Spellings of "nothing here".
NULL_WORDS = ["nan", "none", "null"]
EMPTY_LISTS = ["[]", "[ ]", "['']", '[""]']

NUMBER = rf"^[{SP}]*[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?[{SP}]*$"


def empty_list() -> Column:
    return F.array().cast("array<string>")


def _bracketed(s: Column, left: str, right: str) -> Column:
    return s.startswith(left) & s.endswith(right)


def _as_list(s: Column) -> Column:
    return F.from_json(s, "array<string>")


def to_list(col: Column) -> Column:
    """Text to list: list text is parsed, objects and broken lists give nothing, other text is one item."""
    s = strip(col)
    nothing = s.isNull() | (s == "") | F.lower(s).isin(NULL_WORDS) | s.isin(EMPTY_LISTS)
    return (
        F.when(nothing, empty_list())
        .when(_bracketed(s, "[", "]"), F.coalesce(_as_list(s), empty_list()))
        .when(_bracketed(s, "{", "}"), empty_list())
        .otherwise(F.array(s))
    )


def coerce_tags(col: Column) -> Column:
    """List text to its items, other text to the loose tags inside it, objects and NULL to nothing."""
    s = strip(col)
    return (
        F.when(s.isNull(), empty_list())
        .when(_bracketed(s, "[", "]"), F.coalesce(_as_list(s), hashtags_loose(col)))
        .when(_bracketed(s, "{", "}") & F.try_parse_json(s).isNotNull(), empty_list())
        .otherwise(hashtags_loose(col))
    )


def parse_json_like(col: Column) -> Column:
    """Bracketed text as compact JSON when it parses, else the text as it is."""
    s = strip(col)
    framed = _bracketed(s, "[", "]") | _bracketed(s, "{", "}")
    return F.when(framed, F.coalesce(F.to_json(F.try_parse_json(s)), col)).otherwise(col)


def numeric(col: Column) -> Column:
    """Number or NULL. Java float suffixes such as ``1d`` do not count as numbers."""
    s = col.cast("string")
    return F.when(s.rlike(NUMBER), strip(s).try_cast("double"))


def to_int(col: Column) -> Column:
    """Whole number; thousands commas dropped, fraction cut, anything else 0."""
    plain = F.replace(col.cast("string"), F.lit(","), F.lit(""))
    exact = F.when(plain.rlike(rf"^[{SP}]*[+-]?\d+[{SP}]*$"), strip(plain).try_cast("bigint"))
    return F.coalesce(exact, numeric(plain).try_cast("bigint"), F.lit(0).cast("bigint"))


# Date spellings accepted besides ISO 8601.
DATE_FORMATS = ["yyyy/MM/dd", "yyyy.MM.dd", "yyyyMMdd"]


def parse_dt(col: Column) -> Column:
    """Timestamp or NULL."""
    s = F.nullif(strip(col), F.lit(""))
    return F.coalesce(F.try_to_timestamp(s), *[F.try_to_timestamp(s, F.lit(f)) for f in DATE_FORMATS])


def comment_count_text(col: Column) -> Column:
    """Non-blank pieces between commas and line breaks."""
    pieces = F.split(F.coalesce(col, F.lit("")), r"[\n,]+")
    return F.size(F.filter(pieces, lambda p: strip(p) != ""))


def comment_count(col: Column, dtype: str) -> Column:
    """Comments of a list, a number or a text column; the type is known while planning."""
    if dtype.startswith("array"):
        return F.when(col.isNull(), 0).otherwise(F.size(col))
    if dtype == "string":
        return comment_count_text(col)
    return F.coalesce(col.try_cast("int"), F.lit(0))


def label_to_int(col: Column) -> Column:
    return F.coalesce(col.try_cast("int"), F.lit(0))


def first_address(col: Column, dtype: str = "string") -> Column:
    """First item of a list or list text, plain text trimmed, else empty."""
    if dtype.startswith("array"):
        return F.coalesce(F.get(col, 0), F.lit(""))
    s = strip(col)
    listed = _as_list(s)
    first = F.when(listed.isNull(), s).otherwise(F.coalesce(F.get(listed, 0), F.lit("")))
    return F.coalesce(F.when(_bracketed(s, "[", "]"), first).otherwise(s), F.lit(""))


def first_name(col: Column, dtype: str = "string") -> Column:
    """Place name of a list or text column, trimmed."""
    value = F.get(col, 0) if dtype.startswith("array") else col
    return strip(F.coalesce(value, F.lit("")))


def wrap(col: Column) -> Column:
    """Text to a list of one item, blank text to an empty list."""
    return F.when(strip(F.coalesce(col, F.lit(""))) != "", F.array(col)).otherwise(empty_list())


def log1p_feature(col: Column) -> Column:
    return F.log1p(F.coalesce(numeric(col), F.lit(0.0)))
