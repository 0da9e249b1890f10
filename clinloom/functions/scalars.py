"""Scalar helpers used by the extractors and the marts.

All of them are built-in Spark expressions, so they stay inside the JVM and
inside whole-stage code generation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The reference prefix of bundle-local ids, and the money type.
URN_PREFIX = "urn:uuid:"
MONEY = "decimal(19,4)"
# Options of the JSON parser as SQL text: strings of any length, where its default is 20 million.
ANY_LENGTH = "'maxStringLen', '2147483647'"
_LONG_TEXTS = {"maxStringLen": "2147483647"}


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strip_urn(value: Column | str) -> Column:
    """Remove every ``urn:uuid:`` from a reference."""
    return F.replace(as_column(value), F.lit(URN_PREFIX), F.lit(""))


def tail_after_pipe(value: Column | str) -> Column:
    """Text after the last ``|``; the whole value where there is none."""
    return F.substring_index(as_column(value), "|", -1)


def remove_digits(value: Column | str) -> Column:
    """Drop the characters 0-9 (generated names carry numeric suffixes)."""
    return F.regexp_replace(as_column(value), "[0-9]", "")


def first_match(value: Column | str, pattern: str) -> Column:
    """1-based position of the first match of a regular expression, 0 if none."""
    return F.regexp_instr(as_column(value), F.lit(pattern))


def splice(value: Column | str, start: Column, length: int, insert: str) -> Column:
    """Delete ``length`` characters at ``start`` and put ``insert`` there.

    NULL where ``start`` lies outside the text.
    """
    text = as_column(value)
    inside = (start >= 1) & (start <= F.length(text))
    return F.when(inside, F.overlay(text, F.lit(insert), start, F.lit(length)))


def plus(*parts: Column | str) -> Column:
    """Join texts; NULL as soon as one part is NULL."""
    return F.concat(*[as_column(p) for p in parts])


def full_name(first: Column | str, last: Column | str) -> Column:
    """Cleaned first and last name, separated by a blank."""
    return plus(remove_digits(first), F.lit(" "), remove_digits(last))


def age_years(born: Column | str, as_of: dt.date | Column | None = None) -> Column:
    """Calendar-year boundaries between birth and ``as_of`` (today by default).

    Counts year changes, not birthdays: 2000-12-31 to 2024-01-01 is 24.
    """
    if as_of is None:
        as_of = F.current_date()
    elif isinstance(as_of, dt.date):
        as_of = F.lit(as_of)
    return F.year(as_of) - F.year(as_column(born))


def local_date(value: Column | str) -> Column:
    """Calendar day written in an ISO text, whatever offset follows it.

    The text is never read as an instant, so the session zone cannot move the
    day. Unreadable text gives NULL.
    """
    return as_column(value).try_cast("date")


def local_timestamp(value: Column | str) -> Column:
    """Date and time as written in an ISO text, the offset left aside."""
    return as_column(value).try_cast("timestamp_ntz")


def is_json_document(value: Column | str) -> Column:
    """True for text that is one JSON object or array, False otherwise.

    The whole text is read, whatever its size: inside brackets it must be one
    element, and as the value of a field it must parse to the end.
    """
    text = as_column(value)
    opens = F.substring(F.ltrim(text, F.lit(" \t\r\n")), 1, 1).isin("{", "[")
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "ARRAY<STRING>", _LONG_TEXTS)
    held = F.from_json(
        F.concat(F.lit('{"d":'), text, F.lit("}")), "d STRING, _c STRING",
        {"columnNameOfCorruptRecord": "_c", **_LONG_TEXTS},
    )
    return F.coalesce(opens & (F.size(listed) == 1) & held["_c"].isNull() & held["d"].isNotNull(), F.lit(False))


def _whole_number(text: Column) -> Column:
    # A failing cast raises and catches an exception per row; the pattern does not.
    return F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), text.try_cast("int"))


# Names used in cast lists -> expression applied to the text column.
_CASTS = {
    "date": local_date,
    "timestamp": local_timestamp,
    "int": _whole_number,
    "boolean": lambda c: c.try_cast("boolean"),
    "double": lambda c: c.try_cast("double"),
    "money": lambda c: c.try_cast(MONEY),
}


def cast_text(value: Column | str, kind: str) -> Column:
    """Typed value of a text column; NULL where the text does not convert."""
    return _CASTS[kind](as_column(value))
