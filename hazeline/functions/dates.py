"""Dates and times: free-form date text, UTC and local clocks, day types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTH_STEMS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH_NAME = (
    r"(jan(uary)?|feb(ruary)?|mar(ch)?|apr(il)?|may|june?|july?|aug(ust)?"
    r"|sept?(ember)?|oct(ober)?|nov(ember)?|dec(ember)?)"
)
# The date shapes that are read, with an optional time of day and zone.
_TIME = r"([T ]+\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?\s*([ap]m)?\s*([+-]\d{2}:?\d{2}|UTC|GMT)?)?$"
_SHAPES = [
    r"\d{4}-\d{1,2}-\d{1,2}",
    r"\d{4}/\d{1,2}/\d{1,2}",
    r"\d{8}",
    r"\d{1,2}/\d{1,2}/(\d{4}|\d{2})",
    r"\d{1,2}-\d{1,2}-(\d{4}|\d{2})",
    _MONTH_NAME + r"\.? +\d{1,2},? +\d{4}",
    r"\d{1,2} +" + _MONTH_NAME + r"\.?,? +\d{4}",
]
_READABLE = "(?i)^(" + "|".join(_SHAPES) + ")" + _TIME
# Fractions of a second and the zone end a text and are dropped.
_TAIL = r"(?i)(?<=:\d{2})(\.\d+)?\s*([ap]m)?\s*([+-]\d{2}:?\d{2}|UTC|GMT)?$"
_HALF = r"(?i)\d\s*([ap])m\b"

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _bind(value: Column, use) -> Column:
    """Give ``use`` a value that is worked out once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def parse_date_text(value: Column) -> Column:
    """Free-form date text to a timestamp without zone; null if unreadable.

    Month comes before day unless that is impossible (``13/1/2020``). A year of
    two digits is the nearest one, up to 68 in this century. An offset is dropped,
    not applied: the clock reading is what counts.
    """
    text = F.trim(value)
    readable = F.when(text.rlike(_READABLE), F.regexp_replace(text, _TAIL, ""))
    readable = F.regexp_replace(readable, r"^(\d{4})(\d{2})(\d{2})(?!\d)", "$1-$2-$3")
    half = F.lower(F.regexp_extract(text, _HALF, 1))
    return _bind(
        F.split(readable, r"[-/,.: ]+|(?<=\d)T(?=\d)"), lambda parts: _from_parts(parts, half)
    )


def _from_parts(parts: Column, half: Column) -> Column:
    def number(index):
        return F.get(parts, F.lit(index)).try_cast("int")

    def month(index):
        stem = F.lower(F.substring(F.get(parts, F.lit(index)), 1, 3))
        return ((F.position(stem, F.lit(_MONTH_STEMS)) - 1) / 3 + 1).cast("int")

    first, second, third = number(0), number(1), number(2)
    year_first = first > 31
    swap = (first > 12) & (second <= 12)
    hour, *rest = [F.coalesce(number(index), F.lit(0)) for index in (3, 4, 5)]
    twelve = (F.when(hour.between(1, 12), hour % 12)) + F.when(half == "p", 12).otherwise(0)
    clock = [F.when(half.isin("a", "p"), twelve).otherwise(hour), *rest]

    def stamp(year, month_number, day):
        year = F.when(year < 69, year + 2000).when(year < 100, year + 1900).otherwise(year)
        return F.try_make_timestamp_ntz(year, month_number, day, *clock)

    return (
        F.when(first.isNull(), stamp(third, month(0), second))
        .when(second.isNull(), stamp(third, month(1), first))
        .when(year_first, stamp(first, second, third))
        .when(swap, stamp(third, second, first))
        .otherwise(stamp(third, first, second))
    )


def to_iso_text(value: Column) -> Column:
    """Free-form date text to ``yyyy-MM-ddTHH:mm:ssZ``.

    Text that already ends in Z passes as it is, unchecked.
    """
    text = F.trim(value)
    return F.when(text.endswith("Z"), text).otherwise(
        F.date_format(parse_date_text(text), ISO_SECONDS)
    )


def utc_clock(text: Column) -> Column:
    """ISO text with Z or an offset to the UTC wall clock.

    The session zone is UTC, so text without an offset is taken as UTC.
    """
    return text.try_cast("timestamp").cast("timestamp_ntz")


def local_clock(text: Column) -> Column:
    """ISO text to the wall clock it shows; its offset changes with DST."""
    return F.substring(text, 1, 19).try_cast("timestamp_ntz")


def month_key(stamp: Column) -> Column:
    """Partition value of the fact table, ``yyyy-MM``."""
    return F.date_format(stamp, "yyyy-MM")


def day_type(date: Column) -> Column:
    return F.when(F.weekday(date) >= 5, F.lit("Weekend")).otherwise(F.lit("Weekday"))


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMMM")
