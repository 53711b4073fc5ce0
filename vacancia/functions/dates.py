"""Date expressions. Each takes an explicit ``as_of``; nothing reads the clock."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from vacancia.functions.text import col, collapse, first_match, strip

# Absolute formats, tried in this order (US month/day before day/month).
ABSOLUTE_FORMATS = (
    "yyyy-M-d",
    "M/d/yyyy",
    "d/M/yyyy",
    "MMM d, yyyy",
    "MMMM d, yyyy",
    "d-MMM-yyyy",
    "d MMM yyyy",
    "yyyy/M/d",
    "M-d-yyyy",
)

# Tried after the absolute formats.
EXTRA_FORMATS = ("yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m:s'Z'", "M/d/yy", "d.M.yyyy", "yyyyMMdd")

# Formats of two source-specific parsers.
DASHED_FORMATS = ("M/d/yyyy", "M-d-yyyy", "yyyy-M-d", "M/d/yy", "M-d-yy")
CARD_FORMATS = ("MMM d, yyyy", "d MMM yyyy", "M/d/yyyy", "yyyy-M-d")

# Words that send a text to the relative parser first.
RELATIVE_WORDS = "ago|posted|days|today|yesterday"

# Fixed value: what is around the number of days.
RELATIVE_NUMBER = r"(?i)^[\s\u00a0]*(?:Posted\s+)?[+\s]*(-?\d{1,9})[+\s]*(?:Days?\s+Ago)?[\s\u00a0]*$"

# What dates inside a text look like.
REVISED_FORMATS = ("MMMM d, yyyy", "MMMM d yyyy", "MMMM yyyy")
REVISED_PATTERN = r"(?i)Last Revised Date:?\s*([A-Za-z]+\s+\d{1,2},?\s*\d{4}|[A-Za-z]+\s+\d{4})"
DEADLINE_PATTERN = (
    r"(?i)application\s+deadline[\s:]+(\d{1,2}[/\-]\d{1,2}[/\-]\d{2,4}|\w+ \d{1,2},?\s*\d{4})"
)

_NTZ = "timestamp_ntz"
_CENTURY_PIVOT = 2069  # fixed value: two-digit years 69..99 are 19xx


def moment(as_of: Column | datetime | str) -> Column:
    """``as_of`` as a zone-less timestamp column."""
    if isinstance(as_of, datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(as_of, str):
        return F.lit(as_of).cast(_NTZ)
    return as_of.cast(_NTZ)


def days_before(as_of: Column | datetime | str, days: Column) -> Column:
    # more days than the calendar has is a text that names no date
    return F.when(F.abs(days) <= 700_000, moment(as_of) - F.make_dt_interval(days))


# What each letter group of a format looks like. The shape is tested before the parse:
# a parser that fails costs far more than a pattern that does not match.
_SHAPES = (
    ("yyyy", r"\d{4}"), ("yy", r"\d{2}"), ("MMMM", "[A-Za-z]{3,9}"), ("MMM", "[A-Za-z]{3}"),
    ("MM", r"\d{2}"), ("M", "(?:0?[1-9]|1[0-2])"), ("dd", r"\d{2}"), ("d", r"(?:0?[1-9]|[12]\d|3[01])"),
    ("H", r"\d{1,2}"), ("m", r"\d{1,2}"), ("s", r"\d{1,2}"), ("'T'", "T"), ("'Z'", "Z"), (" ", r"\s+"),
)
_BLANK = r"[\s\u00a0]*"
# one-digit months and days are read too, month first
_COMPACT = r"(\d{4})(1[0-2]|0[1-9]|[1-9])(3[01]|[12]\d|0[1-9]|[1-9])"


def format_shape(fmt: str) -> str:
    """Pattern of the texts that a format can read."""
    if fmt == "yyyyMMdd":
        return f"^{_BLANK}{_COMPACT}{_BLANK}$"
    out, rest = "", fmt
    while rest:
        letters, shape = next(((t, p) for t, p in _SHAPES if rest.startswith(t)), (rest[0], "\\" + rest[0]))
        out, rest = out + shape, rest[len(letters):]
    return f"^{_BLANK}{out}{_BLANK}$"


def _parse_one(text: Column, fmt: str) -> Column:
    shape = format_shape(fmt)
    clean = collapse(text) if " " in fmt else strip(text)
    if "H" in fmt:
        parsed = F.try_to_timestamp(clean, F.lit(fmt)).cast(_NTZ)
    elif fmt == "yyyyMMdd":
        parts = [F.regexp_extract(text, shape, g) for g in (1, 2, 3)]
        parsed = F.try_to_date(F.concat_ws("-", *parts), "yyyy-M-d").cast(_NTZ)
    elif fmt.endswith(("/yy", "-yy")):
        day = F.try_to_date(clean, fmt)
        parsed = F.when(F.year(day) >= _CENTURY_PIVOT, F.add_months(day, -1200)).otherwise(day).cast(_NTZ)
    else:
        parsed = F.try_to_date(clean, fmt).cast(_NTZ)
    return F.when(text.rlike(shape), parsed)


def parse_formats(text: Column | str, formats: Sequence[str]) -> Column:
    """First format that reads the whole text; NULL when none does."""
    return F.coalesce(*[_parse_one(col(text), f) for f in formats])


def parse_absolute(text: Column | str) -> Column:
    return parse_formats(text, ABSOLUTE_FORMATS)


def parse_relative(text: Column | str, as_of: Column | datetime | str) -> Column:
    """``Posted 5 days ago``, ``30+ Days Ago``, ``today``, ``yesterday`` or a bare number.

    ``N+ days ago`` is exactly N days; anything else is NULL.
    """
    text = col(text)
    number = first_match(text, RELATIVE_NUMBER).try_cast("int")
    return (
        F.when(text.rlike("(?i)today"), moment(as_of))
        .when(text.rlike("(?i)yesterday"), days_before(as_of, F.lit(1)))
        .otherwise(days_before(as_of, number))
    )


def normalise_date(text: Column | str, as_of: Column | datetime | str) -> Column:
    """Relative wording when the text has any, then absolute and extra formats.

    A ``Posted`` prefix is not cut for absolute dates: ``Posted 01/15/2024`` is NULL.
    """
    relative = F.when(col(text).rlike(f"(?i){RELATIVE_WORDS}"), parse_relative(text, as_of))
    return F.coalesce(relative, parse_formats(text, ABSOLUTE_FORMATS + EXTRA_FORMATS))


def parse_dashed(text: Column | str) -> Column:
    return parse_formats(text, DASHED_FORMATS)


def parse_card_date(text: Column | str, as_of: Column | datetime | str) -> Column:
    """Card wording: four formats, ``today`` at midnight, first digits of ``N day.. ago``."""
    text = col(text)
    digits = first_match(text, r"(\d+)").try_cast("int")
    return F.coalesce(
        parse_formats(text, CARD_FORMATS),
        F.when(text.rlike("(?i)today"), F.date_trunc("day", moment(as_of)).cast(_NTZ))
        .when(text.rlike("(?i)day") & text.rlike("(?i)ago"), days_before(as_of, digits)),
    )


def parse_iso(text: Column | str) -> Column:
    """ISO-8601; the zone is dropped, the wall clock stays."""
    bare = F.regexp_replace(strip(text), r"(Z|[+-]\d{2}:?\d{2})$", "")
    return F.when(bare.rlike(r"^\d{4}-\d{2}-\d{2}"), bare.try_cast(_NTZ))


def from_epoch_millis(millis: Column | str) -> Column:
    return F.timestamp_millis(col(millis)).cast(_NTZ)


def whole_days(as_of: Column | datetime | str, moment_col: Column | str) -> Column:
    """Days from a date to ``as_of``, rounded down (negative for a later date)."""
    now, then = moment(as_of), moment(col(moment_col))

    def clock(c: Column) -> Column:
        return c - F.to_date(c).cast(_NTZ)

    part_day = F.when(clock(now) < clock(then), 1).otherwise(0)
    return (F.datediff(now, then) - part_day).cast("bigint")


def is_recent(date: Column | str, as_of: Column | datetime | str, days: int = 30) -> Column:
    return F.coalesce(F.abs(whole_days(as_of, date)) <= days, F.lit(False))


def days_ago(date: Column | str, as_of: Column | datetime | str) -> Column:
    age = whole_days(as_of, date)
    return F.when(age.isNotNull(), F.greatest(F.lit(0).cast("bigint"), age))


def cutoff(as_of: Column | datetime | str, days: int = 7) -> Column:
    return days_before(as_of, F.lit(days))


def format_date(date: Column | str, kind: str = "date") -> Column:
    """``date``, ``datetime`` or ``display``; an unknown kind formats as ``date``."""
    shapes = {"datetime": "yyyy-MM-dd HH:mm:ss", "display": "MM/dd/yyyy"}
    return F.date_format(col(date), shapes.get(kind, "yyyy-MM-dd"))


def last_revised(text: Column | str) -> Column:
    """Date after ``Last Revised Date:``; a month alone means its first day."""
    return parse_formats(revised_text(text), REVISED_FORMATS)


def revised_text(text: Column | str) -> Column:
    return first_match(text, REVISED_PATTERN)


def deadline_text(text: Column | str) -> Column:
    return first_match(text, DEADLINE_PATTERN)


def posted_text(html: Column | str) -> Column:
    """Text of the first ``div`` whose own text says when it was posted."""
    return first_match(html, r"(?i)<div\b[^>]*>([^<]*Posted[^<]*)</div\s*>")


def with_date_in_text(df: DataFrame, found: Column, as_of: Column | datetime | str, out: str) -> DataFrame:
    """A date column from a text that has to be searched for first.

    The search result is a column of its own, so that the search runs once per row and
    not once per date format.
    """
    staged = df.withColumn("_found", found)
    return staged.withColumn(out, normalise_date("_found", as_of)).drop("_found")


def is_iso_date_argument(text: Column | str) -> Column:
    """True for ``YYYY-MM-DD`` that names a real day."""
    text = col(text)
    shape = text.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$")
    return F.coalesce(shape & F.try_to_date(text, "yyyy-MM-dd").isNotNull(), F.lit(False))
