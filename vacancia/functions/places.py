"""City, address and URL expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from vacancia.functions.rules import any_keyword, longest_name
from vacancia.functions.text import col, empty_to_null, first_match, strip

# The served cities, used where no table of them is given.
SERVED_CITIES = (
    "Tulsa", "Broken Arrow", "Owasso", "Bixby", "Jenks", "Sand Springs", "Sapulpa",
    "Claremore", "Catoosa", "Collinsville", "Skiatook", "Glenpool", "Coweta", "Wagoner",
    "Pryor", "Muskogee", "Bartlesville",
)

# Query keys that are facets.
FACET_KEYS = (
    "locations", "locationHierarchy1", "locationRegionStateProvince",
    "jobFamilyGroup", "workerSubType", "timeType",
)

# Id shapes.
REQUISITION_SHAPE = r"^\s*(R\d{5,})\s*$"
LISTING_ID_SHAPE = r"(?i)JobID\s*:?\s*(\d+)"
DETAIL_ID_SHAPE = r"/Jobs/Details/(\d+)"
LOCATION_LINE = r"Location\s*:\s*([^\n<]+)"
POSITION_LINE = r"(?i)Position Type[:\s]+([^\n\r]+)"


def served_city(text: Column | str, cities: Sequence[str] = SERVED_CITIES) -> Column:
    """Longest served city inside the text, in its canonical spelling; else NULL."""
    return longest_name(F.lower(col(text)), cities)


def mentions_city(text: Column | str, cities: Sequence[str] = SERVED_CITIES) -> Column:
    low = F.lower(F.coalesce(col(text), F.lit("")))
    return any_keyword(low, [c.lower() for c in cities])


def served_city_of(candidates: Column, cities: Sequence[str] = SERVED_CITIES) -> Column:
    """First served city over an array of texts, array order first."""
    hits = F.filter(F.transform(candidates, lambda t: served_city(t, cities)), lambda c: c.isNotNull())
    return F.get(hits, 0)


def acceptance(location_text: Column | str, cities: Sequence[str] = SERVED_CITIES) -> Column:
    """Why a posting is kept: ``served``, ``remote``, ``multi`` or ``rejected``."""
    low = F.lower(F.coalesce(col(location_text), F.lit("")))
    return (
        F.when(served_city(low, cities).isNotNull(), "served")
        .when(low.contains("remote"), "remote")
        .when(low.contains("location"), "multi")
        .otherwise("rejected")
    )


def address_city(address: Column | str, state_code: Column | str) -> Column:
    """Comma segment before the one that starts with the state code."""
    state = F.upper(empty_to_null(state_code))
    parts = F.transform(F.split(empty_to_null(address), ","), strip)
    marks = F.filter(
        F.transform(parts, lambda p, i: F.struct(i.alias("i"), F.startswith(F.upper(p), state).alias("hit"))),
        lambda x: x["hit"] & (x["i"] > 0),
    )
    return F.get(parts, F.get(marks, 0)["i"] - 1)


def street(address: Column | str) -> Column:
    return empty_to_null(strip(F.split_part(col(address), F.lit(","), F.lit(1))))


def last_segment(location: Column | str, separator: str = " - ") -> Column:
    """Last part of ``Country - State - City``; the text itself when it has no parts."""
    location = col(location)
    parts = F.filter(F.transform(F.split(location, separator), strip), lambda p: p != "")
    return F.coalesce(F.try_element_at(parts, F.lit(-1)), location)


def first_segment(location: Column | str) -> Column:
    return strip(F.split_part(col(location), F.lit(","), F.lit(1)))


def location_line(text: Column | str) -> Column:
    return strip(first_match(text, LOCATION_LINE))


def query_values(url: Column | str, key: str) -> Column:
    """All values of one query key, decoded, blanks dropped."""
    pairs = F.split(F.try_parse_url(col(url), F.lit("QUERY")), "&")
    mine = F.filter(pairs, lambda p: F.startswith(p, F.lit(key + "=")))
    values = F.transform(mine, lambda p: F.try_url_decode(F.substring(p, F.lit(len(key) + 2), F.length(p))))
    return F.filter(values, lambda v: v != "")


def facets(url: Column | str, keys: Sequence[str] = FACET_KEYS) -> Column:
    """Map of the facet keys that the query string has to their values."""
    entries = [x for k in keys for x in (F.lit(k), query_values(url, k))]
    return F.map_filter(F.create_map(*entries), lambda _, v: F.size(v) > 0)


def board_parts(url: Column | str) -> Column:
    """(origin, tenant, board, endpoint, base) of a board address."""
    url = col(url)
    host = F.try_parse_url(url, F.lit("AUTHORITY"))
    origin = F.concat(F.try_parse_url(url, F.lit("PROTOCOL")), F.lit("://"), host)
    tenant = F.split_part(host, F.lit("."), F.lit(1))
    path = F.filter(
        F.split(F.try_parse_url(url, F.lit("PATH")), "/"),
        lambda p: (p != "") & (F.lower(p) != "en-us"),
    )
    board = F.coalesce(F.try_element_at(path, F.lit(-1)), F.lit("External"))
    return F.struct(
        origin.alias("origin"),
        tenant.alias("tenant"),
        board.alias("board"),
        F.concat(origin, F.lit("/wday/cxs/"), tenant, F.lit("/"), board, F.lit("/jobs")).alias("endpoint"),
        F.concat(origin, F.lit("/"), board).alias("base"),
    )


def source_scope(url: Column | str) -> Column:
    """(mode, value): facet by ``hiringCompany``, else search by ``q``, else error."""
    facet = F.get(query_values(url, "hiringCompany"), 0)
    term = F.get(query_values(url, "q"), 0)
    return F.struct(
        F.when(facet.isNotNull(), "facet").when(term.isNotNull(), "search").otherwise("error").alias("mode"),
        F.coalesce(facet, term).alias("value"),
    )


def absolute_url(href: Column | str, origin: Column | str) -> Column:
    """A link as it is when absolute, else joined to the origin with one slash."""
    href, origin = col(href), F.lit(origin) if isinstance(origin, str) else origin
    return (
        F.when(F.startswith(href, F.lit("http")), href)
        .when(F.startswith(href, F.lit("/")), F.concat(origin, href))
        .otherwise(F.concat(origin, F.lit("/"), href))
    )


def with_query_flag(url: Column | str, flag: str) -> Column:
    """Append a query flag once."""
    url = col(url)
    joiner = F.when(F.contains(url, F.lit("?")), "&").otherwise("?")
    return F.when(F.contains(url, F.lit(flag)), url).otherwise(F.concat(url, joiner, F.lit(flag)))


def requisition_id(text: Column | str) -> Column:
    return first_match(text, REQUISITION_SHAPE)


def listing_id(text: Column | str) -> Column:
    return first_match(text, LISTING_ID_SHAPE)


def detail_id(url: Column | str) -> Column:
    return first_match(url, DETAIL_ID_SHAPE)


def position_line(text: Column | str) -> Column:
    """Value after ``Position Type``, cut at the next known label."""
    value = strip(first_match(text, POSITION_LINE))
    return F.regexp_replace(value, r"(?i)\s*(Department|Location|Salary).*$", "")
