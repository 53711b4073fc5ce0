"""Text, identity and page expressions. Every function maps columns to a column."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vacancia.functions import elements

# White space stripped from both ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)

# Tags that survive the structural clean.
STRUCTURAL_TAGS = (
    "p", "br", "strong", "b", "em", "i", "ul", "ol", "li",
    "h1", "h2", "h3", "h4", "h5", "h6",
)

# Elements that never hold posting text.
BOILERPLATE_TAGS = ("script", "style", "noscript", "nav", "header", "footer", "aside")

# Place names cut from the end of a title, in this order.
TITLE_PLACES = (
    "sand springs", "tulsa", "broken arrow", "oklahoma", "ok",
    "remote", "hybrid", "kellyville", "mannford",
)


_SPACE_RUN = r"(?U)\s+"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.btrim(col(c), F.lit(WHITESPACE))


def blank_to_null(c: Column | str) -> Column:
    """NULL for NULL and for a text of white space only; otherwise the text as it is."""
    c = col(c)
    return F.when(strip(c) != "", c)


def empty_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def first_match(c: Column | str, pattern: str, group: int = 1) -> Column:
    """First match of a group, NULL where the pattern does not occur or is empty."""
    return F.nullif(F.regexp_extract(col(c), pattern, group), F.lit(""))


def slug(name: Column | str) -> Column:
    dashed = F.regexp_replace(F.lower(col(name)), "[^a-z0-9]+", "-")
    return F.btrim(dashed, F.lit("-"))


def content_hash(title: Column | str, url: Column | str, description: Column | str) -> Column:
    """md5 of title, url and description with nothing between; absent parts are empty."""
    return F.md5(F.concat_ws("", col(title), col(url), col(description)))


def strip_title_places(title: Column | str, places: Sequence[str] = TITLE_PLACES) -> Column:
    """Cut a trailing ``- place``, ``, place`` or ``(place)`` for each place in turn."""
    out = strip(title)
    for place in map(re.escape, places):
        for shape in (rf"\s*-\s*{place}\s*$", rf"\s*,\s*{place}\s*$", rf"\s*\(\s*{place}\s*\)\s*$"):
            out = F.regexp_replace(out, "(?i)" + shape, "")
    return strip(out)


def title_with_flags(title: Column | str) -> Column:
    """Struct of the clean title and what its markers say.

    ``Entry Level Position``, ``- OK -``, ``DAYS`` and ``NIGHTS`` leave the title; the
    day and night flags look for the letters anywhere, the cut is on whole words.
    """
    raw = col(title)
    entry = F.contains(raw, F.lit("Entry Level Position"))
    days = F.contains(F.upper(raw), F.lit("DAYS"))
    nights = F.contains(F.upper(raw), F.lit("NIGHTS"))
    out = F.replace(raw, F.lit("Entry Level Position"), F.lit(""))
    out = F.regexp_replace(out, r"\s*-\s*OK\s*-\s*", "")
    out = F.when(days, F.regexp_replace(out, r"(?i)\bDAYS\b", "")).otherwise(out)
    out = F.when(nights, F.regexp_replace(out, r"(?i)\bNIGHTS\b", "")).otherwise(out)
    return F.struct(
        collapse(out).alias("title"),
        F.when(entry, F.lit(1)).alias("experience_id"),
        days.alias("first_shift"),
        nights.alias("third_shift"),
    )


def collapse(c: Column | str) -> Column:
    """White-space runs to one space, none at the ends."""
    return strip(F.regexp_replace(col(c), _SPACE_RUN, " "))


def is_long_enough(c: Column | str, minimum: int) -> Column:
    return F.coalesce(F.length(strip(c)) >= minimum, F.lit(False))


# --- pages ------------------------------------------------------------------

def without_elements(html: Column | str, tags: Sequence[str] = BOILERPLATE_TAGS) -> Column:
    """Drop whole elements, content and nested elements included."""
    return elements.without(col(html), lambda tok, name: name.isin(*tags))


def page_text(html: Column | str) -> Column:
    """Text of a page or fragment: tags become nothing."""
    return F.regexp_replace(F.regexp_replace(col(html), r"(?s)<!--.*?-->", ""), r"(?s)<[^>]*>", "")


def spaced_page_text(html: Column | str) -> Column:
    """Text of a page with a space for every tag, white space collapsed."""
    bare = F.regexp_replace(col(html), r"(?s)<!--.*?-->", " ")
    return collapse(F.regexp_replace(bare, r"(?s)<[^>]*>", " "))


def unescape(text: Column | str) -> Column:
    """The entities that job pages use; ``&amp;`` last so nothing is decoded twice."""
    out = col(text)
    for entity, char in (
        ("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
        ("&#39;", "'"), ("&apos;", "'"), ("&ndash;", "–"), ("&mdash;", "—"),
        ("&rsquo;", "’"), ("&bull;", "•"), ("&amp;", "&"),
    ):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def structural_html(html: Column | str, tags: Sequence[str] = STRUCTURAL_TAGS) -> Column:
    """Keep the structural tags without attributes, drop other tags but keep their text.

    A line break is written as an empty element, entities are decoded, blank runs become
    one space and three or more line ends become two.
    """
    kept = "|".join(sorted(tags, key=len, reverse=True))
    out = F.regexp_replace(col(html), r"(?s)<!--.*?-->", "")
    out = F.regexp_replace(out, r"(?i)<![a-z][^>]*>|</br\s*>", "")
    # other tags go first; the kept ones lose their attributes after that
    out = F.regexp_replace(out, rf"(?i)<(?!/?(?:{kept})\b)/?[a-z][^>]*>", "")
    out = F.regexp_replace(out, rf"(?i)<({kept})\b[^>]*>", "<$1>")
    out = F.regexp_replace(out, rf"(?i)</({kept})\b[^>]*>", "</$1>")
    out = unescape(F.regexp_replace(out, r"(?i)<br>", "<br></br>"))
    out = F.regexp_replace(out, r"[ \t]+", " ")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return strip(out)


def _opened_by(open_tag: str, tag: str | None) -> elements.Root:
    fits = lambda tok: tok.rlike(rf"(?is)^{open_tag}")
    return lambda tok, name: fits(tok) if tag is None else (name == tag) & fits(tok)


def element_body(html: Column | str, open_tag: str, tag: str | None = None) -> Column:
    """Inner HTML of the first element whose opening tag matches ``open_tag``, up to its own end tag."""
    return elements.first_inner(col(html), _opened_by(open_tag, tag))


def with_page_content(df: DataFrame, html: str, out: str, containers: Sequence[tuple[str, str | None]],
                      minimum: int = 100) -> DataFrame:
    """First container with more than ``minimum`` characters of text, else the body.

    The stripped page and each container are columns of their own: a page is walked twice, once
    for what is stripped and once for the containers and the body together.
    """
    names = [f"_c{i}" for i in range(len(containers))]
    bare = df.withColumn("_bare", without_elements(html))
    roots = [_opened_by(o, t) for o, t in (*containers, (r"<body\b[^>]*>", "body"))]
    parts = bare.withColumn("_found", elements.first_inners(F.col("_bare"), roots))
    parts = parts.withColumns({n: F.get("_found", i) for i, n in enumerate(names)})
    sized = parts.withColumns({n + "_n": F.length(collapse(page_text(n))) for n in names})
    picks = [F.when(F.col(n + "_n") > minimum, F.col(n)) for n in names]
    body = F.coalesce(F.get("_found", len(names)), F.col("_bare"))
    return sized.withColumn(out, F.coalesce(*picks, body)).drop("_bare", "_found", *names, *[n + "_n" for n in names])


def all_matches(html: Column | str, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(col(html), F.lit(pattern), F.lit(group))


LINK_PATTERN = r'(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a\s*>'


def links(html: Column | str) -> Column:
    """Array of (pos, href, label) for every link of a page, in page order."""
    pairs = F.arrays_zip(
        all_matches(html, LINK_PATTERN, 1).alias("href"),
        all_matches(html, LINK_PATTERN, 2).alias("label"),
    )
    return F.transform(
        pairs,
        lambda x, i: F.struct(
            i.alias("pos"), x["href"].alias("href"), collapse(page_text(x["label"])).alias("label")
        ),
    )


LIST_TOKEN = r"(?is)<(?:!--.*?-->|(script|style)\b[^>]*>.*?</\1\s*>|(/?(?:dl|dt|dd))(?:\s[^>]*)?/?>)"


def _clean(c: Column) -> Column:
    """Text of a fragment, entities decoded, stripped; a step that changes nothing is not taken."""
    bare = elements.let(c, lambda x: F.when(F.contains(x, F.lit("<")), page_text(x)).otherwise(x))
    plain = elements.let(bare, lambda x: F.when(F.contains(x, F.lit("&")), unescape(x)).otherwise(x))
    return elements.let(plain, lambda x: F.when(x.rlike(r"(?s)\A[!-~](?:.*[!-~])?\z"), x).otherwise(strip(x)))


def first_labels(labels: Column, values: Column) -> Column:
    """Map from parallel arrays; of a repeated label the first entry stays."""
    return elements.let(F.array_distinct(labels), lambda names: F.when(
        F.size(names) == F.size(labels), F.map_from_arrays(labels, values)).otherwise(F.map_from_arrays(
            names, F.transform(names, lambda k: F.get(values, (F.array_position(labels, k) - 1).cast("int"))))))


def _label_spans(tags: Column) -> Column:
    """Array of (n, end, start, stop): the tokens that open and end a label, and those of its value.

    A step costs what it changes: the innermost list is the state itself, the lists around it are
    only touched when a list begins or ends, and texts are not carried at all.
    """
    label = "struct<n:int,end:int>"
    value = f"struct<waiting:array<{label}>,start:int,stop:int>"
    none = F.array().cast(f"array<{label}>")

    # kind: the end tag of the label or value that is open, or nothing; n: the token that opened it
    def state(at: Column, kind: Column, n: Column, labels: Column, lists: Column, found: Column) -> Column:
        return F.struct(at.alias("at"), kind.alias("kind"), n.alias("n"), labels.alias("waiting"), lists.alias("outer"), found.alias("values"))

    def with_value(found: Column, top: Column, at: Column) -> Column:
        """The values with the one that is open, if it has a label."""
        ended = F.struct(top["waiting"].alias("waiting"), top["n"].alias("start"), at.alias("stop"))
        return F.when((top["kind"] == "/dd") & (F.size(top["waiting"]) > 0), F.array_append(found, ended)).otherwise(found)

    def merge(s: Column, tag: Column) -> Column:
        ended = F.struct(s["n"].alias("n"), s["at"].alias("end"))
        labels = F.when(s["kind"] == "/dt", F.array_append(s["waiting"], ended)).when(s["kind"] == "/dd", none).otherwise(s["waiting"])
        found = with_value(s["values"], s, s["at"])
        top = F.element_at(s["outer"], -1)
        this = F.struct(s["kind"].alias("kind"), s["n"].alias("n"), s["waiting"].alias("waiting"))
        after = s["at"] + 1
        return (
            F.when(tag == s["kind"], state(after, F.lit(""), s["at"], labels, s["outer"], found))
            .when(tag == "dt", state(after, F.lit("/dt"), s["at"], labels, s["outer"], found))
            .when(tag == "dd", state(after, F.lit("/dd"), s["at"], labels, s["outer"], found))
            .when(tag == "dl", state(after, F.lit(""), s["at"], none, F.array_append(s["outer"], this), s["values"]))
            .when((tag == "/dl") & (F.size(s["outer"]) > 0), state(after, top["kind"], top["n"], top["waiting"], F.slice(s["outer"], F.lit(1), F.size(s["outer"]) - 1), found))
            .otherwise(state(after, s["kind"], s["n"], s["waiting"], s["outer"], s["values"]))
        )

    def finish(s: Column) -> Column:
        unended = F.filter(s["outer"], lambda top: top["kind"] == "/dd")
        around = F.transform(unended, lambda top: F.struct(top["waiting"].alias("waiting"), top["n"].alias("start"), s["at"].alias("stop")))
        return F.concat(with_value(s["values"], s, s["at"]), around)

    def spans(found: Column) -> Column:
        return F.sort_array(F.flatten(F.transform(found, lambda v: F.transform(v["waiting"], lambda w: F.struct(
            w["n"].alias("n"), w["end"].alias("end"), v["start"].alias("start"), v["stop"].alias("stop"))))))

    outer = F.array().cast(f"array<struct<kind:string,n:int,waiting:array<{label}>>>")
    return spans(F.aggregate(tags, state(F.lit(0), F.lit(""), F.lit(0), none, outer, F.array().cast(f"array<{value}>")), merge, finish))


def label_pairs(html: Column | str) -> Column:
    """Array of (n, k, v): raw labels and values of the lists of a page, in order of the labels.

    A walk over the tokens of ``dl``, ``dt`` and ``dd`` carries the lists that are open. A label
    or a value ends with its end tag, with the next one of its list, or with its list; the
    text of a list inside a value belongs to the value too. A label takes the next value of
    its list, and several labels may take one; a label without a value is no pair.
    """

    def pairs(page: Column) -> Column:
        tags = F.transform(F.regexp_extract_all(page, F.lit(LIST_TOKEN), F.lit(2)), F.lower)
        return elements.let(F.split(page, LIST_TOKEN, -1), lambda texts: F.transform(_label_spans(tags), lambda x: F.struct(
            x["n"].alias("n"), text(texts, x["n"], x["end"]).alias("k"), text(texts, x["start"], x["stop"]).alias("v"))))

    def text(texts: Column, first: Column, end: Column) -> Column:
        """The text between two tokens, without the tokens that are between."""
        return F.when(end == first + 1, F.get(texts, end)).otherwise(F.array_join(F.slice(texts, first + 2, end - first), ""))

    return elements.let(col(html), pairs)


def label_values(html: Column | str) -> Column:
    """Map of the ``dt``/``dd`` pairs of a page, labels in lower case, first one kept."""
    return elements.let(label_pairs(html), lambda found: elements.let(F.transform(found, lambda x: F.lower(_clean(x["k"]))), lambda labels: first_labels(
        labels, F.transform(found, lambda x: _clean(x["v"])))))


def link_after(html: Column | str, phrase: str) -> Column:
    """Target of the first link that follows a phrase."""
    return first_match(html, rf'(?is){phrase}.*?<a\b[^>]*?href="([^"]+)"', 1)


def shared_document_id(url: Column | str) -> Column:
    """Id inside a share link: ``/document/d/ID``, ``/file/d/ID`` or ``?id=ID``."""
    return F.coalesce(
        first_match(url, r"/document/d/([a-zA-Z0-9_-]+)"),
        first_match(url, r"/file/d/([a-zA-Z0-9_-]+)"),
        first_match(url, r"[?&]id=([a-zA-Z0-9_-]+)"),
    )


def file_kind(content: Column | str) -> Column:
    """Kind of a binary document by its first bytes, whatever its declared type."""
    content = col(content)
    return (
        F.when(F.substring(content, 1, 5) == F.lit(b"%PDF-"), "pdf")
        .when(F.substring(content, 1, 2) == F.lit(b"PK"), "docx")
    )
