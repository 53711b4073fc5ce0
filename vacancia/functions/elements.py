"""Elements of a page: where each one ends, whatever is nested in it.

A page is cut into tag tokens and the texts between. One ``aggregate`` over the tokens
carries the open tags, as a parser does: an end tag closes the last open tag of its name
and all that was opened behind it; a tag that is never closed reaches to the end of the
page; an end tag without an open one is nothing. Scripts and styles are one token each.

A step of the walk costs what it changes and not what is open. The open tags are one run of
bytes (``name/name/``): a tag is added behind it, and an end tag cuts it where its name stands
last. Tags whose name never ends anywhere in the page can close nothing and are not kept.
Places are bytes, so a piece is copied from where it lies; what was found is a run of bytes as
well, read once at the end. The page is rebuilt from the pieces between.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# Elements without an end tag.
VOID_TAGS = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr",
)

TOKEN = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>|</?[a-z][^>]*>"
NAME = r"^</?([a-zA-Z][a-zA-Z0-9:-]*)"

Root = Callable[[Column, Column], Column]  # (token, tag name) -> whether its element is looked for


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def _marked_tokens(html: Column, roots: Sequence[Root]) -> Column:
    """Array of what the walk needs of each tag token: its place, name and kind.

    ``gap`` and ``size`` are the bytes of the text before it and of the token itself; the
    last entry is the text behind the last token. ``root0``, ``root1`` and so on tell which of the
    elements that are looked for it opens.
    """
    pairs = F.arrays_zip(
        F.split(html, TOKEN, -1).alias("before"), F.regexp_extract_all(html, F.lit(TOKEN), F.lit(0)).alias("tok")
    )

    def one(x: Column) -> Column:
        return F.struct(
            F.octet_length(x["before"]).alias("gap"), F.coalesce(x["tok"], F.lit("")).alias("tok"),
            F.lower(F.regexp_extract(F.coalesce(x["tok"], F.lit("")), NAME, 1)).alias("name"),
        )

    def two(x: Column) -> Column:
        void = x["name"].isin(*VOID_TAGS)
        ends = x["tok"].startswith("</") & (x["name"] != "")
        raw = x["name"].isin("script", "style") & x["tok"].rlike(r"(?is)</(script|style)\s*>$")
        starts = (x["name"] != "") & ~x["tok"].startswith("</")
        hits = [starts & F.coalesce(root(x["tok"], x["name"]), F.lit(False)) for root in roots]
        return F.struct(
            x["gap"].alias("gap"), F.octet_length(x["tok"]).alias("size"), x["name"].alias("name"), starts.alias("starts"), ends.alias("ends"),
            (ends & ~void).alias("closes"), (starts & (void | x["tok"].endswith("/>") | raw)).alias("whole"),
            *[h.alias(f"root{k}") for k, h in enumerate(hits)],
        )

    return F.transform(F.transform(pairs, one), two)


def _names(tokens: Column, kind: str) -> Column:
    """The names that some token of a kind has."""
    return F.array_distinct(F.transform(F.filter(tokens, lambda x: x[kind]), lambda x: x["name"]))


def _behind(s: Column, x: Column, opened: Column) -> Column:
    """What was opened behind the tag that an end tag closes, as ``name/name/``; NULL if it closes none.

    It is looked for from the end; a name that no tag opens is not looked for.
    """
    open_ = F.concat(F.lit("/"), s["open"].cast("string"))
    rest = F.call_function("substring_index", open_, F.concat(F.lit("/"), x["name"], F.lit("/")), F.lit(-1))
    found = let(rest, lambda r: F.when(F.octet_length(r) <= F.octet_length(s["open"]), r))
    return F.when(x["closes"] & F.array_contains(opened, x["name"]), found)


def _place(s: Column, x: Column, behind: Column) -> Column:
    """The byte of the open tags at which the one that an end tag closes stands; their length if it closes none."""
    size = F.octet_length(s["open"])
    return F.when(behind.isNull(), size).otherwise(size - F.octet_length(behind) - F.octet_length(x["name"]) - 1)


def _open(s: Column, x: Column, place: Column, kept: Column) -> Column:
    return (
        F.when(place < F.octet_length(s["open"]), F.substring(s["open"], F.lit(1), place))
        .when(x["starts"] & ~x["whole"] & kept, F.concat(s["open"], F.concat(x["name"], F.lit("/")).cast("binary")))
        .otherwise(s["open"])
    )


def _numbers(*places: Column) -> Column:
    return F.concat(*[y for p in places for y in (p.cast("string"), F.lit(" "))], F.lit(";")).cast("binary")


def _spans(found: Column) -> Column:
    """Array of (start, inner, end, stop) from a run of written numbers."""
    rows = F.filter(F.split(found.cast("string"), ";"), lambda x: x != "")
    return F.transform(F.transform(rows, lambda x: F.split(x, " ")), lambda n: F.struct(*[
        F.get(n, i).cast("int").alias(c) for i, c in enumerate(("start", "inner", "end", "stop"))]))


def element_spans(html: Column, root: Root) -> Column:
    """Array of (start, inner, end, stop) of the outermost elements whose opening token is a root.

    The inner HTML is between ``inner`` and ``end``; positions are bytes and count from 0.
    """
    zero = F.struct(
        F.lit(0).alias("pos"), F.lit(b"").alias("open"), F.lit(-1).alias("depth"),
        F.lit(0).alias("start"), F.lit(0).alias("inner"), F.lit(b"").alias("spans"),
    )

    def walk(tokens: Column, opened: Column, ended: Column) -> Column:
        def merge(s: Column, x: Column) -> Column:
            return let(_behind(s, x, opened), lambda behind: let(_place(s, x, behind), lambda place: step(s, x, place)))

        def step(s: Column, x: Column, place: Column) -> Column:
            at = s["pos"] + x["gap"]
            after = at + x["size"]
            hit = x["root0"] & (s["depth"] < 0)
            closed = (s["depth"] >= 0) & (place < F.octet_length(s["open"])) & (place <= s["depth"])
            opened = hit & ~x["whole"]
            # its own end tag goes with it, the end tag of an element around it stays
            span = _numbers(s["start"], s["inner"], at, F.when(place == s["depth"], after).otherwise(at))
            return F.struct(
                after.alias("pos"), _open(s, x, place, hit | F.array_contains(ended, x["name"])).alias("open"),
                F.when(closed, F.lit(-1)).when(opened, F.octet_length(s["open"])).otherwise(s["depth"]).alias("depth"),
                F.when(opened, at).otherwise(s["start"]).alias("start"), F.when(opened, after).otherwise(s["inner"]).alias("inner"),
                F.when(closed, F.concat(s["spans"], span))
                .when(hit & x["whole"], F.concat(s["spans"], _numbers(at, after, after, after)))
                .otherwise(s["spans"]).alias("spans"),
            )

        def finish(s: Column) -> Column:
            return F.when(s["depth"] >= 0, F.concat(s["spans"], _numbers(s["start"], s["inner"], s["pos"], s["pos"]))).otherwise(s["spans"])

        return F.aggregate(tokens, zero, merge, finish)

    return _spans(let(_marked_tokens(html, [root]), lambda tokens: let(_names(tokens, "starts"), lambda opened: let(_names(tokens, "closes"), lambda ended: walk(tokens, opened, ended)))))


def _piece(page: Column, start: Column, size: Column) -> Column:
    """Bytes of a page (as binary) as text."""
    return F.substring(page, start + 1, size).cast("string")


def without(html: Column, root: Root) -> Column:
    """The page without the elements whose opening token is a root, nested content included."""

    def rebuilt(page: Column) -> Column:
        def joined(spans: Column) -> Column:
            def kept(k: Column) -> Column:
                since = F.coalesce(F.get(spans, k - 1)["stop"], F.lit(0))
                return _piece(page.cast("binary"), since, F.coalesce(F.get(spans, k)["start"], F.octet_length(page)) - since)

            return F.array_join(F.transform(F.sequence(F.lit(0), F.size(spans)), kept), "")

        return F.when(page.isNotNull(), let(element_spans(page, root), joined))

    return let(html, rebuilt)


def first_inners(html: Column, roots: Sequence[Root]) -> Column:
    """Array of the inner HTML of the first element of each kind, from one walk; NULL without one, or when it is empty."""
    kinds = range(len(roots))
    zero = F.struct(F.lit(0).alias("pos"), F.lit(b"").alias("open"), *[
        F.lit(-1).alias(f"{c}{k}") for k in kinds for c in ("depth", "inner", "end")])

    def walk(tokens: Column, opened: Column, ended: Column) -> Column:
        def merge(s: Column, x: Column) -> Column:
            return let(_behind(s, x, opened), lambda behind: let(_place(s, x, behind), lambda place: step(s, x, place)))

        def step(s: Column, x: Column, place: Column) -> Column:
            at = s["pos"] + x["gap"]
            after = at + x["size"]
            cut = place < F.octet_length(s["open"])
            kept, fields = F.array_contains(ended, x["name"]), []
            for k in kinds:
                opened = x[f"root{k}"] & (s[f"inner{k}"] < 0)
                closed = (s[f"depth{k}"] >= 0) & cut & (place <= s[f"depth{k}"])
                kept = kept | opened
                fields += [
                    F.when(closed | (opened & x["whole"]), F.lit(-1)).when(opened, F.octet_length(s["open"])).otherwise(s[f"depth{k}"]).alias(f"depth{k}"),
                    F.when(opened, after).otherwise(s[f"inner{k}"]).alias(f"inner{k}"),
                    F.when(closed, at).when(opened & x["whole"], after).otherwise(s[f"end{k}"]).alias(f"end{k}"),
                ]
            return F.struct(after.alias("pos"), _open(s, x, place, kept).alias("open"), *fields)

        return F.aggregate(tokens, zero, merge)

    def found(page: Column, s: Column) -> Column:
        ends = [F.when(s[f"depth{k}"] >= 0, s["pos"]).otherwise(s[f"end{k}"]) for k in kinds]
        return F.array(*[
            F.when(s[f"inner{k}"] >= 0, F.nullif(_piece(page.cast("binary"), s[f"inner{k}"], ends[k] - s[f"inner{k}"]), F.lit(""))) for k in kinds])

    def inners(page: Column) -> Column:
        end = let(_marked_tokens(page, roots), lambda tokens: let(_names(tokens, "starts"), lambda opened: let(_names(tokens, "closes"), lambda ended: walk(tokens, opened, ended))))
        return let(end, lambda s: found(page, s))

    return let(html, inners)


def first_inner(html: Column, root: Root) -> Column:
    """Inner HTML of the first element whose opening token is a root; NULL without one, or when it is empty."""
    return F.get(first_inners(html, [root]), 0)


def balanced(html: Column) -> Column:
    """The page with an end tag for every open one, and without end tags that close nothing."""
    zero = F.struct(F.lit(0).alias("pos"), F.lit(0).alias("since"), F.lit(b"").alias("open"), F.lit(b"").alias("edits"))

    def end_tags(names: Column) -> Column:
        tags = F.reverse(F.filter(F.split(names.cast("string"), "/"), lambda n: n != ""))
        return F.array_join(F.transform(tags, lambda n: F.concat(F.lit("</"), n, F.lit(">"))), "")

    def edit(since: Column, start: Column, text: Column) -> Column:
        return F.concat(since.cast("string"), F.lit(" "), start.cast("string"), F.lit(" "), text, F.lit(";")).cast("binary")

    def walk(tokens: Column, opened: Column) -> Column:
        def merge(s: Column, x: Column) -> Column:
            return let(_behind(s, x, opened), lambda behind: let(_place(s, x, behind), lambda place: step(s, x, behind, place)))

        return F.aggregate(tokens, zero, merge, finish)

    def step(s: Column, x: Column, behind: Column, place: Column) -> Column:
        at = s["pos"] + x["gap"]
        after = at + x["size"]
        inside = F.coalesce(behind != "", F.lit(False))
        stray = x["ends"] & behind.isNull()
        return F.struct(
            after.alias("pos"), F.when(inside, at).when(stray, after).otherwise(s["since"]).alias("since"), _open(s, x, place, F.lit(True)).alias("open"),
            F.when(inside, F.concat(s["edits"], edit(s["since"], at, end_tags(behind))))
            .when(stray, F.concat(s["edits"], edit(s["since"], at, F.lit(""))))
            .otherwise(s["edits"]).alias("edits"),
        )

    def finish(s: Column) -> Column:
        return F.concat(s["edits"], edit(s["since"], s["pos"], end_tags(s["open"])))

    def joined(page: Column, edits: Column) -> Column:
        rows = F.transform(F.filter(F.split(edits.cast("string"), ";"), lambda x: x != ""), lambda x: F.split(x, " "))
        return F.array_join(F.transform(rows, lambda e: F.concat(
            _piece(page.cast("binary"), F.get(e, 0).cast("int"), F.get(e, 1).cast("int") - F.get(e, 0).cast("int")), F.get(e, 2))), "")

    def rebuilt(page: Column) -> Column:
        return F.when(page.isNotNull(), joined(page, let(_marked_tokens(page, []), lambda tokens: let(_names(tokens, "starts"), lambda opened: walk(tokens, opened)))))

    return let(html, rebuilt)
