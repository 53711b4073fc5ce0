"""The walk over a page's tags against a plain parser, label lists, and time in proportion to the tags."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from vacancia.functions import elements as E, noise, text as X

TOKEN = re.compile(r"<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>|</?[a-z][^>]*>", re.I | re.S)


def walked(page, roots):
    """Outermost spans of each kind of element, by a stack of open tags."""
    out = []
    for root in roots:
        open_, spans, hit = [], [], None
        for m in TOKEN.finditer(page):
            tok = m[0]
            name = (re.match(r"</?([a-zA-Z][a-zA-Z0-9:-]*)", tok) or [None, ""])[1].lower()
            if not name:
                continue
            void = name in E.VOID_TAGS
            if tok.startswith("</"):
                at = max((k for k, x in enumerate(open_) if x == name), default=None)
                if void or at is None:
                    continue
                if hit and at <= hit[0]:
                    spans.append((*hit[1:], m.start(), m.end() if at == hit[0] else m.start()))
                    hit = None
                del open_[at:]
                continue
            whole = void or tok.endswith("/>") or (name in ("script", "style") and re.search(r"</(script|style)\s*>$", tok, re.I))
            if name == root and hit is None:
                if whole:
                    spans.append((m.start(), m.end(), m.end(), m.end()))
                else:
                    hit = (len(open_), m.start(), m.end())
            if not whole:
                open_.append(name)
        if hit:
            spans.append((*hit[1:], len(page), len(page)))
        out.append(spans)
    return out


def closed(page):
    """The page with all end tags that are missing and without those that close nothing."""
    open_, out, last = [], "", 0
    for m in TOKEN.finditer(page):
        tok = m[0]
        name = (re.match(r"</?([a-zA-Z][a-zA-Z0-9:-]*)", tok) or [None, ""])[1].lower()
        out += page[last : m.start()]
        last = m.end()
        if name and tok.startswith("</"):
            at = max((k for k, x in enumerate(open_) if x == name), default=None)
            if name not in E.VOID_TAGS and at is not None:
                out += "".join(f"</{x}>" for x in reversed(open_[at + 1 :])) + tok
                del open_[at:]
            continue
        out += tok
        whole = name in E.VOID_TAGS or tok.endswith("/>") or (name in ("script", "style") and re.search(r"</(script|style)\s*>$", tok, re.I))
        if name and not whole:
            open_.append(name)
    return out + page[last:] + "".join(f"</{x}>" for x in reversed(open_))


def soup(seed, n):
    rng = random.Random(seed)
    names = ["div", "p", "nav", "main", "b", "li", "x-y:z", "br"]
    kinds = [lambda t: f"<{t}>", lambda t: f"</{t}>", lambda t: f'<{t} class="é {t}">', lambda t: f"</{t} >", lambda t: f"<{t}/>", lambda t: "ünï text ", lambda t: "<!-- </div><nav> -->",
             lambda t: "<script>if (a</b> 1) '<nav>'</script>", lambda t: "a < b; c > d ", lambda t: t.upper().join(("<", ">"))]
    return "".join(rng.choice(kinds)(rng.choice(names)) for _ in range(n))


@pytest.fixture(scope="module")
def pages(spark):
    texts = [soup(k, 5 + 3 * k) for k in range(60)] + ["", "plain", "<nav>", "</nav>", "<nav><nav></nav>", "<div><nav></div>rest</nav>"]
    return texts, spark.createDataFrame(list(enumerate(texts)), "k int, html string")


def test_spans_are_those_of_a_stack(pages):
    texts, df = pages
    got = {r.k: r for r in df.select("k", X.without_elements("html", ("nav",)).alias("bare"), E.first_inners(F.col("html"), [lambda tok, name, n=n: name == n for n in ("nav", "main", "li")]).alias("first")).collect()}
    for k, page in enumerate(texts):
        nav, main, li = walked(page, ["nav", "main", "li"])
        pieces, last = [], 0
        for start, _, _, stop in nav:
            pieces.append(page[last:start])
            last = stop
        assert got[k].bare == "".join(pieces) + page[last:], page
        assert got[k].first == [(page[s[0][1] : s[0][2]] or None) if s else None for s in (nav, main, li)], page


def test_end_tags_are_those_of_a_stack(pages):
    texts, df = pages
    got = {r.k: r.html for r in df.select("k", E.balanced(F.col("html")).alias("html")).collect()}
    assert got == {k: closed(page) for k, page in enumerate(texts)}


def test_null_pages(spark):
    row = spark.createDataFrame([(None,)], "html string").select(X.without_elements("html").alias("a"), E.balanced(F.col("html")).alias("b"), E.first_inner(F.col("html"), lambda tok, name: name == "p").alias("c")).first()
    assert tuple(row) == (None, None, None)


@pytest.mark.parametrize("parts", [[("<div><p>", 1)], [("<div>", 1), ("<p>x</p>", 1), ("</div>", 0)]], ids=["unclosed", "pile"])
def test_time_grows_with_the_tags(spark, parts):
    def took(n):
        page = F.concat(*[F.expr(f"repeat('{t}', {n if k else 1} + cast(id AS int))") for t, k in parts])
        df = spark.range(1).select(page.alias("html"))
        runs = []
        for _ in range(2):
            t0 = time.time()
            df.select(F.length(X.without_elements("html")), F.length(noise.balanced(F.col("html")))).collect()
            runs.append(time.time() - t0)
        return min(runs)

    took(2000)
    # ten times the tags of a page with everything left open; a square would take a hundred times as long
    assert took(40_000) < 30 * max(took(4000), 0.3)


@pytest.mark.parametrize("html, expected", [
    ("<dl><dt>A</dt><dd>1</dd></dl>", {"a": "1"}), ("<dl><dt>A<dd>1<dt>B<dd>2</dl>", {"a": "1", "b": "2"}),
    ("<dl><dt>A</dt><dt>B</dt><dd>1</dd><dd>2</dd></dl>", {"a": "1", "b": "1"}), ("<dl><dt>A</dt></dl><dd>1</dd>", {}),
    ("<dl><dt>A</dt><dd>x<dl><dt>B</dt><dd>1</dd></dl>y</dd><dt>C</dt><dd>2</dd></dl>", {"a": "xB1y", "b": "1", "c": "2"}),
    ("<dl><dt>A</dt><!-- <dd>no</dd> --><dd>1</dd></dl>", {"a": "1"}), ("<dt>A<dd>1", {"a": "1"}), ("</dl></dd><dt>A</dt><dd/>", {"a": ""}),
    ("<dl><dt>A</dt><dd>1</dd><dt>a </dt><dd>2</dd></dl>", {"a": "1"}), ("<dlx><dt>A</dt><ddx>1</ddx></dlx>", {}), ("", {}), (None, None),
    ("<DL><DT CLASS='x'>A&nbsp;</DT><DD id=1><b>1</b> &amp; 2</DD></DL>", {"a": "1 & 2"}),
])
def test_label_lists(spark, html, expected):
    assert spark.createDataFrame([(html,)], "html string").select(X.label_values("html").alias("m")).first()["m"] == expected


def test_label_lists_cut_a_page_once(spark):
    """Every token used to split the whole page again: minutes for a page of so many labels."""
    page = "<dl>" + "".join(f"<dt>K{k}</dt><dd>v{k} &amp; more</dd>" for k in range(2000)) + "</dl>"
    df = spark.createDataFrame([(page,)], "html string").select(X.label_values("html").alias("m"))
    t0 = time.time()
    found = df.first()["m"]
    assert found == {f"k{k}": f"v{k} & more" for k in range(2000)}
    assert time.time() - t0 < 15
