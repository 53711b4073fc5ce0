"""Page jobs over the whole ``pages`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vacancia.catalog.registry import Tables, pick, query, sql_pick
from vacancia.functions import text as X
from vacancia.functions.noise import closed_structural_html, without_classes
from vacancia.operators.resolve import one_per_key
from vacancia.plans.audit import location_mentions
from vacancia.plans.cycle import commit_cycle, from_detail_pages, run_cycle
from vacancia.session import scratch_path
from vacancia.sources import adapters as A
from vacancia.sources.adapters import page_links
from vacancia.sources.tables import read_appended

_BARE = "html"
for _tag in X.BOILERPLATE_TAGS:
    _BARE = rf"regexp_replace({_BARE}, '(?is)<{_tag}\b[^>]*>.*?</{_tag}\s*>', '', 'g')"
_ARTICLE = rf"nullif(regexp_extract({_BARE}, '(?is)<article\b[^>]*>(.*)</article\s*>', 1), '')"
_TEXT = r"regexp_replace(regexp_replace(X, '(?s)<!--.*?-->', '', 'g'), '(?s)<[^>]*>', '', 'g')"
CONTAINERS = ((r"<main\b[^>]*>", "main"), (r"<article\b[^>]*>", "article"))


@query("page_links", r"""
    WITH l AS (SELECT page_id, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a\s*>', 1)) AS href,
                      unnest(regexp_extract_all(html, '(?is)<a\b[^>]*?href="([^"]*)"[^>]*>(.*?)</a\s*>', 2)) AS raw FROM pages)
    SELECT page_id, href, trim(regexp_replace(regexp_replace(raw, '(?s)<[^>]*>', '', 'g'), '\s+', ' ', 'g')) AS label, count(*) AS n
    FROM l GROUP BY 1, 2, 3
""")
def links_of_pages(t: Tables) -> DataFrame:
    return page_links(t("pages"), carry=["page_id"]).groupBy("page_id", "href", "label").agg(F.count(F.lit(1)).alias("n"))


@query("page_boilerplate", f"SELECT page_id, md5({_BARE}) AS digest, CAST(length({_BARE}) AS BIGINT) AS n FROM pages")
def page_boilerplate(t: Tables) -> DataFrame:
    bare = X.without_elements("html")
    return t("pages").select("page_id", F.md5(bare).alias("digest"), F.length(bare).cast("bigint").alias("n"))


@query("page_content", f"""
    SELECT page_id, md5(trim(regexp_replace({_TEXT.replace('X', 'c')}, '\\s+', ' ', 'g'))) AS digest
    FROM (SELECT page_id, coalesce(CASE WHEN length(trim(regexp_replace({_TEXT.replace('X', _ARTICLE)}, '\\s+', ' ', 'g'))) > 100 THEN {_ARTICLE} END,
            nullif(regexp_extract({_BARE}, '(?is)<body\\b[^>]*>(.*)</body\\s*>', 1), ''),
            nullif(regexp_extract({_BARE}, '(?is)<body\\b[^>]*>(.*)', 1), ''), {_BARE}) AS c FROM pages)
""")
def page_content(t: Tables) -> DataFrame:
    out = X.with_page_content(t("pages").select("page_id", "html"), "html", "content", CONTAINERS)
    return out.select("page_id", F.md5(X.collapse(X.page_text("content"))).alias("digest"))


_KEEP = "|".join(sorted(X.STRUCTURAL_TAGS, key=len, reverse=True))
# the SQL engine has no look-ahead: kept tags are marked first, then the others go
_STRUCT = r"regexp_replace(html, '(?s)<!--.*?-->', '', 'g')"
_STRUCT = rf"regexp_replace({_STRUCT}, '(?i)<![a-z][^>]*>|</br\s*>', '', 'g')"
_STRUCT = rf"regexp_replace({_STRUCT}, '(?i)<(/?)({_KEEP})\b[^>]*>', chr(1) || '\1\2' || chr(2), 'g')"
_STRUCT = rf"regexp_replace({_STRUCT}, '(?i)</?[a-z][^>]*>', '', 'g')"
_STRUCT = f"replace(replace({_STRUCT}, chr(1), '<'), chr(2), '>')"
_STRUCT = f"regexp_replace({_STRUCT}, '(?i)<br>', '<br></br>', 'g')"
for _entity, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&apos;", "''"),
                       ("&ndash;", "–"), ("&mdash;", "—"), ("&rsquo;", "’"), ("&bull;", "•"), ("&amp;", "&")):
    _STRUCT = f"replace({_STRUCT}, '{_entity}', '{_char}')"
_STRUCT = f"regexp_replace(regexp_replace({_STRUCT}, '[ \\t]+', ' ', 'g'), '\\n{{3,}}', chr(10) || chr(10), 'g')"


@query("page_structure", f"SELECT page_id, md5(trim({_STRUCT}, chr(32) || chr(9) || chr(10) || chr(13) || chr(160))) AS digest FROM pages")
def page_structure(t: Tables) -> DataFrame:
    return t("pages").select("page_id", F.md5(X.structural_html("html")).alias("digest"))


@query("page_structure_closed", r"""
    SELECT page_id, CAST(len(regexp_extract_all(html, '(?i)<p\b')) AS INTEGER) AS paragraphs,
           CAST(len(regexp_extract_all(html, '(?i)<b>')) AS INTEGER) AS bolds, true AS closed
    FROM pages
""")
def page_structure_closed(t: Tables) -> DataFrame:
    out = t("pages").select("page_id", closed_structural_html(X.without_elements("html", ("script", "style"))).alias("c"))
    count = lambda tag: F.regexp_count("c", F.lit(tag))
    closed = (count("<p>") == count("</p>")) & (count("<b>") == count("</b>")) & (count("<li>") == count("</li>"))
    return out.select("page_id", count("<p>").alias("paragraphs"), count("<b>").alias("bolds"), closed.alias("closed"))


@query("page_class_noise", r"""
    SELECT page_id, md5(regexp_replace(html, '(?is)<div class="ad">.*?</div>', '', 'g')) AS digest FROM pages
""")
def page_class_noise(t: Tables) -> DataFrame:
    return t("pages").select("page_id", F.md5(without_classes("html", ("ad",))).alias("digest"))


# A page made of pieces: the text of one container, with furniture nested in furniture around it,
# a second container behind it, and boxes nested in a box of the noise class.
_BODY = "'Body of ' || repeat(url || ' ', 5)"


def _pieces() -> tuple[F.Column, F.Column]:
    body = F.concat(F.lit("Body of "), F.repeat(F.concat("url", F.lit(" ")), 5))
    page = F.concat(
        F.lit('<html><body><nav>top<nav>deep</nav>rest</nav><div class="main job"><div><p>'), body, F.lit("</p></div>tail"),
        F.lit('<aside><div>side</div></aside></div><div class="ad box"><div>in</div><p>open</div><div class="main job">similar jobs '), "url",
        F.lit("</div><footer><header>x</header></footer></body></html>"))
    return body, page


@query("page_nested_content", f"SELECT page_id, md5(trim({_BODY}) || 'tail') AS digest FROM pages")
def page_nested_content(t: Tables) -> DataFrame:
    rows = t("pages").select("page_id", _pieces()[1].alias("page"))
    out = X.with_page_content(rows, "page", "content", ((r'<div class="main[^>]*>', "div"),))
    return out.select("page_id", F.md5(F.regexp_replace(X.collapse(X.page_text("content")), r" tail$", "tail")).alias("digest"))


@query("page_nested_boilerplate", f"""
    SELECT page_id, md5('<html><body><div class="main job"><div><p>' || {_BODY} || '</p></div>tail</div><div class="ad box"><div>in</div><p>open</div><div class="main job">similar jobs '
                        || url || '</div></body></html>') AS digest FROM pages
""")
def page_nested_boilerplate(t: Tables) -> DataFrame:
    return t("pages").select("page_id", F.md5(X.without_elements(_pieces()[1])).alias("digest"))


@query("page_nested_noise", f"""
    SELECT page_id, md5('<html><body><nav>top<nav>deep</nav>rest</nav><div class="main job"><div><p>' || {_BODY} || '</p></div>tail<aside><div>side</div></aside></div>'
                        || '<div class="main job">similar jobs ' || url || '</div><footer><header>x</header></footer></body></html>') AS digest FROM pages
""")
def page_nested_noise(t: Tables) -> DataFrame:
    return t("pages").select("page_id", F.md5(without_classes(_pieces()[1], ("ad ",))).alias("digest"))


REMOTE = ["Remote", "Hybrid", "On-site", None]
TIMES = ["Full time", "Part time", None]


def _detail_pages(t: Tables) -> DataFrame:
    """Postings' own pages around the given ones: labels, pay in a label or only in the text, nested furniture."""
    k = F.col("page_id")
    label = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"<dt>{name}</dt><dd> "), value, F.lit("</dd>"))).otherwise("")
    pay = F.when(k % 3 == 0, F.concat(F.lit("$"), 20 + k % 30, F.lit(".125 - $"), 60 + k % 30, F.lit(" per hour")))
    text = F.concat(F.lit("About the job "), F.repeat(F.concat("url", F.lit(" ")), 6), F.when(k % 3 == 1, F.concat(F.lit("$"), 50000 + k, F.lit(" - $60,000 USD"))).otherwise(""))
    page = F.concat(
        F.lit("<html><body><header><div>top</div></header><span>R"), 100000 + k, F.lit("</span><dl>"), label("Remote Type", pick(REMOTE, k)),
        label("time type", pick(TIMES, k)), label("Pay Range", pay), F.lit('</dl><div data-automation-id="jobPostingDescription" class="x"><div><p class="y">'), text,
        F.lit('</p><nav>n<nav>m</nav></nav></div></div><div class="similar">similar jobs $1 - $2 USD</div></body></html>'))
    return t("pages").select("page_id", F.concat(F.lit("http://p.example.com/"), k).alias("posting_url"), page.alias("html"))


_DETAIL_SQL = f"""
    SELECT page_id, 'http://p.example.com/' || page_id AS posting_url, 'R' || (100000 + page_id) AS posting_id,
           {sql_pick(['Full-time', 'Part-time', None], 'page_id')} AS job_type, {sql_pick(['Remote', 'Hybrid', 'On-site', None], 'page_id')} AS office_location,
           CAST(CASE page_id % 3 WHEN 0 THEN (20 + page_id % 30 + 0.125) * 2080 WHEN 1 THEN 50000 + page_id ELSE 1 END AS DOUBLE) AS minimum_salary,
           CAST(CASE page_id % 3 WHEN 0 THEN (60 + page_id % 30) * 2080 WHEN 1 THEN 60000 ELSE 2 END AS DOUBLE) AS maximum_salary,
           md5('<p>About the job ' || repeat(url || ' ', 6) || CASE WHEN page_id % 3 = 1 THEN '$' || (50000 + page_id) || ' - $60,000 USD' ELSE '' END || '</p>') AS digest
    FROM pages
"""


def _detail_columns(df: DataFrame, *first: str) -> DataFrame:
    return df.select(
        *first, "posting_url", "posting_id", "job_type", "office_location", F.col("minimum_salary").cast("double").alias("minimum_salary"),
        F.col("maximum_salary").cast("double").alias("maximum_salary"), F.md5("job_description").alias("digest"))


@query("workday_detail", _DETAIL_SQL)
def workday_detail(t: Tables) -> DataFrame:
    return _detail_columns(A.workday_detail(_detail_pages(t), carry=["page_id", "posting_url"]), "page_id")


@query("cycle_detail_content", f"""
    WITH d AS ({_DETAIL_SQL})
    SELECT (SELECT max(page_id) FROM pages WHERE page_id % 4 = 0) + row_number() OVER (ORDER BY md5(CAST(page_id % 10 AS VARCHAR) || chr(31) || posting_url)) AS id,
           d.* EXCLUDE (page_id) FROM d WHERE page_id % 4 <> 0
""")
def cycle_detail_content(t: Tables) -> DataFrame:
    # every fourth page is of a posting that is stored already; each page landed twice, the second time empty
    company, k = (F.col("page_id") % 10).cast("bigint"), F.col("page_id")
    pages = _detail_pages(t)
    state = pages.where(k % 4 == 0).select(
        k.alias("id"), company.alias("company_id"), "posting_url", F.lit("active").alias("job_status"), *[
            F.lit("2001-01-01 00:00:00").cast("timestamp_ntz").alias(c) for c in ("created_at", "updated_at", "last_scraped")],
        F.lit(None).cast("date").alias("date_closed"))
    feed = pages.select(company.alias("company_id"), F.lit("Welder").alias("job_title"), "posting_url", F.lit("board").alias("source_job_board"))
    companies = feed.select(F.col("company_id").alias("id")).distinct().withColumn("last_full_scrape_completed", F.lit(None).cast("timestamp_ntz"))
    landed = pages.withColumn("pos", F.lit(1)).unionByName(pages.select("page_id", "posting_url", F.lit("").alias("html"), F.lit(2).alias("pos")))
    root = scratch_path(t.spark, "cycle")
    commit_cycle(t.spark, root, run_cycle(state, feed, companies, "2002-01-01 12:00:00", enrich=from_detail_pages(landed, ["pos"])))
    return _detail_columns(read_appended(t.spark, root, "content"), "id")


# Pages of three families: every third one each.
_FAMILIES = f"""
    SELECT page_id, 'http://p.example.com/' || page_id AS posting_url,
           CASE page_id % 3 WHEN 0 THEN {sql_pick(['Full-time', 'Part-time', None], 'page_id // 3')} END AS job_type,
           CASE page_id % 3 WHEN 0 THEN {sql_pick(['Remote', 'Hybrid', 'On-site', None], 'page_id // 3')} END AS office_location,
           CASE WHEN page_id % 3 = 0 THEN CAST(20000 + page_id AS DOUBLE) END AS minimum_salary,
           CASE WHEN page_id % 3 = 0 THEN CAST(30000 AS DOUBLE) END AS maximum_salary,
           md5(CASE page_id % 3 WHEN 0 THEN '<p>Duties ' || url || '</p>' WHEN 1 THEN trim(repeat('About ' || url || ' ', 9)) END) AS digest
    FROM pages
"""


def _family_pages(t: Tables) -> DataFrame:
    k = F.col("page_id")
    part = lambda values: pick(values, F.floor(k / 3))
    label = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f'<div class="iCIMS_JobHeaderTag"><dt class="iCIMS_JobHeaderField">{name}</dt><dd class="iCIMS_JobHeaderData"> '), value, F.lit("</dd></div>"))).otherwise("")
    one = F.concat(
        F.lit('<html><body><dl>'), label("Employment Status", part(TIMES)), label("&nbsp;", part(REMOTE)),
        F.lit("<dt>Posted Range</dt><dd>$"), 20000 + k, F.lit(' to $30,000</dd></dl><div class="wide iCIMS_JobContainer"><div><p class="x">Duties '), "url",
        F.lit("</p></div></div><p>other jobs</p></body></html>"))
    two = F.concat(F.lit('<html><body><nav>menu</nav><div class="jobDisplay"><h1></h1>'), F.repeat(F.concat(F.lit("<p>About "), "url", F.lit("</p>\n")), 9), F.lit("</div><footer>f</footer></body></html>"))
    page = F.when(k % 3 == 0, one).when(k % 3 == 1, two).otherwise("<html><body>short</body></html>")
    family = F.when(k % 3 == 0, "icims").when(k % 3 == 1, "text").otherwise("unknown")
    return t("pages").select("page_id", F.concat(F.lit("http://p.example.com/"), k).alias("posting_url"), page.alias("html"), family.alias("family"))


@query("cycle_detail_families", f"SELECT * EXCLUDE (page_id) FROM ({_FAMILIES})")
def cycle_detail_families(t: Tables) -> DataFrame:
    pages = _family_pages(t)
    feed = pages.select((F.col("page_id") % 10).cast("bigint").alias("company_id"), F.lit("Welder").alias("job_title"), "posting_url", F.lit("board").alias("source_job_board"))
    companies = feed.select(F.col("company_id").alias("id")).distinct().withColumn("last_full_scrape_completed", F.lit(None).cast("timestamp_ntz"))
    time = F.lit(None).cast("timestamp_ntz")
    state = pages.limit(0).select(
        F.lit(0).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("company_id"), "posting_url", F.lit("active").alias("job_status"),
        time.alias("created_at"), time.alias("updated_at"), time.alias("last_scraped"), F.lit(None).cast("date").alias("date_closed"))
    cycle = run_cycle(state, feed, companies, "2002-01-01 12:00:00", enrich=from_detail_pages(pages, adapter=A.DETAIL_ADAPTERS))
    return cycle.content.select(
        "posting_url", "job_type", "office_location", F.col("minimum_salary").cast("double").alias("minimum_salary"),
        F.col("maximum_salary").cast("double").alias("maximum_salary"), F.md5("job_description").alias("digest"))


@query("two_stage_filter", f"""
    SELECT page_id, {sql_pick(['Contains city', 'Multi-location'], 'page_id // 2')} AS reason FROM pages
    WHERE page_id % 2 = 0 AND contains(lower({_TEXT.replace('X', _BARE)}), 'the')
""")
def two_stage_filter(t: Tables) -> DataFrame:
    # the coarse test runs on the listing text, and only its rows have their pages read
    place = pick(["Tulsa HQ", "Houston", "3 Locations", "Austin"], F.col("page_id"))
    low = F.lower(place)
    coarse = t("pages").where(location_mentions(place, ("tulsa", "locations")))
    checked = coarse.where(location_mentions(X.page_text(X.without_elements("html")), ("the",)))
    return checked.select("page_id", F.when(low.contains("tulsa"), "Contains city").otherwise("Multi-location").alias("reason"))


@query("description_links", r"""
    SELECT page_id, CASE WHEN page_id % 2 = 0 THEN regexp_extract(html, '(?is)<a\b[^>]*?href="([^"]+)"', 1) END AS href FROM pages
""")
def description_links(t: Tables) -> DataFrame:
    marked = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit('<a href="/before">x</a><p>Full Job  </p>FULL JOB description: '), "html")).otherwise(F.col("html"))
    return t("pages").select("page_id", X.link_after(marked, "full job description").alias("href"))


@query("document_ids", """
    SELECT page_id, CASE WHEN page_id % 4 < 3 THEN 'Ab_' || page_id || '-z' END AS document_id FROM pages
""")
def document_ids(t: Tables) -> DataFrame:
    ident = F.concat(F.lit("Ab_"), F.col("page_id").cast("string"), F.lit("-z"))
    url = F.element_at(F.array(
        F.concat(F.lit("https://d.example.com/document/d/"), ident, F.lit("/edit")),
        F.concat(F.lit("https://d.example.com/file/d/"), ident, F.lit("/view?id=no")),
        F.concat(F.lit("https://d.example.com/open?x=1&id="), ident), F.concat(F.lit("https://d.example.com/folder/"), ident),
    ), (F.col("page_id") % 4 + 1).cast("int"))
    return t("pages").select("page_id", X.shared_document_id(url).alias("document_id"))


@query("binary_kinds", """
    SELECT CASE WHEN lang = 'en' THEN 'pdf' WHEN lang = 'fr' THEN 'docx' END AS kind, count(*) AS n FROM documents GROUP BY 1
""")
def binary_kinds(t: Tables) -> DataFrame:
    head = F.when(F.col("lang") == "en", "%PDF-1.7 ").when(F.col("lang") == "fr", "PK").otherwise(" PK%PDF-")
    content = F.encode(F.concat(head, "text"), "UTF-8")
    return t("documents").groupBy(X.file_kind(content).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


@query("pages_without_stored_url", r"""
    SELECT page_id FROM pages WHERE regexp_extract(url, '^https?://([^/?#]+)', 1) NOT IN
      (SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) FROM pages WHERE contains(url, 'utm_source'))
""")
def pages_without_stored_url(t: Tables) -> DataFrame:
    host = F.try_parse_url("url", F.lit("HOST"))
    pages = t("pages").select("page_id", host.alias("host"))
    stored = t("pages").where(F.contains("url", F.lit("utm_source"))).select(host.alias("host"), "page_id")
    return pages.join(one_per_key(stored, ["host"], "page_id").select("host"), "host", "left_anti").select("page_id")
