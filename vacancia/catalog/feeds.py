"""Feed adapters over documents that the given tables are rendered to.

Each query renders its rows to the JSON or HTML shape of a source, reads that text with
the reader of the source and adapts it; the SQL states the canonical rows directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vacancia import schema as S
from vacancia.catalog.registry import Tables, as_double, day_text, pick, query, sql_pick
from vacancia.functions import text as X
from vacancia.functions.categories import FUNCTION_NAMES
from vacancia.operators import resolve
from vacancia.operators.merge import complete_companies
from vacancia.sources import adapters as A, feeds, tables

AS_OF = "2002-01-01 12:00:00"
PAGE = 20  # fixed value: postings per listing page

TITLES = ["Web Developer", "Welder II", "Sales Rep", "Cook", "HR Generalist"]
FUNCTIONS = ["Information Technology", "Skilled Trades", "Sales", "Other", "Human Resources"]
# the same titles by the rules of an equipment maker and of a school district
MAKER_FUNCTIONS = ["Information Technology", "Manufacturing", "Sales", "Other", "Human Resources"]
SCHOOL_FUNCTIONS = ["Other", "Other", "Other", "Hospitality", "Human Resources"]
PLACES = ["Tulsa, OK", "Remote - USA", "Sand Springs", "4 Locations", None]
CITIES = ["Tulsa", None, "Sand Springs", None, None]
SQL_TITLE = sql_pick(TITLES, "o_orderkey")
SQL_FUNCTION = sql_pick(FUNCTIONS, "o_orderkey")
SQL_DAY = "strftime(o_orderdate, '%Y-%m-%d')"


def order_key() -> Column:
    return F.col("o_orderkey")


def ident() -> Column:
    return order_key().cast("string")


def title() -> Column:
    return pick(TITLES, order_key())


def _pages(rows: DataFrame, posting: Column, container: str, *, page: Column | None = None) -> DataFrame:
    """Listing documents as JSON texts, a bounded number of postings each."""
    number = F.floor(order_key() / PAGE).cast("int") if page is None else page
    docs = rows.select(number.alias("page"), posting.alias("p")).groupBy("page").agg(
        F.collect_list("p").alias(container), F.count(F.lit(1)).cast("int").alias("total"))
    return docs.select("page", F.to_json(F.struct("page", "total", container)).alias("doc"))


@query("feed_workday", f"""
    SELECT o_orderkey, {SQL_TITLE} AS job_title, 'https://w.example.com/Careers/job/' || o_orderkey AS posting_url,
           strftime(DATE '2002-01-01' - CAST(o_orderkey % 30 AS INTEGER), '%Y-%m-%d') AS date_posted,
           coalesce({sql_pick(CITIES, 'o_orderkey')}, 'Tulsa') AS city_name,
           CASE WHEN o_orderkey % 5 = 1 THEN 'Remote' ELSE 'On-site' END AS office_location, {SQL_FUNCTION} AS function
    FROM orders WHERE o_orderstatus <> 'P'
""")
def feed_workday(t: Tables) -> DataFrame:
    path = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("/job/"), ident())).otherwise("")
    posting = F.struct(
        title().alias("title"), path.alias("externalPath"), pick(PLACES, order_key()).alias("locationsText"),
        F.concat(F.lit("Posted "), (order_key() % 30).cast("string"), F.lit(" Days Ago")).alias("postedOn"))
    docs = feeds.parse_documents(_pages(t("orders"), posting, "jobPostings").select("doc"), "doc", S.FEED_WORKDAY)
    out = A.workday(feeds.read_workday(docs), "https://w.example.com/Careers", AS_OF)
    return out.select(
        F.split_part("posting_url", F.lit("/job/"), F.lit(2)).cast("bigint").alias("o_orderkey"),
        "job_title", "posting_url", day_text("date_posted").alias("date_posted"), "city_name", "office_location", "function")


ADP_PLACES = ["Broken Arrow", " tulsa ", "Austin", None]
ADP_CITIES = ["Broken Arrow", "Tulsa", "Owasso", "Owasso"]
ADP_TITLES = ["Entry Level Position Packer", "Operator NIGHTS", "Clerk DAYS", "Cook"]


def _adp(t: Tables, dated: bool) -> DataFrame:
    external = F.when(F.col("o_orderstatus") != "P", ident())
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'08:30:00'Z'")
    field = lambda code, value: F.struct(F.struct(F.lit(code).alias("codeValue")).alias("nameCode"), value.alias("stringValue"))
    date_field = F.struct(F.struct(F.lit("PostingDate").alias("codeValue")).alias("nameCode"), iso.alias("dateValue"))
    place = lambda city, short: F.struct(
        F.struct(short.alias("shortName")).alias("nameCode"), F.struct(city.alias("cityName")).alias("address"))
    salary = lambda c: F.struct(c.cast("decimal(18,2)").alias("amountValue"))
    posting = F.struct(
        pick(ADP_TITLES, order_key()).alias("requisitionTitle"), F.concat(F.lit("R"), ident()).alias("clientRequisitionID"),
        iso.alias("postDate") if not dated else F.lit("junk").alias("postDate"),
        F.struct(pick(["Full Time", "prn", None], order_key()).alias("shortName")).alias("workLevelCode"),
        F.struct(salary(F.col("o_totalprice")).alias("minimumRate"),
                 F.when(order_key() % 2 == 0, salary(F.col("o_totalprice") * 2)).alias("maximumRate")).alias("payGradeRange"),
        F.struct(
            F.array(field("Other", F.lit("x")), field("ExternalJobID", external), field("ExternalJobID", F.lit("late"))).alias("stringFields"),
            F.when(F.lit(dated), F.array(date_field)).alias("dateFields")).alias("customFieldGroup"),
        F.array(place(F.lit("Dallas"), F.lit("Texas")), place(pick(ADP_PLACES, order_key()), F.lit("Owasso plant"))).alias("requisitionLocations"))
    docs = feeds.parse_documents(_pages(t("orders"), posting, "jobRequisitions").select("doc"), "doc", S.FEED_ADP)
    out = A.adp(feeds.read_adp(docs), "https://a.example.com/r?cid=1", dated_field=dated)
    return out.select(
        F.col("external_job_id").cast("bigint").alias("o_orderkey"), "job_title", "posting_id", "posting_url",
        day_text("date_posted").alias("date_posted"), as_double("minimum_salary").alias("minimum_salary"),
        as_double("maximum_salary").alias("maximum_salary"), "job_type", "experience_id", "first_shift", "third_shift", "city_name")


_ADP_SQL = f"""
    SELECT o_orderkey, {sql_pick(['Packer', 'Operator', 'Clerk', 'Cook'], 'o_orderkey')} AS job_title, 'R' || o_orderkey AS posting_id,
           'https://a.example.com/r?cid=1&jobId=' || o_orderkey AS posting_url, {SQL_DAY} AS date_posted,
           CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS minimum_salary,
           CASE WHEN o_orderkey % 2 = 0 THEN CAST(CAST(o_totalprice * 2 AS DECIMAL(18,2)) AS DOUBLE) END AS maximum_salary,
           {sql_pick(['Full-time', 'As Needed', None], 'o_orderkey')} AS job_type,
           CASE WHEN o_orderkey % 4 = 0 THEN 1 END AS experience_id, o_orderkey % 4 = 2 AS first_shift, o_orderkey % 4 = 1 AS third_shift,
           {sql_pick(ADP_CITIES, 'o_orderkey')} AS city_name
    FROM orders WHERE o_orderstatus <> 'P'
"""


@query("feed_adp", _ADP_SQL)
def feed_adp(t: Tables) -> DataFrame:
    return _adp(t, dated=False)


@query("feed_adp_dated", _ADP_SQL)
def feed_adp_dated(t: Tables) -> DataFrame:
    return _adp(t, dated=True)


@query("feed_lever", f"""
    SELECT o_orderkey, {SQL_TITLE} AS job_title, 'https://l.example.com/x/' || o_orderkey AS posting_url,
           '<p>Work on <b>' || o_orderpriority || '</b></p>' AS job_description, {SQL_DAY} AS date_posted,
           {sql_pick(MAKER_FUNCTIONS, 'o_orderkey')} AS function, {sql_pick(CITIES, 'o_orderkey')} AS city_name
    FROM orders WHERE {sql_pick(CITIES, 'o_orderkey')} IS NOT NULL
""")
def feed_lever(t: Tables) -> DataFrame:
    doc = F.to_json(F.struct(
        ident().alias("id"), title().alias("text"),
        F.concat(F.lit('<p class="x">Work on <span><b id="1">'), "o_orderpriority", F.lit("</b></span></p>")).alias("description"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("createdAt"),
        F.struct(pick(PLACES, order_key()).alias("location"), pick([None, "ops"], order_key()).alias("team"), F.lit("lab").alias("department")).alias("categories")))
    out = A.lever(feeds.parse_documents(t("orders").select(doc.alias("doc")), "doc", S.FEED_LEVER), "https://l.example.com/x")
    return out.select(
        F.split_part("posting_url", F.lit("/x/"), F.lit(2)).cast("bigint").alias("o_orderkey"),
        "job_title", "posting_url", "job_description", day_text("date_posted").alias("date_posted"), "function", "city_name")


@query("feed_fountain", f"""
    SELECT o_orderkey, {SQL_TITLE} AS job_title, 'https://f.example.com/opening/' || o_orderkey || '?brand_id=all' AS posting_url,
           {SQL_TITLE} || ' — ' || CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority ELSE 'District' END
             || '. See full details and apply at https://f.example.com/opening/' || o_orderkey || '?brand_id=all.' AS job_description,
           '2002-01-01' AS date_posted, {sql_pick(['Part-time', 'Temporary', None], 'o_orderkey')} AS job_type,
           CASE o_orderkey % 3 WHEN 0 THEN 'Jenks' ELSE 'Tulsa' END AS city_name,
           o_custkey || ' E 11th St' AS address1, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS site_name,
           {sql_pick(SCHOOL_FUNCTIONS, 'o_orderkey')} AS function
    FROM orders WHERE o_orderstatus <> 'P'
""")
def feed_fountain(t: Tables) -> DataFrame:
    town = F.element_at(F.array(F.lit("Jenks"), F.lit("Dallas"), F.lit("Tulsa")), (order_key() % 3 + 1).cast("int"))
    opening = F.struct(
        ident().alias("id"), title().alias("title"), F.when(F.col("o_orderstatus") != "P", ident()).otherwise("").alias("to_param"),
        F.when(order_key() % 2 == 0, F.col("o_orderpriority")).otherwise("").alias("location_name"),
        F.concat(F.col("o_custkey").cast("string"), F.lit(" E 11th St, "), town, F.lit(", OK 74104, USA")).alias("location_address"),
        F.lit("ok").alias("location_state_code"), pick(["part-time", "Temp", None], order_key()).alias("job_type"))
    # a hundred pages per board, and all of them are read
    rows = t("orders").withColumn("board", F.floor(F.col("o_orderkey") / (PAGE * 100)).cast("int"))
    number = (F.floor(F.col("o_orderkey") / PAGE) % 100).cast("int")
    docs = rows.select("board", number.alias("page"), opening.alias("p")).groupBy("board", "page").agg(F.collect_list("p").alias("openings"))
    texts = docs.select("board", F.to_json(F.struct("page", "openings")).alias("doc"))
    openings = feeds.read_fountain(feeds.parse_documents(texts, "doc", S.FEED_FOUNTAIN))
    out = A.fountain(openings, "https://f.example.com/opening", "District", AS_OF)
    return out.select(
        F.col("posting_id").cast("bigint").alias("o_orderkey"), "job_title", "posting_url", "job_description",
        day_text("date_posted").alias("date_posted"), "job_type", "city_name", "address1", "site_name", "function")


@query("feed_icims", f"""
    SELECT o_orderkey, {SQL_TITLE} AS job_title, 'https://i.example.com/jobs/' || o_orderkey || '/job?in_iframe=1' AS posting_url,
           {sql_pick(['Tulsa, OK', 'Remote - USA', 'Sand Springs', '4 Locations', 'Enid'], 'o_orderkey')} AS location,
           CASE WHEN o_orderkey % 2 = 0 THEN 'Quality lab' END AS category, {sql_pick(CITIES, 'o_orderkey')} AS city_name,
           CASE WHEN o_orderkey % 2 = 0 THEN 'Quality' ELSE {SQL_FUNCTION} END AS function
    FROM orders WHERE o_orderstatus <> 'P'
""")
def feed_icims(t: Tables) -> DataFrame:
    anchor = F.when(F.col("o_orderstatus") != "P", F.concat(
        F.lit('<a class="iCIMS_Anchor" href="https://i.example.com/jobs/'), ident(), F.lit('/job"><h3>'), title(), F.lit("</h3></a>"))).otherwise("")
    html = F.concat(
        F.lit("<li><span>Position Posting Title</span>"), anchor, F.lit("<span>Job Locations</span><span> "),
        pick(["Tulsa, OK", "Remote - USA", "Sand Springs", "4 Locations", "Enid"], order_key()), F.lit(" </span>"),
        F.when(order_key() % 2 == 0, "<dl><dt>Category</dt><dd>Quality lab</dd><dt>category</dt><dd>Legal</dd></dl>").otherwise(""), F.lit("</li>"))
    return A.icims(t("orders").select("o_orderkey", html.alias("html")), carry=["o_orderkey"])


@query("feed_ultipro", f"""
    SELECT o_orderkey, {SQL_TITLE} AS job_title, 'https://u.example.com/opp/' || o_orderkey AS posting_url,
           'REQ' || o_orderkey AS posting_id, {SQL_DAY} AS date_posted, {sql_pick(['Full-time', None], 'o_orderkey')} AS job_type,
           {sql_pick(['On-site', 'Remote', 'On-site'], 'o_orderkey')} AS office_location, {SQL_FUNCTION} AS function,
           {sql_pick(CITIES, 'o_orderkey')} AS city_name
    FROM orders
""")
def feed_ultipro(t: Tables) -> DataFrame:
    cards = t("orders").select(
        "o_orderkey", F.concat(F.lit(" "), title(), F.lit("\n")).alias("job_title"),
        F.concat(pick(["/opp/", "opp/", "https://u.example.com/opp/"], order_key()), ident()).alias("posting_url"),
        F.date_format("o_orderdate", "MMM d, yyyy").alias("posted_date_raw"), F.concat(F.lit("REQ"), ident()).alias("requisition_number"),
        pick(["Full Time", "Varies"], order_key()).alias("schedule"), F.lit(None).cast("string").alias("job_category"),
        pick(["Onsite", "Remote", None], order_key()).alias("location_type"), pick(PLACES, order_key()).alias("physical_location"))
    out = A.ultipro(cards, AS_OF, "https://u.example.com", carry=["o_orderkey"])
    return out.withColumn("date_posted", day_text("date_posted"))


@query("feed_assa", f"""
    SELECT o_orderkey, {SQL_TITLE} AS job_title, 'https://s.example.com/job.' || o_orderkey AS posting_url, 'Tulsa' AS city_name
    FROM orders WHERE o_orderkey % 5 IN (0, 2)
""")
def feed_assa(t: Tables) -> DataFrame:
    spots = pick(["Tulsa", None, "West Tulsa", "TULSA", "Oslo"], order_key())
    item = F.struct(ident().alias("id"), title().alias("title"), F.array(
        F.struct(F.lit(None).cast("string").alias("city")), F.struct(spots.alias("city"))).alias("locations"))
    docs = feeds.parse_documents(_pages(t("orders"), item, "items").select("doc"), "doc", S.FEED_ASSA)
    out = A.assa(feeds.read_assa(docs), "https://s.example.com/job.", carry=["id"])
    return out.withColumn("o_orderkey", F.col("id").cast("bigint")).drop("id")


@query("feed_applitrack", f"""
    SELECT o_orderkey, {SQL_TITLE} AS job_title, CAST(o_orderkey AS VARCHAR) AS posting_id,
           'https://t.example.com/?all=1&AppliTrackJobId=' || o_orderkey || '&AppliTrackLayoutMode=detail&AppliTrackViewPosting=1' AS posting_url,
           {SQL_DAY} AS date_posted, 'Part-time' AS job_type
    FROM orders
""")
def feed_applitrack(t: Tables) -> DataFrame:
    entry = lambda label, value: F.concat(F.lit(f'<li><span class="label">{label}:</span> <span class="normal"> '), value, F.lit(" </span></li>"))
    html = F.concat(
        F.lit('<table><tr><td id="wrapword"> '), title(), F.lit('</td></tr></table><span class="title2">JobID: '), ident(), F.lit("</span><ul>"),
        entry("Position Type", F.lit("Teacher/Part Time")), entry("Date Posted", F.date_format("o_orderdate", "M/d/yyyy")),
        entry("Date Posted", F.lit("1/1/1990")), F.lit("</ul>"))
    out = A.applitrack(t("orders").select("o_orderkey", html.alias("html")), "https://t.example.com/?all=1", AS_OF, carry=["o_orderkey"])
    return out.withColumn("date_posted", day_text("date_posted"))


@query("feed_taleo", f"""
    SELECT CAST(floor(o_orderkey / 20) AS BIGINT) AS page, {SQL_TITLE} AS job_title, 'https://q.example.com/job/' || o_orderkey AS posting_url,
           {SQL_DAY} AS date_posted, upper('Sand Springs') || ', OK, US' AS location, 'Sand Springs' AS city_name,
           CASE WHEN o_orderkey % 2 = 0 THEN {SQL_DAY} END AS date_closed
    FROM orders
""")
def feed_taleo(t: Tables) -> DataFrame:
    row = F.concat(
        F.lit('<tr class="data-row"><td class="colTitle"><span><a class="jobTitle-link" href="/job/'), ident(), F.lit('">'), title(),
        F.lit('</a></span></td><td class="colDate"><span class="jobDate"> '), F.date_format("o_orderdate", "MMM d, yyyy"),
        F.lit('\n</span></td><td><span class="jobLocation">SAND SPRINGS, OK, US</span></td><td>'),
        F.when(order_key() % 2 == 0, F.concat(F.lit("Application Deadline: "), F.date_format("o_orderdate", "MM/dd/yyyy"))).otherwise("open"),
        F.lit("</td></tr>\n"))
    pages = t("orders").select(F.floor(order_key() / PAGE).alias("page"), row.alias("r")).groupBy("page").agg(
        F.concat(F.lit("<table>"), F.array_join(F.collect_list("r"), ""), F.lit("</table>")).alias("html"))
    out = A.taleo_rows(pages, "https://q.example.com", AS_OF, carry=["page"]).drop("pos")
    return out.withColumn("date_posted", day_text("date_posted")).withColumn("date_closed", day_text("date_closed"))


@query("feed_paycom", f"""
    SELECT {SQL_TITLE} AS job_title, 'https://p.example.com/job?id=' || o_orderkey AS posting_url, 'Tulsa, OK' AS site_name,
           'part_time' AS position_type, CASE WHEN o_orderpriority = '1-URGENT' THEN 'Accounting' ELSE 'Other' END AS function
    FROM orders WHERE o_orderkey % 5 = 0
""")
def feed_paycom(t: Tables) -> DataFrame:
    doc = F.to_json(F.struct(
        ident().alias("id"), title().alias("title"), F.when(F.col("o_orderpriority") == "1-URGENT", "Finance").otherwise("Kitchen").alias("department"),
        F.lit("Part Time").alias("position"), F.struct(pick(PLACES, order_key()).alias("description")).alias("location")))
    docs = feeds.parse_documents(t("orders").select(doc.alias("doc")), "doc", S.FEED_PAYCOM)
    return A.paycom(docs, "https://p.example.com/job?id=")


@query("feed_paylocity", f"""
    SELECT CASE WHEN o_orderkey % 2 = 0 THEN {SQL_TITLE} ELSE 'Unknown Title' END AS job_title, CAST(o_orderkey AS VARCHAR) AS posting_id,
           'https://y.example.com/Details/' || o_orderkey AS posting_url, {SQL_DAY} AS date_posted
    FROM orders WHERE o_orderstatus <> 'P'
""")
def feed_paylocity(t: Tables) -> DataFrame:
    link = F.when(F.col("o_orderstatus") != "P", F.concat(F.lit('<i data-x="/Recruiting/Jobs/Details/'), ident(), F.lit('/x"></i>'))).otherwise("")
    html = F.concat(
        F.lit('<div class="job">'), F.when(order_key() % 2 == 0, F.concat(F.lit("<h3>"), title(), F.lit("</h3>"))).otherwise(""), link,
        F.lit("<p>Posted "), F.date_format("o_orderdate", "M/d/yyyy"), F.lit(" until 1/1/1990</p></div>"))
    out = A.paylocity(t("orders").select(html.alias("html")), "https://y.example.com/Details/", AS_OF)
    return out.withColumn("date_posted", day_text("date_posted"))


@query("feed_link_blocks", f"""
    SELECT {SQL_TITLE} AS job_title, 'https://h.example.com/jobs/' || o_orderkey AS posting_url,
           CASE WHEN o_orderkey % 3 > 0 THEN 'J' || o_orderkey END AS posting_id
    FROM orders
""")
def feed_link_blocks(t: Tables) -> DataFrame:
    block = F.concat(
        F.lit('<div><a href="/about">About</a><a rel="x" href="/jobs/'), ident(), F.lit('"><span itemprop="title">'), title(), F.lit("</span></a>"),
        F.when(order_key() % 3 > 0, F.concat(F.lit("<p>Job ID: <span>J"), ident(), F.lit("</span></p>"))).otherwise(""), F.lit("</div>"))
    pages = t("orders").select(F.floor(order_key() / PAGE).alias("page"), block.alias("b")).groupBy("page").agg(
        F.array_join(F.collect_list("b"), "").alias("html"))
    return A.link_blocks(pages, "https://h.example.com").select("job_title", "posting_url", "posting_id")


@query("feed_unknown_container", f"""
    SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 2 THEN 'row ' || o_orderpriority ELSE 'card ' || o_orderpriority END AS block
    FROM orders
""")
def feed_unknown_container(t: Tables) -> DataFrame:
    card = F.concat(F.lit("card "), "o_orderpriority")
    row = F.concat(F.lit("<table><tr><td>row "), "o_orderpriority", F.lit("</td></tr></table>"))
    html = F.element_at(F.array(
        F.concat(F.lit('<div class="JobListing">'), card, F.lit("</div>"), row),
        F.concat(row, F.lit('<li class="job-listing">'), card, F.lit("</li>")), row), (order_key() % 3 + 1).cast("int"))
    shapes = [r'(?is)<div class="JobListing">(.*?)</div>', r'(?is)<li class="job-listing">(.*?)</li>', r"(?is)<td>(.*?)</td>"]
    out = A.container_rows(t("orders").select("o_orderkey", html.alias("html")), shapes, carry=["o_orderkey"])
    return out.select("o_orderkey", "block")


@query("feed_unknown_json", """
    SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS title FROM orders WHERE o_orderkey % 3 < 2
""")
def feed_unknown_json(t: Tables) -> DataFrame:
    doc = F.element_at(F.array(
        F.lit('{"jobs": [{"title": "a"}], "results": [{"title": "b"}]}'), F.lit('{"jobs": [], "results": [{"title": "b"}]}'),
        F.lit('{"jobs": []}')), (order_key() % 3 + 1).cast("int"))
    kind = S.struct("jobs ARRAY<STRUCT<title: STRING>>, results ARRAY<STRUCT<title: STRING>>")
    docs = feeds.parse_documents(t("orders").select("o_orderkey", doc.alias("doc")), "doc", kind)
    found = docs.select("o_orderkey", feeds.first_container("jobs", "results").alias("found"))
    return found.select("o_orderkey", F.explode("found").alias("p")).select("o_orderkey", "p.title")


# Two sources whose documents no schema names: lists at other places, fields by other names.
_FIELDS = {"title": ("title", "positionName", "Job"), "url": ("url", "link")}


@query("feed_unknown_shapes", """
    SELECT o_orderkey, pos, o_orderpriority || pos AS title, CASE WHEN o_orderkey % 3 <> 1 THEN 'u' || pos END AS url
    FROM orders, (SELECT unnest(range(0, 2)) AS pos) WHERE o_orderkey % 4 < 3
""")
def feed_unknown_shapes(t: Tables) -> DataFrame:
    name = F.col("o_orderpriority")
    links = lambda k, quoted: F.when(order_key() % 3 != 1, F.lit(f', "{quoted}": "u{k}"')).otherwise("")
    one = F.concat(F.lit('{"meta": {"tags": [{"id": 1}]}, "data": {"search": {"hits": [{"positionName": "'), name, F.lit('0"'), links(0, "link"), F.lit('}, {"positionName": "'), name, F.lit('1"'), links(1, "link"), F.lit("}]}}}"))
    two = F.concat(F.lit('[{"Job": "'), name, F.lit('0", "more": [{"title": "deeper"}]'), links(0, "url"), F.lit('}, {"Job": "'), name, F.lit('1"'), links(1, "url"), F.lit("}]"))
    three = F.concat(F.lit('{"first": [], "jobs": [{"title": "'), name, F.lit('0"'), links(0, "url"), F.lit('}, {"title": "'), name, F.lit('1"'), links(1, "url"), F.lit('}], "others": [{"title": "x"}]}'))
    doc = F.element_at(F.array(one, two, three, F.lit('{"jobs": [{"title": "cut off')), (order_key() % 4 + 1).cast("int"))
    return feeds.postings_of_any_shape(t("orders").select("o_orderkey", doc.alias("doc")), "doc", ["o_orderkey"], _FIELDS)


@query("feed_quarantine", """
    SELECT o_custkey AS company_id, count(*) FILTER (o_orderkey % 37 <> 0 AND o_orderkey % 41 <> 0 AND o_orderkey % 43 <> 0) AS postings,
           count(*) FILTER (o_orderkey % 37 = 0 OR o_orderkey % 41 = 0 OR o_orderkey % 43 = 0) AS broken_pages,
           count(*) FILTER (o_orderkey % 43 = 0) AS empty_pages,
           CASE WHEN postings > 0 THEN broken_pages = 0 END AS complete
    FROM orders GROUP BY 1
""")
def feed_quarantine(t: Tables) -> DataFrame:
    # some landed pages are cut off, some have a value of another type, some are empty
    page = F.concat(F.lit('{"total": 1, "offset": 0, "jobPostings": [{"title": "'), "o_orderpriority", F.lit('", "externalPath": "/job/'), "o_orderkey", F.lit('"}]}'))
    text = F.when(order_key() % 43 == 0, " ").when(order_key() % 37 == 0, F.substring(page, 1, 40)).when(order_key() % 41 == 0, F.replace(page, F.lit('"total": 1'), F.lit('"total": "many"'))).otherwise(page)
    pages = t("orders").select(F.col("o_custkey").alias("company_id"), text.alias("page"))
    documents, quarantine = feeds.split_documents(pages, "page", S.FEED_WORKDAY)
    landed = feeds.read_workday(documents).select("company_id", F.col("externalPath").alias("posting_url"))
    gate = complete_companies(landed, broken=quarantine)
    bad = quarantine.groupBy("company_id").agg(F.count(F.lit(1)).alias("broken_pages"), F.count_if(F.col("reason") == "empty").alias("empty_pages"))
    good = landed.groupBy("company_id").agg(F.count(F.lit(1)).alias("postings"))
    out = good.join(bad, "company_id", "full").join(gate, "company_id", "left")
    return out.select("company_id", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("postings", "broken_pages", "empty_pages")], "complete")


@query("page_label_values", """
    SELECT o_orderkey, o_orderpriority AS time_type, 'Remote & ' || o_orderstatus AS remote_type, CAST(2 AS BIGINT) AS labels FROM orders
""")
def page_label_values(t: Tables) -> DataFrame:
    html = F.concat(
        F.lit('<dl><dt class="a"> Time  Type</dt> <dd> <b>'), "o_orderpriority", F.lit("</b> </dd><dt>Remote Type&nbsp;</dt><dd>Remote &amp; "),
        "o_orderstatus", F.lit("</dd><dt>time  type</dt><dd>late</dd></dl>"))
    out = t("orders").select("o_orderkey", X.label_values(html).alias("m"))
    return out.select(
        "o_orderkey", F.try_element_at("m", F.lit("time  type")).alias("time_type"),
        F.try_element_at("m", F.lit("remote type")).alias("remote_type"), F.size("m").cast("bigint").alias("labels"))


@query("page_nested_labels", """
    SELECT o_orderkey, o_orderpriority AS time_type, 'from ' || o_orderkey AS pay_range, o_orderstatus AS remote_type, 'low ' || o_orderkey || ' high' AS bounds, CAST(6 AS BIGINT) AS labels FROM orders
""")
def page_nested_labels(t: Tables) -> DataFrame:
    # values without end tags, a list inside a value, two labels of one value, a label of none, a list in a comment
    html = F.concat(
        F.lit("<dl><dt>Time Type<dd>"), "o_orderpriority", F.lit("<dt>Bounds</dt><dd>low <dl><dt>Pay Range<dd>from "), "o_orderkey",
        F.lit("<dt>none</dl> high</dd><!-- <dt>Hidden</dt><dd>x</dd> --><dt>Remote Type</dt><dt>Also</dt><dd>"), "o_orderstatus",
        F.lit("</dd><dd>ignored</dd></dl><dt>Loose<dd>end"))
    html = F.replace(html, F.lit("low <dl><dt>Pay Range<dd>from "), F.lit("low <dl><dt>Pay Range<dd><i>from</i> "))
    out = t("orders").select("o_orderkey", X.label_values(html).alias("m"))
    of = lambda k: F.try_element_at("m", F.lit(k))
    bounds = F.regexp_replace(of("bounds"), r"Pay Rangefrom (\d+)none", "$1")
    return out.select("o_orderkey", of("time type").alias("time_type"), of("pay range").alias("pay_range"), of("remote type").alias("remote_type"), bounds.alias("bounds"), F.size("m").cast("bigint").alias("labels"))


@query("all_feeds", f"""
    SELECT source_job_board, count(*) AS n, count(DISTINCT posting_url) AS urls, count(date_posted) AS dated, count(office_location) AS located
    FROM (SELECT 'workday' AS source_job_board, o_orderkey AS posting_url, 1 AS date_posted, 1 AS office_location FROM orders WHERE o_orderstatus <> 'P'
          UNION ALL SELECT 'lever', o_orderkey, 1, NULL FROM orders WHERE {sql_pick(CITIES, 'o_orderkey')} IS NOT NULL
          UNION ALL SELECT 'paycom', o_orderkey, NULL, NULL FROM orders WHERE o_orderkey % 5 = 0) GROUP BY 1
""")
def all_feeds(t: Tables) -> DataFrame:
    parts = [f(t).withColumn("source_job_board", F.lit(n)) for n, f in (("workday", feed_workday), ("lever", feed_lever), ("paycom", feed_paycom))]
    rows = tables.to_canonical(tables.with_defaults(tables.union_feeds(parts)))
    return rows.groupBy("source_job_board").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("posting_url").alias("urls"),
        F.count("date_posted").alias("dated"), F.count("office_location").alias("located"))


@query("detail_precedence", """
    WITH d AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_partkey AS VARCHAR)) AS rn
               FROM lineitem WHERE l_returnflag = 'R')
    SELECT o_orderkey, coalesce(CAST(l_partkey AS VARCHAR), o_orderpriority) AS posting_id FROM orders
    LEFT JOIN d ON l_orderkey = o_orderkey AND rn = 1
""")
def detail_precedence(t: Tables) -> DataFrame:
    # an order has several details; the first one counts
    detail = t("lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", F.col("l_partkey").cast("string").alias("posting_id"))
    listing = t("orders").select("o_orderkey", F.col("o_orderpriority").alias("posting_id"))
    return A.with_detail(listing, detail, "o_orderkey", ["posting_id"], ["l_linenumber"])


@query("dry_run_rows", f"""
    SELECT {SQL_TITLE} AS job_title, 'https://l.example.com/x/' || o_orderkey AS posting_url, 'board' AS source_job_board FROM orders
    WHERE {sql_pick(CITIES, 'o_orderkey')} IS NOT NULL
""")
def dry_run_rows(t: Tables) -> DataFrame:
    staged = feed_lever(t).withColumn("source_job_board", F.lit("board"))
    return tables.dry_run_rows(staged).select("job_title", "posting_url", "source_job_board")


@query("dry_run_limited", """
    SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 25
""")
def dry_run_limited(t: Tables) -> DataFrame:
    return tables.dry_run_rows(t("orders").select("o_orderkey").orderBy("o_orderkey"), limit=25)


@query("feed_facets", """
    SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS descriptor, CAST(count(c_custkey) AS INTEGER) AS count
    FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2 ORDER BY descriptor
""")
def feed_facets(t: Tables) -> DataFrame:
    counted = t("customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    value = F.struct(F.col("n_nationkey").cast("string").alias("id"), F.col("n_name").alias("descriptor"), F.coalesce("n", F.lit(0)).alias("count"))
    # one document per region, each with the facet asked for and another one
    docs = t("nation").join(counted, "n_nationkey", "left").groupBy("n_regionkey").agg(F.collect_list(value).alias("values"))
    other = F.array(F.struct(F.lit("x").alias("id"), F.lit("Full time").alias("descriptor"), F.lit(1).alias("count")))
    facets = F.array(
        F.struct(F.lit("timeType").alias("facetParameter"), other.alias("facets")),
        F.struct(F.lit("locations").alias("facetParameter"), F.col("values").alias("facets")))
    texts = docs.select(F.to_json(F.struct(facets.alias("facets"))).alias("doc"))
    return feeds.read_facets(feeds.parse_documents(texts, "doc", S.FEED_WORKDAY_FACETS)).orderBy("descriptor")


@query("listing_ids", f"""
    SELECT o_orderkey, {sql_pick([9, 19, None, 14, 8], 'o_orderkey')} AS function_id,
           {sql_pick([1, None], 'o_orderkey')} AS job_type_id, {sql_pick([0, 1, 0], 'o_orderkey')} AS office_location_id,
           {sql_pick([None, None, 3, None, None], 'o_orderkey')} AS city_id
    FROM orders
""")
def listing_ids(t: Tables) -> DataFrame:
    def dimension(names: tuple[str, ...]) -> DataFrame:
        return t.spark.createDataFrame(list(enumerate(names)), "id int, name string")

    # the dimension has no Sales, and of the cities only one
    names = tuple("Retail" if n == "Sales" else n for n in FUNCTION_NAMES)
    trades = tuple("Skilled Trades" if n == "Science" else "Crafts" if n == "Skilled Trades" else n for n in names)
    cities = t.spark.createDataFrame([("Sand Springs", 3)], "city_name string, city_id int")
    out = resolve.listing_ids(
        feed_ultipro(t), dimension(trades), t.spark.createDataFrame([(1, "Full-time")], "id int, name string"),
        dimension(("On-site", "Remote", "Hybrid")), cities)
    return out.select("o_orderkey", "function_id", "job_type_id", "office_location_id", "city_id")
