"""Table-driven cases for the column functions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from vacancia.functions import categories as C, dates as D, money as M, places as P, text as X

AS_OF = "2024-06-15 12:00:00"


def run(spark, values, fn, kind="string"):
    """fn over a column of texts; one result per text, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.select("i", fn(F.col("v")).alias("r")).orderBy("i").select("r").collect()]


def check(spark, cases, fn, kind="string"):
    got = run(spark, [c[0] for c in cases], fn, kind)
    assert list(zip([c[0] for c in cases], got)) == cases


def day(fn):
    return lambda c: F.date_format(fn(c), "yyyy-MM-dd")


def test_relative_dates(spark):
    check(spark, [
        ("Posted 5 days ago", "2024-06-10"), ("Posted 1 day ago", "2024-06-14"), ("7 days ago", "2024-06-08"),
        ("Posted 30+ Days Ago", "2024-05-16"), ("1+ days ago", "2024-06-14"), ("Posted yesterday", "2024-06-14"),
        ("Posted Today", "2024-06-15"), ("Invalid date string", None), ("", None), (None, None), ("12", "2024-06-03"),
        ("  3 days ago  ", "2024-06-12"), (" 4 days ago", "2024-06-11"), ("99999999999 days ago", None),
        ("Posted 01/15/2024", None), ("5 weeks ago", None), ("POSTED 2 DAYS AGO", "2024-06-13"),
    ], day(lambda c: D.parse_relative(c, AS_OF)))


def test_relative_date_keeps_the_clock(spark):
    got = run(spark, ["Posted 5 days ago"], lambda c: D.parse_relative(c, AS_OF))
    assert got == [dt.datetime(2024, 6, 10, 12, 0)]


def test_absolute_dates(spark):
    cases = [(t, "2024-01-15") for t in (
        "2024-01-15", "2024-1-15", "01/15/2024", "1/15/2024", "15/01/2024", "Jan 15, 2024", "january 15, 2024", "15-Jan-2024",
        "15 Jan 2024", "2024/01/15", "01-15-2024", " 2024-01-15 ", "Jan  15,  2024")]
    cases += [("2024-13-45", None), ("01/02/2024", "2024-01-02"), ("13/02/2024", "2024-02-13"), ("02/30/2024", None),
              ("May 5, 2024", "2024-05-05"), ("Foo 15, 2024", None), ("01/15/24", None), ("2024-01-15x", None), (None, None)]
    check(spark, cases, day(D.parse_absolute))


def test_normalised_dates(spark):
    check(spark, [
        (None, None), ("", None), ("   ", None), ("99 days ago", "2024-03-08"), ("Posted 01/15/2024", None),
        ("2024-01-15T14:30:00", "2024-01-15"), ("2024-01-15T14:30:00Z", "2024-01-15"), ("1/15/24", "2024-01-15"),
        ("1/15/75", "1975-01-15"), ("1/15/68", "2068-01-15"), ("1/15/69", "1969-01-15"), ("15.01.2024", "2024-01-15"),
        ("20240115", "2024-01-15"), ("2024115", "2024-11-05"), ("January 15, 2024", "2024-01-15"), ("someday", None),
    ], day(lambda c: D.normalise_date(c, AS_OF)))


def strptime_format(fmt):
    for java, c in (("yyyy", "%Y"), ("yy", "%y"), ("MMMM", "%B"), ("MMM", "%b"), ("MM", "%m"), ("M", "%m"), ("dd", "%d"), ("d", "%d")):
        if "%" + c[1] not in fmt:
            fmt = fmt.replace(java, c, 1)
    return fmt


def test_absolute_dates_against_strptime(spark):
    """Random texts near every format: the same day as the standard library reads, or NULL."""
    import random

    rng = random.Random(11)
    months = ["Jan", "January", "FEB", "march", "Sept", "May", "december", "Foo", "Novem"]

    def text():
        y, m, d = rng.choice(["2024", "1999", "24", "20240"]), str(rng.randint(0, 14)), str(rng.randint(0, 33))
        m, d = (x.zfill(2) if rng.random() < 0.5 else x for x in (m, d))
        sep = rng.choice(["-", "/", ".", " "])
        return rng.choice([
            f"{y}{sep}{m}{sep}{d}", f"{m}{sep}{d}{sep}{y}", f"{d}{sep}{m}{sep}{y}", f"{rng.choice(months)} {d}, {y}",
            f"{rng.choice(months)}  {d},{y}", f"{d}-{rng.choice(months)}-{y}", f"{d} {rng.choice(months)} {y}", f" {y}-{m}-{d} ", f"{y}-{m}-{d}T",
        ])

    texts = [text() for _ in range(1500)]

    def expected(t):
        for fmt in D.ABSOLUTE_FORMATS:
            try:
                return dt.datetime.strptime(t.strip(), strptime_format(fmt))
            except ValueError:
                pass
        return None

    got = run(spark, texts, D.parse_absolute)
    wrong = [(t, g, expected(t)) for t, g in zip(texts, got) if g != expected(t)]
    assert not wrong, wrong[:10]
    assert sum(g is not None for g in got) > 150


def test_source_specific_dates(spark):
    check(spark, [("6/26/2025", "2025-06-26"), ("6-26-2025", "2025-06-26"), ("6-26-25", "2025-06-26"), ("26 Jun 2025", None)],
          day(D.parse_dashed))
    got = run(spark, ["Jun 27, 2025", "Posted Today", "about 3 days ago", "soon"], lambda c: D.parse_card_date(c, AS_OF))
    assert got == [dt.datetime(2025, 6, 27), dt.datetime(2024, 6, 15), dt.datetime(2024, 6, 12, 12), None]


def test_iso_and_epoch(spark):
    got = run(spark, ["2025-07-12T09:33:49Z", "2025-07-12T09:33:49+05:00", "2025-07-12", "x"], D.parse_iso)
    assert got == [dt.datetime(2025, 7, 12, 9, 33, 49)] * 2 + [dt.datetime(2025, 7, 12), None]
    assert run(spark, [1700000000000], D.from_epoch_millis, "bigint") == [dt.datetime(2023, 11, 14, 22, 13, 20)]


def test_recency(spark):
    moments = [dt.datetime(2024, 6, 15, 11), dt.datetime(2024, 6, 15, 13), dt.datetime(2024, 5, 16, 12), dt.datetime(2024, 5, 15, 12), None]
    # python: (now - d).days rounds down
    assert run(spark, moments, lambda c: D.whole_days(AS_OF, c), "timestamp_ntz") == [0, -1, 30, 31, None]
    assert run(spark, moments, lambda c: D.is_recent(c, AS_OF), "timestamp_ntz") == [True, True, True, False, False]
    assert run(spark, moments, lambda c: D.days_ago(c, AS_OF), "timestamp_ntz") == [0, 0, 30, 31, None]
    assert run(spark, ["x"], lambda c: D.cutoff(AS_OF, 7)) == [dt.datetime(2024, 6, 8, 12)]


def test_date_formats(spark):
    moment = [dt.datetime(2024, 1, 15, 14, 30)]
    for kind, want in (("date", "2024-01-15"), ("datetime", "2024-01-15 14:30:00"), ("display", "01/15/2024"), ("odd", "2024-01-15")):
        assert run(spark, moment, lambda c, k=kind: D.format_date(c, k), "timestamp_ntz") == [want]


def test_dates_inside_texts(spark):
    check(spark, [
        ("Last Revised Date: June 18, 2025", "2025-06-18"), ("last revised date June 2025.", "2025-06-01"),
        ("Last Revised Date: June 18 2025", "2025-06-18"), ("Last Revised Date: Junk 2025", None), ("no", None),
    ], day(D.last_revised))
    check(spark, [("Application Deadline: 01/15/2024 x", "01/15/2024"), ("APPLICATION DEADLINE January 15, 2024", "January 15, 2024"), ("none", None)],
          D.deadline_text)
    check(spark, [("<div class='a'>Posted 3 days ago</div>", "Posted 3 days ago"), ("<p>Posted</p>", None)], D.posted_text)
    check(spark, [("2024-01-15", True), ("2024-02-30", False), ("24-01-15", False), (None, False)], D.is_iso_date_argument)


def pay(spark, values, fn, third="frequency"):
    def number(x):
        return None if x is None else float(x)

    return [None if r is None else (number(r["minimum"]), number(r["maximum"]), r[third]) for r in run(spark, values, fn)]


def test_pay_text(spark):
    assert pay(spark, ["$15.00 Hourly", "$50,000 - $70,000 Annually", "Bi-Weekly", "", None, "$, then $7 yearly and monthly"], M.parse_pay) == [
        (15.0, None, "hourly"), (50000.0, 70000.0, "annually"), (None, None, "biweekly"), (None, None, None), (None, None, None),
        (7.0, None, "annually")]


def test_annual_range(spark):
    def fn(c):
        r = M.annual_range(c)
        return F.when(r.isNotNull(), F.concat_ws("|", r["minimum"].cast("string"), r["maximum"].cast("string")))

    check(spark, [
        ("$20.00 - $25.00 per hour", "41600.00|52000.00"), ("40,000-60,000 USD", "40000.00|60000.00"),
        ("SALARY RANGE: 40,000 - 50,000.", "40000.00|50000.00"), (", - , USD; salary range 1 - 2", "1.00|2.00"), ("$9 to $10", None), (None, None),
    ], fn)


def test_other_pay(spark):
    def two(c):
        r = M.to_range(c)
        return F.concat_ws("|", r["minimum"].cast("string"), r["maximum"].cast("string"))

    check(spark, [("$100130 to $129580", "100130.00|129580.00"), ("1,000 TO 2,000", "1000.00|2000.00"), (", to 5", ""), ("none", "")], two)
    assert pay(spark, ["Grade: H-5 ($12.37 - $15.69)", "Grade H5 ($10)", "Grade H5 (10)", "x"], M.grade_pay) == [
        (12.37, 15.69, "hourly"), (10.0, None, "hourly"), None, None]
    assert pay(spark, ["50000 - 60000 per year", "$15/hour", "call", None], M.loose_pay) == [
        (50000.0, 60000.0, "Annually"), (15.0, 15.0, "Hourly"), (None, None, None), (None, None, None)]
    assert pay(spark, ["$17.00 - $18.00 Hourly", "$52,000.75 Annual", "$17 a shift"], M.trailing_pay) == [
        (17.0, 18.0, "Hourly"), (52000.0, 52000.0, "Annual"), (None, None, None)]


def test_typed_pay(spark):
    got = pay(spark, ["$50,000 - $75,000 per year", "$25-$35 per hour", "$65,000 /year", "$25/hour", "$250/hour", "Competitive",
                      "DOE $1 - $2", "salary of\n$5 to $6", "none"], M.typed_pay, "type")
    # the bare range comes before the hourly range, as the order of the shapes says
    assert got == [(50000, 75000, "annual"), (25, 35, "annual"), (65000, 65000, "annual"), (52000, 52000, "hourly"), (250, 250, "hourly"),
                   (None, None, "competitive"), (1, 2, "doe"), (5, 6, "annual"), (None, None, None)]


def test_single_amount(spark):
    df = spark.createDataFrame([(None, 15.92, "Hourly"), (0.0, 15.92, None), (20.0, 15.92, "DAILY")], "m double, a double, f string")
    r = df.select(M.single_amount_pay(F.lit(1), "m", "a", "f").alias("p")).select("p.maximum", "p.frequency").collect()
    assert [tuple(x) for x in r] == [(Decimal("15.92"), "hourly"), (Decimal("15.92"), None), (Decimal("20.00"), "daily")]


def test_categories(spark):
    check(spark, [("Contract to hire", "Contract"), ("PRN", "As Needed"), ("Internal", "Internship"), ("Full_Time", "Full-time"),
                  ("c2h", "Contract-to-hire"), ("", None), (None, None)], C.job_type)
    check(spark, [("Remote - home office", "On-site"), ("WFH", "Remote"), ("Hybrid", "Hybrid"), ("field", None)], C.work_location)
    check(spark, [("Part time contract", "part_time"), ("temporary full-time", "contract"), ("x", "full_time")], C.position_type)
    check(spark, [("Senior", 5), ("", 7), ("Other", 7), (None, 7)], C.experience_id)
    check(spark, [("Web developer", "Information Technology"), ("Brand lead", "Other"), ("Guard", "Security"), (None, "Other")], C.function_name)
    check(spark, [("Brand lead", None), ("Guard", "Security")], lambda c: C.function_name(c, names=["Security"]))
    check(spark, [("Sales", "Sales"), ("Field sales", "Sales"), ("HVAC", None), ("", None), ("hvac Manufacturing", "Manufacturing")], C.category_function)


def test_first_existing_category_wins(spark):
    # "security" is an IT keyword first; without IT in the dimension the next category takes it
    check(spark, [("security lead", "Information Technology")], C.function_name)
    check(spark, [("security lead", "Security")], lambda c: C.function_name(c, names=["Security", "Other"]))


def test_dimension_names(spark):
    rooms = [(1, "In Office"), (2, "Remote"), (3, "Hybrid"), (4, "On-site")]
    check(spark, [("remote", 2), ("work from home", 2), ("on-site", 4), ("office", 1), ("flexible hours", 3), ("", 1), (None, 1)],
          lambda c: C.by_dimension_name(c, C.LOCATION_NAMES, rooms, 1, fold=True))


def test_shifts(spark):
    names = ("first_shift", "second_shift", "third_shift")

    def which(fn):
        return lambda c: F.concat_ws(",", *[F.when(fn(c)[n], n) for n in names])

    check(spark, [("2nd shift and night shift", "second_shift"), ("Graveyard Shift", "third_shift"), ("x", "first_shift"), (None, "first_shift")],
          which(C.shifts_from_text))
    check(spark, [("Nights (11p-7a)", "third_shift"), ("3p-11", "second_shift"), ("Day", "first_shift"), (None, "first_shift")],
          which(C.shifts_from_label))


def test_work_location_precedence(spark):
    df = spark.createDataFrame([("Remote - USA", "Onsite"), ("Tulsa", "wfh"), (None, None)], "l string, p string")
    assert [r[0] for r in df.select(C.chosen_work_location("l", "p")).collect()] == ["Remote", "Remote", "On-site"]


def test_places(spark):
    check(spark, [("SAND SPRINGS, OK", "Sand Springs"), ("Dallas", None), ("Tulsa / Broken Arrow", "Broken Arrow"), ("", None), (None, None)], P.served_city)
    check(spark, [("2710 E 11th St, Tulsa, OK 74104, USA", "Tulsa"), ("Tulsa, OK, US", "Tulsa"), ("OK, x", None), ("a, b", None), ("", None)],
          lambda c: P.address_city(c, F.lit("ok")))
    check(spark, [("2710 E 11th St, Tulsa", "2710 E 11th St"), (", x", None), (None, None)], P.street)
    check(spark, [("USA - Oklahoma - Tulsa", "Tulsa"), ("Tulsa", "Tulsa"), (" - ", " - "), ("", ""), (None, None)], P.last_segment)
    check(spark, [("Location : Main St\nx", "Main St"), ("Location: A<br>", "A"), ("x", None)], P.location_line)
    check(spark, [(" R12345 ", "R12345"), ("R123", None), ("xR12345", None)], P.requisition_id)
    check(spark, [("JobID: 77", "77"), ("jobid 8", "8"), ("id 8", None)], P.listing_id)
    check(spark, [("x Position Type: Full Time Department: A", "Full Time"), ("position type - A\nSalary", "- A")], P.position_line)
    check(spark, [("Tulsa HQ", "served"), ("Remote", "remote"), ("3 Locations", "multi"), ("Enid", "rejected"), (None, "rejected")], P.acceptance)


def test_tie_of_equal_lengths_keeps_list_order(spark):
    check(spark, [("beta alfa", "alfa"), ("BETA", "beta")], lambda c: P.served_city(c, ["alfa", "beta"]))


def test_urls(spark):
    url = "https://t.wd1.jobs.example.com:8080/en-US/Board?locations=a%20b&locations=c+d&timeType=&x=1&hiringCompany=9#f"
    got = run(spark, [url], P.facets)[0]
    assert got == {"locations": ["a b", "c d"]}
    b = run(spark, [url, "https://t.example.com/", "not a url"], P.board_parts)
    assert (b[0]["origin"], b[0]["tenant"], b[0]["board"]) == ("https://t.wd1.jobs.example.com:8080", "t", "Board")
    assert b[0]["endpoint"] == "https://t.wd1.jobs.example.com:8080/wday/cxs/t/Board/jobs"
    assert b[1]["board"] == "External" and b[2]["origin"] is None
    s = run(spark, [url, "https://e.com/?q=nurse", "https://e.com/"], P.source_scope)
    assert [tuple(x) for x in s] == [("facet", "9"), ("search", "nurse"), ("error", None)]
    check(spark, [("http://a/b", "http://a/b"), ("/b", "https://o/b"), ("b", "https://o/b")], lambda c: P.absolute_url(c, "https://o"))
    check(spark, [("u", "u?in=1"), ("u?a", "u?a&in=1"), ("u?in=1", "u?in=1")], lambda c: P.with_query_flag(c, "in=1"))


def test_identity(spark):
    import hashlib

    check(spark, [("AAON, Inc.", "aaon-inc"), ("--", ""), ("Été 9", "t-9")], X.slug)
    want = hashlib.md5("Tu".encode()).hexdigest()
    assert run(spark, ["T"], lambda c: X.content_hash(c, F.lit("u"), F.lit(None).cast("string"))) == [want]


def test_titles(spark):
    check(spark, [("Welder - Sand Springs", "Welder"), ("Clerk, Tulsa", "Clerk"), ("Cook (Remote) ", "Cook"), ("Tulsa Lead", "Tulsa Lead"),
                  ("A - Oklahoma - Tulsa", "A"), ("A - Tulsa - OK", "A - Tulsa"), ("", ""), (None, None)], X.strip_title_places)
    got = run(spark, ["Entry Level Position Packer NIGHTS", "Operator - OK - DAYS", "Holidays lead"], X.title_with_flags)
    assert [tuple(g) for g in got] == [("Packer", 1, False, True), ("OperatorDAYS", None, True, False), ("Holidays lead", None, True, False)]


def test_texts(spark):
    check(spark, [(" a \n\t b ", "a b"), (" x y", "x y"), ("", "")], X.collapse)
    assert run(spark, ["x  " * 60000], lambda c: F.length(X.collapse(c))) == [119_999]
    check(spark, [(" " * 200, False), ("x" * 100, True), (None, False)], lambda c: X.is_long_enough(c, 100))


HTML = (
    "<!DOCTYPE html><body><script>if (a < b) { x('<p>no</p>') }</script><header>top</header><!-- note -->"
    '<div id="d"><p class="c">One <span style="x">two</span><br/>three</p>\n\n\n\n<UL id=1><li>a &amp; b</li></UL>\t\t<a href="/x">go</a></div>'
    "<footer>end</footer></body>"
)


def test_page_clean(spark):
    bare = run(spark, [HTML], X.without_elements)[0]
    assert ">no<" not in bare and "top" not in bare and "end" not in bare and "One" in bare
    got = run(spark, [bare], X.structural_html)[0]
    assert got == "<p>One two<br></br>three</p>\n\n<UL><li>a & b</li></UL> go"


def test_page_content_prefers_first_long_container(spark):
    long = "word " * 40
    pages = [f"<body><main>short</main><article><p>{long}</p></article>tail</body>", f"<body>{long}</body>", long]
    df = spark.createDataFrame(list(enumerate(pages)), "i int, html string")
    out = X.with_page_content(df, "html", "c", ((r"<main\b[^>]*>", "main"), (r"<article\b[^>]*>", "article"))).orderBy("i")
    assert [r["c"] for r in out.collect()] == [f"<p>{long}</p>", long, long]


def test_closed_structure(spark):
    from vacancia.functions.noise import closed_structural_html

    check(spark, [
        ("<article><p><b>a<br><p>c &amp; d</article>e", "<p><b>a<br></br><p>c & d</p></b></p>e"),
        ("</b>x<ul class='q'><li>1<li>2</ul>\n\n\n\ny", "x<ul><li>1<li>2</li></li></ul>\n\ny"), (None, None),
    ], closed_structural_html)
    # on a page whose tags are closed both forms agree
    page = '<div><h2 id="t">T</h2><p class="c">One <span>two</span><br/>x  y</p><ul><li>a</li><li>b</li></ul></div>'
    assert run(spark, [page], closed_structural_html) == run(spark, [page], X.structural_html)


def test_class_noise_takes_nested_content(spark):
    from vacancia.functions.noise import without_classes

    check(spark, [
        ('<body><div class="main-nav"><div>x</div><p>y</div>keep<br><p class="k">z</p></body>', '<body>keep<br><p class="k">z</p></body>'),
        ('a<img class="menu"><ul class="SideBar"><li>1<li>2</ul>&amp;b<!-- c -->', "a&amp;b<!-- c -->"),
        ('<p>one<div class="header">two', "<p>one"), ("plain < text", "plain < text"), (None, None), ("", ""),
    ], without_classes)


def test_nested_elements(spark):
    check(spark, [
        ("<nav>a<nav>b</nav>c</nav>d", "d"), ("x<NAV class=q><div>y</nav>z", "xz"), ("a<header>b", "a"), ("a</nav>b<br>c", "a</nav>b<br>c"),
        ("<script>if (a < b) '</p>'</script>k<style>x</style>", "k"), ("<div><nav>1</div>2", "<div></div>2"), ("", ""), (None, None),
    ], X.without_elements)
    inner = lambda c: X.element_body(c, r'<div\b[^>]*class="main"[^>]*>', "div")
    check(spark, [
        ('<div><div class="main">a<div>b</div>c</div><div>similar</div></div>', "a<div>b</div>c"), ('<div class="main">open', "open"),
        ('<div class="main"></div>x', None), ("<div>none</div>", None), (None, None),
    ], inner)


def test_page_parts(spark):
    html = '<dl><dt>Time Type</dt><dd> Full <b>time</b></dd><dt> time type </dt><dd>late</dd><dt>Pay&nbsp;</dt><dd>a &amp; b</dd></dl>'
    assert run(spark, [html, "x"], X.label_values) == [{"time type": "Full time", "pay": "a & b"}, {}]
    got = run(spark, ['<a class="q" href="/1"> One <b>x</b></a><a name="n">no</a><A HREF="/2">Two</A>'], X.links)[0]
    assert [tuple(g) for g in got] == [(0, "/1", "One x"), (1, "/2", "Two")]
    check(spark, [('<a href="/0">x</a>Full Job Description: <p><a class="k" href="/1">here</a>', "/1"), ("none", None)], lambda c: X.link_after(c, "full job description"))
    check(spark, [("https://d/document/d/A_b-1/edit", "A_b-1"), ("https://d/file/d/F1/view", "F1"), ("https://d/uc?x=1&id=Z9", "Z9"), ("https://d/", None)],
          X.shared_document_id)


def test_file_kind(spark):
    check(spark, [(bytearray(b"%PDF-1.4"), "pdf"), (bytearray(b"PK\x03\x04"), "docx"), (bytearray(b"xPK"), None), (bytearray(b""), None)], X.file_kind, "binary")


@pytest.mark.parametrize("fmt", D.ABSOLUTE_FORMATS + D.EXTRA_FORMATS + D.REVISED_FORMATS + D.CARD_FORMATS + D.DASHED_FORMATS)
def test_every_shape_accepts_its_format(spark, fmt):
    moments = [dt.datetime(2024, m, d, 5, 6, 7) for m in (1, 2, 5, 9, 10, 12) for d in (1, 9, 10, 28)]
    df = spark.createDataFrame([(m,) for m in moments], "t timestamp_ntz")
    got = df.select(F.date_format("t", fmt).alias("s")).select(F.col("s").rlike(D.format_shape(fmt))).collect()
    assert all(r[0] for r in got)
