"""Normalisation of categories, pay, dates and texts over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vacancia.catalog.registry import Tables, as_double, day_text, pick, query, second_text, sql_pick
from vacancia.functions import categories as C, dates as D, money as M, text as X
from vacancia.operators.dedup import hash_groups
from vacancia.operators.resolve import match_rules
from vacancia.sources.tables import names_of, rules_of
from vacancia.sources.adapters import split_thin

AS_OF = "2002-01-01 12:00:00"


def key() -> F.Column:
    return F.col("o_orderkey")


# --- categories -------------------------------------------------------------

JOB_TYPE_TEXTS = ["Contract to hire", "PRN", "Internal", "Full_Time", "PART TIME weekends", "Temp worker", "Seasonal", ""]
JOB_TYPE_EXPECT = ["Contract", "As Needed", "Internship", "Full-time", "Part-time", "Temporary", None, None]


@query("job_type_normalise", f"""
    SELECT o_orderkey, o_orderpriority || ' ' || {sql_pick(JOB_TYPE_TEXTS, 'o_orderkey')} AS raw,
           {sql_pick(JOB_TYPE_EXPECT, 'o_orderkey')} AS job_type
    FROM orders
""")
def job_type_normalise(t: Tables) -> DataFrame:
    raw = F.concat_ws(" ", "o_orderpriority", pick(JOB_TYPE_TEXTS, key()))
    rows = t("orders").select("o_orderkey", raw.alias("raw"))
    return rows.select("o_orderkey", "raw", C.job_type(F.col("raw")).alias("job_type"))


POSITION_TEXTS = ["Contract, full-time", "Part Time", "temporary help", "Full time", "on call", "contractor"]


@query("job_type_variants", f"""
    SELECT o_orderkey,
           {sql_pick(['contract', 'part_time', 'contract', 'full_time', 'full_time', 'contract'], 'o_orderkey')} AS position_type,
           {sql_pick([1, 2, 1, 1, 1, 3], 'o_orderkey')} AS job_type_id
    FROM orders
""")
def job_type_variants(t: Tables) -> DataFrame:
    raw = pick(POSITION_TEXTS, key())
    names = [(1, "Full time"), (2, "Part time"), (3, "Contract")]
    rows = t("orders").select("o_orderkey", raw.alias("raw"))
    return rows.select(
        "o_orderkey", C.position_type(F.col("raw")).alias("position_type"),
        C.by_dimension_name(F.col("raw"), C.POSITION_NAMES, names, default=1).alias("job_type_id"),
    )


WORK_TEXTS = ["Remote - home office", "WFH", "Hybrid", "In Person", "Field", "work-from-home"]


@query("work_location_normalise", f"""
    SELECT o_orderkey,
           {sql_pick(['On-site', 'Remote', 'Hybrid', 'On-site', None, 'Remote'], 'o_orderkey')} AS work_location,
           {sql_pick([2, 2, 3, 1, 1, 2], 'o_orderkey')} AS office_location_id
    FROM orders
""")
def work_location_normalise(t: Tables) -> DataFrame:
    raw = pick(WORK_TEXTS, key())
    names = [(1, "On-site"), (2, "Remote"), (3, "Hybrid")]
    # the dimension has no name with "work from home": the word list finds it
    rows = t("orders").select("o_orderkey", raw.alias("raw"))
    return rows.select(
        "o_orderkey", C.work_location(F.col("raw")).alias("work_location"),
        C.by_dimension_name(F.col("raw"), C.LOCATION_NAMES, names, default=1, fold=True).alias("office_location_id"),
    )


def _case(column: str, rules, default: str) -> str:
    whens = " ".join(
        "WHEN " + " OR ".join(f"contains({column}, '{w}')" for w in words) + f" THEN '{name}'"
        for name, words in rules
    )
    return f"CASE {whens} ELSE {default} END"


# Categories of the rule set that the dimension has: Marketing is not one of them.
_LIVE_RULES = [(n, w) for n, w in C.FUNCTION_KEYWORDS if n != "Marketing"]


@query("keyword_classify", f"""
    SELECT doc_id, {_case('lower(text)', _LIVE_RULES, "'Other'")} AS function FROM documents
""")
def keyword_classify(t: Tables) -> DataFrame:
    return t("documents").select("doc_id", C.function_name("text").alias("function"))


def _known(rules) -> list:
    return [(n, w) for n, w in rules if n in C.FUNCTION_NAMES]


def _classified(t: Tables, rules) -> DataFrame:
    """Documents by a rule set and names that are held as tables."""
    rows = [(i, name, word) for i, (name, words) in enumerate(rules) for word in words]
    table = t.spark.createDataFrame(rows, "priority int, category string, keyword string")
    names = names_of(t.spark.createDataFrame([(n,) for n in C.FUNCTION_NAMES], "name string"))
    return t("documents").select("doc_id", C.function_name("text", rules_of(table), names).alias("function"))


@query("keyword_classify_hospital", f"""
    SELECT doc_id, {_case('lower(text)', _known(C.HOSPITAL_KEYWORDS), "'Other'")} AS function FROM documents
""")
def keyword_classify_hospital(t: Tables) -> DataFrame:
    return _classified(t, C.HOSPITAL_KEYWORDS)


@query("keyword_classify_school", f"""
    SELECT doc_id, {_case('lower(text)', _known(C.SCHOOL_KEYWORDS), "'Other'")} AS function FROM documents
""")
def keyword_classify_school(t: Tables) -> DataFrame:
    return _classified(t, C.SCHOOL_KEYWORDS)


@query("keyword_classify_maker", f"""
    SELECT doc_id, {_case('lower(text)', _known(C.MAKER_KEYWORDS), "'Other'")} AS function FROM documents
""")
def keyword_classify_maker(t: Tables) -> DataFrame:
    return _classified(t, C.MAKER_KEYWORDS)


PART_RULES = [(1, "Sales", "widget"), (2, "Nothing", "red"), (3, "Quality", "gear"), (4, "Legal", "red"), (5, "Security", "bolt")]


@query("keyword_classify_by_join", """
    SELECT p_partkey, CASE WHEN contains(lower(p_name), 'widget') THEN 'Sales'
                           WHEN contains(lower(p_name), 'gear') THEN 'Quality'
                           WHEN contains(lower(p_name), 'red') THEN 'Legal'
                           WHEN contains(lower(p_name), 'bolt') THEN 'Security' END AS function
    FROM part
""")
def keyword_classify_by_join(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame(PART_RULES, "priority int, category string, keyword string")
    names = t.spark.createDataFrame([(n,) for n in C.FUNCTION_NAMES], "name string")
    part = t("part").select("p_partkey", "p_name")
    return match_rules(part, "p_name", rules, names, ["p_partkey"], "function").drop("p_name")


CATEGORY_TEXTS = ["Sales", "HVAC design", "Field Sales team", "Quality lab", "Customer desk", "Kitchen", "Legal and Finance"]
TITLE_TEXTS = ["Welder", "Web developer", "Guard", "Cook", "Audit lead"]


@query("category_function", f"""
    SELECT o_orderkey,
           {sql_pick(['Sales', None, 'Sales', 'Quality', None, None, 'Legal'], 'o_orderkey')} AS by_category,
           coalesce({sql_pick(['Sales', None, 'Sales', 'Quality', None, None, 'Legal'], 'o_orderkey')},
                    {sql_pick(['Skilled Trades', 'Information Technology', 'Security', 'Other', 'Accounting'], 'o_custkey')}) AS function
    FROM orders
""")
def category_function(t: Tables) -> DataFrame:
    category, title = pick(CATEGORY_TEXTS, key()), pick(TITLE_TEXTS, F.col("o_custkey"))
    return t("orders").select(
        "o_orderkey", C.category_function(category).alias("by_category"),
        C.function_with_precedence(category, title).alias("function"),
    )


EXPERIENCE_TEXTS = ["", "Student", "Entry Level", "Associate", "Mid Senior", "Senior", "Director", "Chief", None]


@query("experience_level", f"""
    SELECT o_orderkey, {sql_pick([7, 1, 2, 3, 4, 5, 6, 7, 7], 'o_orderkey')} AS experience_id FROM orders
""")
def experience_level(t: Tables) -> DataFrame:
    return t("orders").select("o_orderkey", C.experience_id(pick(EXPERIENCE_TEXTS, key())).alias("experience_id"))


SHIFT_TEXTS = ["Night Shift and 2nd shift", "graveyard shift", "Days only", "Evening shift", None]
LABEL_TEXTS = ["Nights 11p-7a", "Evening", "Day", "3p start", "7a", "flex"]


@query("shift_flags", f"""
    SELECT o_orderkey, {sql_pick([2, 3, 1, 2, 1], 'o_orderkey')} = 1 AS first_shift,
           {sql_pick([2, 3, 1, 2, 1], 'o_orderkey')} = 2 AS second_shift,
           {sql_pick([2, 3, 1, 2, 1], 'o_orderkey')} = 3 AS third_shift,
           {sql_pick([3, 2, 1, 2, 1, 1], 'o_orderkey')} = 1 AS label_first,
           {sql_pick([3, 2, 1, 2, 1, 1], 'o_orderkey')} = 2 AS label_second,
           {sql_pick([3, 2, 1, 2, 1, 1], 'o_orderkey')} = 3 AS label_third
    FROM orders
""")
def shift_flags(t: Tables) -> DataFrame:
    out = t("orders").select(
        "o_orderkey", C.shifts_from_text(pick(SHIFT_TEXTS, key())).alias("s"),
        C.shifts_from_label(pick(LABEL_TEXTS, key())).alias("l"),
    )
    return out.select(
        "o_orderkey", "s.*", F.col("l.first_shift").alias("label_first"),
        F.col("l.second_shift").alias("label_second"), F.col("l.third_shift").alias("label_third"),
    )


# --- pay --------------------------------------------------------------------

def price() -> F.Column:
    return F.col("p_retailprice").cast("decimal(12,2)")


def plain() -> F.Column:
    return price().cast("string")


def commas(times: int = 10) -> F.Column:
    return F.format_number(price() * times, 2)


SQL_PRICE = "CAST(p_retailprice AS DECIMAL(12,2))"


def _text(*parts) -> F.Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def _choose(index: F.Column, texts) -> F.Column:
    out = F.lit(None).cast("string")
    for i, text in enumerate(texts):
        out = F.when(F.pmod(index, F.lit(len(texts))) == i, text).otherwise(out)
    return out


def _one_of(*texts) -> F.Column:
    return _choose(F.col("p_partkey"), texts)


def _pay_columns(pay: F.Column, last: str = "frequency"):
    return [as_double(pay["minimum"]).alias("minimum"), as_double(pay["maximum"]).alias("maximum"),
            pay[last].alias(last)]


def _sql_case(*values: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE p_partkey % {len(values)} {whens} END"


def _sql_pay(minimum: list[str], maximum: list[str], third: list[str], name: str = "frequency") -> str:
    return f"""
    SELECT p_partkey, CAST({_sql_case(*minimum)} AS DOUBLE) AS minimum,
           CAST({_sql_case(*maximum)} AS DOUBLE) AS maximum, {_sql_case(*third)} AS {name}
    FROM part
    """


P1, P10, P20 = SQL_PRICE, f"{SQL_PRICE} * 10", f"{SQL_PRICE} * 20"


@query("salary_text", _sql_pay(
    [P1, P10, "NULL", "NULL", P10], ["NULL", P20, "NULL", "NULL", P20],
    ["'hourly'", "'annually'", "'biweekly'", "'weekly'", "NULL"]))
def salary_text(t: Tables) -> DataFrame:
    text = _one_of(
        _text("$", plain(), " Hourly"), _text("$", commas(), " - $", commas(20), " Annually"),
        _text("Bi-Weekly, ", plain()), _text(plain(), " weekly"), _text("from $", commas(), " or $, to $", commas(20)),
    )
    rows = t("part").select("p_partkey", text.alias("text"))
    return rows.select("p_partkey", *_pay_columns(M.parse_pay(F.col("text"))))


@query("salary_annualised", f"""
    SELECT p_partkey,
           CAST({_sql_case(f'({P1} + 0.005) * 2080', P10, P10, 'NULL', P10)} AS DOUBLE) AS minimum,
           CAST({_sql_case(f'({P1} * 2 + 0.005) * 2080', P20, P20, 'NULL', P20)} AS DOUBLE) AS maximum
    FROM part
""")
def salary_annualised(t: Tables) -> DataFrame:
    text = _one_of(
        # a rate of three decimals is not rounded before it is multiplied
        _text("$", plain(), "5 - $", (price() * 2).cast("string"), "5 per hour"),
        _text("Pay ", commas(), "-", commas(20), " USD"),
        _text("salary range: $", commas(), " - $", commas(20)),
        _text("negotiable ", plain()),
        # the first shape has no readable amounts, the third one has
        _text(", - , USD. Salary Range $", commas(), " - ", commas(20)),
    )
    pay = M.annual_range("text")
    rows = t("part").select("p_partkey", text.alias("text"))
    return rows.select("p_partkey", as_double(pay["minimum"]).alias("minimum"), as_double(pay["maximum"]).alias("maximum"))


@query("salary_to_range", f"""
    SELECT p_partkey, CAST(p_partkey + 1000 AS DOUBLE) AS minimum, CAST(p_partkey + 2000 AS DOUBLE) AS maximum FROM part
""")
def salary_to_range(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    text = _text("Posted Range: $", F.format_number(k + 1000, 0), " TO $", F.format_number(k + 2000, 0))
    pay = M.to_range(text)
    rows = t("part").select("p_partkey", text.alias("text"))
    return rows.select("p_partkey", as_double(pay["minimum"]).alias("minimum"), as_double(pay["maximum"]).alias("maximum"))


@query("salary_grade", _sql_pay([P1, "NULL", "NULL", P1], [f"{P1} * 2", "NULL", "NULL", "NULL"],
                                ["'hourly'", "NULL", "NULL", "'hourly'"]))
def salary_grade(t: Tables) -> DataFrame:
    text = _one_of(
        _text("Title\nGrade: H-5 ($", plain(), " - $", (price() * 2).cast("string"), ")"),
        _text("Grade H-5 (", plain(), ")"), _text("Pay $", plain()), _text("GRADE S9 (from $", plain(), " up)"),
    )
    rows = t("part").select("p_partkey", text.alias("text"))
    return rows.select("p_partkey", *_pay_columns(M.grade_pay(F.col("text"))))


@query("salary_loose", _sql_pay([P10, P1, P1, "NULL"], [P20, P1, P1, "NULL"],
                                ["'Annually'", "'Hourly'", "NULL", "'Hourly'"]))
def salary_loose(t: Tables) -> DataFrame:
    text = _one_of(
        _text("$", commas(), " - ", commas(20), " per year"), _text(plain(), "/hour"), _text("$", plain()),
        _text("per hour"),
    )
    rows = t("part").select("p_partkey", text.alias("text"))
    return rows.select("p_partkey", *_pay_columns(M.loose_pay(F.col("text"))))


def _floor(sql: str) -> str:
    return f"floor({sql})"


HOURLY_RATE = f"CAST({P1} / 100 AS DECIMAL(12,2))"


@query("salary_typed", _sql_pay(
    [_floor(P10), _floor(P10), _floor(f"{HOURLY_RATE} * 2080"), _floor(P10), "NULL", _floor(P1)],
    [_floor(P20), _floor(P20), _floor(f"{HOURLY_RATE} * 2080"), _floor(P10), "NULL", _floor(P1)],
    ["'annual'", "'competitive'", "'hourly'", "'doe'", "'competitive'", "'hourly'"], "type"))
def salary_typed(t: Tables) -> DataFrame:
    rate = (price() / 100).cast("decimal(12,2)").cast("string")
    text = _one_of(
        _text("$", commas(), " –  $", commas(20), " per year"),
        _text("Competitive: $", commas(), "-$", commas(20)),
        _text("Pay $", rate, "/hour"), _text("$", commas(), " annually, depends on experience"),
        _text("Competitive pay"), _text("$", F.when(price() >= 100, plain()), " hourly"),
    )
    rows = t("part").select("p_partkey", text.alias("text"))
    return rows.select("p_partkey", *_pay_columns(M.typed_pay(F.col("text")), "type"))


@query("salary_trailing", _sql_pay([P1, _floor(P10), "NULL", P1], [f"{P1} * 2", _floor(P10), "NULL", P1],
                                   ["'Hourly'", "'Annual'", "NULL", "'Hourly'"]))
def salary_trailing(t: Tables) -> DataFrame:
    text = _one_of(
        _text("$", plain(), " - $", (price() * 2).cast("string"), " hourly"), _text("$", commas(), " Annual"),
        _text("$", plain(), " per shift"), _text(plain(), " HOURLY"),
    )
    rows = t("part").select("p_partkey", text.alias("text"))
    return rows.select("p_partkey", *_pay_columns(M.trailing_pay(F.col("text"))))


@query("salary_single_amount", """
    SELECT o_orderkey, CAST(CAST(CASE WHEN o_orderstatus = 'O' THEN o_totalprice
                                      WHEN o_orderstatus = 'F' THEN o_custkey
                                      ELSE o_custkey END AS DECIMAL(18,2)) AS DOUBLE) AS maximum,
           lower(o_orderpriority) AS frequency
    FROM orders
""")
def salary_single_amount(t: Tables) -> DataFrame:
    top = F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).when(F.col("o_orderstatus") == "F", 0.0)
    pay = M.single_amount_pay(F.lit(None).cast("double"), top, "o_custkey", "o_orderpriority")
    return t("orders").select("o_orderkey", as_double(pay["maximum"]).alias("maximum"), pay["frequency"].alias("frequency"))


# --- dates ------------------------------------------------------------------

def n_days() -> F.Column:
    return F.pmod(key(), F.lit(90)).cast("string")


def _order_text(*texts) -> F.Column:
    return _choose(key(), texts)


def _sql_order(*values: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE o_orderkey % {len(values)} {whens} END"


SQL_AGO = "(DATE '2002-01-01' - CAST(o_orderkey % 90 AS INTEGER))"


@query("relative_dates", f"""
    SELECT o_orderkey, strftime({_sql_order(SQL_AGO, SQL_AGO, SQL_AGO, "DATE '2002-01-01'", "DATE '2001-12-31'",
                                            SQL_AGO, 'NULL', 'NULL')}, '%Y-%m-%d') AS posted
    FROM orders
""")
def relative_dates(t: Tables) -> DataFrame:
    text = _order_text(
        _text("Posted ", n_days(), " Days Ago"), _text("  ", n_days(), " day ago"), _text("Posted ", n_days(), "+ days ago"),
        F.lit("Posted Today"), F.lit("posted yesterday"), n_days(), F.lit("Invalid date string"), F.lit(""),
    )
    rows = t("orders").select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", day_text(D.parse_relative(F.col("text"), AS_OF)).alias("posted"))


ORDER_DAY = "CAST(o_orderdate AS DATE)"
SWAPPED = f"""CASE WHEN day(o_orderdate) <= 12 THEN make_date(CAST(year(o_orderdate) AS INTEGER), CAST(day(o_orderdate) AS INTEGER), CAST(month(o_orderdate) AS INTEGER)) ELSE {ORDER_DAY} END"""


def _formatted(*formats: str):
    return [F.date_format("o_orderdate", f) for f in formats]


@query("multi_format_dates", f"""
    SELECT o_orderkey, strftime({_sql_order(ORDER_DAY, ORDER_DAY, SWAPPED, ORDER_DAY, ORDER_DAY, ORDER_DAY,
                                            ORDER_DAY, ORDER_DAY, ORDER_DAY, 'NULL')}, '%Y-%m-%d') AS posted
    FROM orders
""")
def multi_format_dates(t: Tables) -> DataFrame:
    text = _order_text(
        *_formatted("yyyy-MM-dd", "MM/dd/yyyy", "d/M/yyyy", "MMM dd, yyyy", "MMMM d, yyyy", "dd-MMM-yyyy",
                    "d MMM yyyy", "yyyy/MM/dd", "MM-dd-yyyy"),
        F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("-13-45")),
    )
    rows = t("orders").select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", day_text(D.parse_absolute(F.col("text"))).alias("posted"))


@query("normalised_dates", f"""
    SELECT o_orderkey, strftime({_sql_order(SQL_AGO, ORDER_DAY, ORDER_DAY, ORDER_DAY, ORDER_DAY, ORDER_DAY,
                                            'NULL', ORDER_DAY, 'NULL')}, '%Y-%m-%d') AS posted
    FROM orders
""")
def normalised_dates(t: Tables) -> DataFrame:
    text = _order_text(
        _text("Posted ", n_days(), " days ago"),
        *_formatted("yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "M/d/yy", "dd.MM.yyyy", "yyyyMMdd"),
        F.concat(F.lit("Posted "), F.date_format("o_orderdate", "MM/dd/yyyy")),
        F.date_format("o_orderdate", " MMM dd, yyyy "), F.lit("   "),
    )
    rows = t("orders").select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", day_text(D.normalise_date(F.col("text"), AS_OF)).alias("posted"))


@query("variant_dates", f"""
    SELECT o_orderkey,
           strftime({_sql_order(ORDER_DAY, ORDER_DAY, ORDER_DAY, ORDER_DAY, 'NULL')}, '%Y-%m-%d') AS dashed,
           strftime({_sql_order(ORDER_DAY, ORDER_DAY, "TIMESTAMP '2002-01-01 00:00:00'",
                                f"CAST({SQL_AGO} AS TIMESTAMP) + INTERVAL 12 HOUR")}, '%Y-%m-%d %H:%M:%S') AS card
    FROM orders
""")
def variant_dates(t: Tables) -> DataFrame:
    dashed = _order_text(*_formatted("M/d/yyyy", "M-d-yyyy", "M/d/yy", "M-d-yy", "d MMM yyyy"))
    card = _order_text(*_formatted("MMM d, yyyy", "d MMM yyyy"), F.lit("Posted Today"), _text("about ", n_days(), " Days ago"))
    return t("orders").select(
        "o_orderkey", day_text(D.parse_dashed(dashed)).alias("dashed"),
        second_text(D.parse_card_date(card, AS_OF)).alias("card"),
    )


@query("iso_and_epoch_dates", """
    SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS iso,
           strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS epoch
    FROM events
""")
def iso_and_epoch_dates(t: Tables) -> DataFrame:
    zone = pick(["Z", "+05:30", "", "-0600"], F.col("event_id"))
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), zone)
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    return t("events").select(
        "event_id", second_text(D.parse_iso(iso)).alias("iso"),
        second_text(D.from_epoch_millis(millis)).alias("epoch"),
    )


@query("recency", """
    SELECT o_orderkey,
           CAST(floor(epoch(TIMESTAMP '2001-06-01 12:00:00' - o_orderdate) / 86400) AS BIGINT) AS whole_days,
           abs(floor(epoch(TIMESTAMP '2001-06-01 12:00:00' - o_orderdate) / 86400)) <= 30 AS recent,
           CAST(greatest(0, floor(epoch(TIMESTAMP '2001-06-01 12:00:00' - o_orderdate) / 86400)) AS BIGINT) AS days_ago,
           o_orderdate < TIMESTAMP '2001-05-25 12:00:00' AS before_cutoff
    FROM orders
""")
def recency(t: Tables) -> DataFrame:
    now = "2001-06-01 12:00:00"
    return t("orders").select(
        "o_orderkey", D.whole_days(now, "o_orderdate").alias("whole_days"),
        D.is_recent("o_orderdate", now).alias("recent"), D.days_ago("o_orderdate", now).alias("days_ago"),
        (F.col("o_orderdate") < D.cutoff(now, 7)).alias("before_cutoff"),
    )


@query("recent_only", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE abs(floor(epoch(TIMESTAMP '2001-06-01 12:00:00' - o_orderdate) / 86400)) <= 30
""")
def recent_only(t: Tables) -> DataFrame:
    return t("orders").where(D.is_recent("o_orderdate", "2001-06-01 12:00:00")).select("o_orderkey", "o_custkey")


@query("date_formats", """
    SELECT event_id, strftime(ts, '%Y-%m-%d') AS as_date, strftime(ts, '%Y-%m-%d %H:%M:%S') AS as_datetime,
           strftime(ts, '%m/%d/%Y') AS as_display, strftime(ts, '%Y-%m-%d') AS as_unknown
    FROM events
""")
def date_formats(t: Tables) -> DataFrame:
    kinds = ("date", "datetime", "display", "unknown")
    return t("events").select("event_id", *[D.format_date("ts", k).alias(f"as_{k}") for k in kinds])


@query("last_revised_dates", f"""
    SELECT o_orderkey, strftime({_sql_order(ORDER_DAY, f"date_trunc('month', {ORDER_DAY})", ORDER_DAY, 'NULL')},
                                '%Y-%m-%d') AS revised
    FROM orders
""")
def last_revised_dates(t: Tables) -> DataFrame:
    text = _order_text(
        _text("Grade 5\nLast Revised Date: ", F.date_format("o_orderdate", "MMMM d, yyyy"), " page 1"),
        _text("last revised date ", F.date_format("o_orderdate", "MMMM yyyy"), ". Next"),
        _text("Last Revised Date:", F.date_format("o_orderdate", "MMMM dd yyyy")), F.lit("Revised often"),
    )
    rows = t("orders").select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", day_text(D.last_revised(F.col("text"))).alias("revised"))


@query("application_deadlines", f"""
    SELECT o_orderkey, strftime({_sql_order(ORDER_DAY, ORDER_DAY, 'NULL')}, '%Y-%m-%d') AS deadline FROM orders
""")
def application_deadlines(t: Tables) -> DataFrame:
    text = _order_text(
        _text("Apply now. Application Deadline: ", F.date_format("o_orderdate", "MM/dd/yyyy"), " 5pm"),
        _text("APPLICATION  DEADLINE ", F.date_format("o_orderdate", "MMMM d, yyyy")), F.lit("Deadline: open"),
    )
    out = D.with_date_in_text(t("orders").select("o_orderkey", text.alias("t")), D.deadline_text("t"), AS_OF, "deadline")
    return out.select("o_orderkey", day_text("deadline").alias("deadline"))


@query("posted_in_page", f"""
    SELECT o_orderkey, strftime({_sql_order(SQL_AGO, "DATE '2002-01-01'", 'NULL', 'NULL')}, '%Y-%m-%d') AS posted FROM orders
""")
def posted_in_page(t: Tables) -> DataFrame:
    html = _order_text(
        _text("<p>Job</p><div class='d'>Posted ", n_days(), " days ago</div><div>Posted Today</div>"),
        F.lit("<div><div>posted today</div></div>"), F.lit("<p>Posted Today</p>"),
        _text("<div>Posted ", F.date_format("o_orderdate", "MM/dd/yyyy"), "</div>"),
    )
    out = D.with_date_in_text(t("orders").select("o_orderkey", html.alias("html")), D.posted_text("html"), AS_OF, "posted")
    return out.select("o_orderkey", day_text("posted").alias("posted"))


@query("date_argument", """
    SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN true ELSE false END AS valid FROM orders
""")
def date_argument(t: Tables) -> DataFrame:
    text = _order_text(
        *_formatted("yyyy-MM-dd", "MM/dd/yyyy"), _text(F.date_format("o_orderdate", "yyyy"), "-02-30"),
        F.lit(None).cast("string"),
    )
    rows = t("orders").select("o_orderkey", text.alias("text"))
    return rows.select("o_orderkey", D.is_iso_date_argument(F.col("text")).alias("valid"))


# --- F.col("text") and identity ------------------------------------------------------

@query("slugs", """
    SELECT c_custkey, trim(regexp_replace(lower('  ' || c_name || ', ' || c_mktsegment || '. Inc.'), '[^a-z0-9]+', '-', 'g'), '-') AS slug
    FROM customer
""")
def slugs(t: Tables) -> DataFrame:
    name = F.concat(F.lit("  "), "c_name", F.lit(", "), "c_mktsegment", F.lit(". Inc."))
    return t("customer").select("c_custkey", X.slug(name).alias("slug"))


@query("content_hash", """
    SELECT doc_id, md5(source || text || coalesce(CASE WHEN lang = 'en' THEN lang END, '')) AS scraping_hash FROM documents
""")
def content_hash(t: Tables) -> DataFrame:
    part = F.when(F.col("lang") == "en", F.col("lang"))
    return t("documents").select("doc_id", X.content_hash("source", "text", part).alias("scraping_hash"))


@query("content_hash_dups", """
    SELECT md5(text) AS scraping_hash, min(doc_id) AS first_id, count(*) AS copies FROM documents GROUP BY 1
""")
def content_hash_dups(t: Tables) -> DataFrame:
    docs = t("documents").select("doc_id", F.md5("text").alias("scraping_hash"))
    return hash_groups(docs, "scraping_hash", "doc_id")


TITLE_TAILS = [" - Tulsa", ", Broken Arrow", " (Remote)", " - OK", " - Oklahoma - Tulsa", ", tulsa, OK", ""]


@query("title_clean", f"""
    SELECT p_partkey, p_name || CASE p_partkey % 7 WHEN 4 THEN '' WHEN 5 THEN ', tulsa' ELSE '' END AS title FROM part
""")
def title_clean(t: Tables) -> DataFrame:
    # places are cut in list order: "tulsa" is over when "ok" is cut, so ", tulsa" stays
    raw = F.concat(F.lit(" "), "p_name", pick(TITLE_TAILS, F.col("p_partkey")))
    rows = t("part").select("p_partkey", raw.alias("raw"))
    return rows.select("p_partkey", X.strip_title_places(F.col("raw")).alias("title"))


@query("title_flags", """
    SELECT p_partkey,
           CASE p_partkey % 4 WHEN 0 THEN p_name || ' Lead' WHEN 1 THEN 'Operator' || p_name
                              WHEN 2 THEN 'Packer ' || p_name ELSE 'HOLIDAYS ' || p_name END AS title,
           CASE WHEN p_partkey % 4 = 0 THEN 1 END AS experience_id,
           p_partkey % 4 IN (1, 3) AS first_shift, p_partkey % 4 = 2 AS third_shift
    FROM part
""")
def title_flags(t: Tables) -> DataFrame:
    raw = _one_of(
        _text("Entry Level Position  ", F.col("p_name"), "  Lead"), _text("Operator  - OK - ", F.col("p_name"), " Days"),
        _text("Packer NIGHTS ", F.col("p_name")), _text("HOLIDAYS ", F.col("p_name")),
    )
    rows = t("part").select("p_partkey", raw.alias("raw"))
    out = rows.select("p_partkey", X.title_with_flags(F.col("raw")).alias("c"))
    return out.select("p_partkey", "c.*")


@query("text_collapse", r"""
    SELECT doc_id, md5(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS digest,
           CAST(length(trim(regexp_replace(text, '\s+', ' ', 'g'))) AS BIGINT) AS n
    FROM documents
""")
def text_collapse(t: Tables) -> DataFrame:
    kept = X.collapse("text")
    return t("documents").select("doc_id", F.md5(kept).alias("digest"), F.length(kept).cast("bigint").alias("n"))


@query("content_length", """
    SELECT doc_id, length(trim(text)) >= 50 AS long_50, length(trim(text)) >= 100 AS long_100,
           length(trim(text)) >= 200 AS long_200
    FROM documents
""")
def content_length(t: Tables) -> DataFrame:
    return t("documents").select(
        "doc_id", *[X.is_long_enough("text", n).alias(f"long_{n}") for n in (50, 100, 200)])


@query("thin_content", """
    SELECT source, count(*) FILTER (WHERE length(trim(text)) < 200) AS thin, count(*) FILTER (WHERE length(trim(text)) >= 200) AS kept
    FROM documents GROUP BY 1
""")
def thin_content(t: Tables) -> DataFrame:
    kept, thin = split_thin(t("documents").select("source", "text"), "icims", "text")
    marked = kept.select("source", F.lit(True).alias("ok")).unionByName(thin.select("source", F.lit(False).alias("ok")))
    return marked.groupBy("source").agg(F.count_if(~F.col("ok")).alias("thin"), F.count_if("ok").alias("kept"))
