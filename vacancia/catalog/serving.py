"""Views, queues, run log, audits and quality over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vacancia.catalog.registry import (
    SQL_LISTINGS, Tables, pick, query, second_text, sql_pick,
)
from vacancia.operators import quality as Q
from vacancia.operators.deletes import site_action, site_review
from vacancia.plans import audit as A, views as V
from vacancia.sources import feeds


def company_frames(t: Tables) -> dict[str, DataFrame]:
    company = t.companies().drop("last_full_scrape_completed")
    types = t("customer").select(F.col("c_mktsegment").alias("id")).distinct().withColumn("name", F.lower("id"))
    pairs = t("orders").select(F.col("o_custkey").alias("company_id"), F.col("o_orderpriority").alias("industry_id")).distinct()
    industries = t("orders").select(F.col("o_orderpriority").alias("id")).distinct().withColumn("name", F.concat(F.lit("Industry "), "id"))
    functions = t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    worked = t("customer").where(F.col("c_acctbal") > 2000).select(
        F.col("c_custkey").alias("company_id"), (F.col("c_nationkey") % 7).alias("function_id"))
    sites = t("customer").select(
        F.col("c_custkey").alias("company_id"), F.col("c_nationkey").alias("city_id"),
        (F.col("c_nationkey") % 5).alias("state_id"), (F.col("c_nationkey") % 4).alias("country_id"),
        (F.col("c_mktsegment") != "BUILDING").alias("is_headquarters"))
    cities = t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("city_name"))
    countries = t("region").where(F.col("r_regionkey") < 3).select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    return dict(
        company=company, listings=t.listings(), company_type=types, company_industries=pairs, industries=industries,
        company_functions=worked, functions=functions, sites=sites, cities=cities, states=functions, countries=countries)


@query("company_profile", f"""
    WITH {SQL_LISTINGS}
    SELECT c_custkey AS id, c_name AS company_name, lower(c_mktsegment) AS company_type,
           'Industry ' || o_orderpriority AS primary_industry, f.r_name AS primary_function,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN n_name END AS hq_city,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN st.r_name END AS hq_state,
           CASE WHEN c_mktsegment <> 'BUILDING' THEN co.r_name END AS hq_country,
           (SELECT count(*) FROM listings l WHERE l.company_id = c_custkey AND l.approved AND l.job_status = 'active') AS active_jobs,
           (SELECT count(*) FROM listings l WHERE l.company_id = c_custkey) AS total_jobs
    FROM customer
    LEFT JOIN (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) ON o_custkey = c_custkey
    LEFT JOIN region f ON c_acctbal > 2000 AND f.r_regionkey = c_nationkey % 7
    LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region st ON st.r_regionkey = c_nationkey % 5
    LEFT JOIN region co ON co.r_regionkey = c_nationkey % 4 AND co.r_regionkey < 3
    WHERE c_acctbal > 0
""")
def company_profile(t: Tables) -> DataFrame:
    return V.company_profile(**company_frames(t))


def _skills(t: Tables):
    skills = t("part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_type").alias("skill_category_id"))
    categories = t("part").where(F.col("p_type") != "PROMO").select(F.col("p_type").alias("id")).distinct().withColumn("name", F.lower("id"))
    links = t("lineitem").select(
        F.col("l_orderkey").alias("job_listing_id"), F.col("l_partkey").alias("skill_id"),
        (F.col("l_returnflag") == "A").alias("required_skill"), (F.col("l_returnflag") == "R").alias("preferred_skill"))
    return skills, categories, links


_SKILL_SQL = """
    SELECT p_partkey AS skill_id, p_name AS skill_name, CASE WHEN p_type <> 'PROMO' THEN lower(p_type) END AS category,
           count(l_orderkey) AS listing_count,
           count(l_orderkey) FILTER (WHERE l_returnflag = 'A') AS required_count,
           count(l_orderkey) FILTER (WHERE l_returnflag = 'R') AS preferred_count
    FROM part LEFT JOIN LINKS ON l_partkey = p_partkey GROUP BY 1, 2, 3 ORDER BY listing_count DESC, skill_id
"""


@query("skill_demand", _SKILL_SQL.replace("LINKS", "lineitem"))
def skill_demand(t: Tables) -> DataFrame:
    return V.skill_demand(*_skills(t))


@query("skill_demand_active", _SKILL_SQL.replace(
    "LINKS", "(SELECT lineitem.* FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH'))"))
def skill_demand_active(t: Tables) -> DataFrame:
    return V.skill_demand(*_skills(t), listings=t.listings())


def _users(t: Tables) -> DataFrame:
    return t("supplier").select(
        F.col("s_suppkey").alias("id"), F.concat(F.lower("s_name"), F.lit("@example.com")).alias("email"), F.col("s_name").alias("full_name"))


def _roles(t: Tables) -> DataFrame:
    return t("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("company_id"), F.col("c_nationkey").cast("bigint").alias("user_id"),
        F.when(F.col("c_mktsegment") == "BUILDING", "job_poster").otherwise("company_admin").alias("role"),
        (F.col("c_acctbal") > 4000).alias("approved"), F.lit("2001-01-01").cast("timestamp_ntz").alias("created_at"))


@query("pending_companies", """
    SELECT c_custkey AS id, c_name AS common_name, lower(s_name) || '@example.com' AS submitted_by_email, s_name AS submitted_by_name
    FROM customer LEFT JOIN supplier ON c_mktsegment <> 'BUILDING' AND s_suppkey = c_nationkey WHERE NOT c_acctbal > 0
""")
def pending_companies(t: Tables) -> DataFrame:
    company = t.companies().select("id", "common_name", "approved", F.lit("2001-01-01").cast("timestamp_ntz").alias("created_at"))
    out = V.pending_companies(company, _roles(t), _users(t))
    return out.select("id", "common_name", "submitted_by_email", "submitted_by_name")


@query("pending_queue", """
    SELECT o_orderkey AS id, 'Job ' || o_orderpriority AS job_title, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS created_at,
           c_name AS company_name, lower(s_name) || '@example.com' AS posted_by_email, 'external_url' AS application_method
    FROM orders JOIN customer ON c_custkey = o_custkey LEFT JOIN supplier ON s_suppkey = o_custkey % 200
    WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
""")
def pending_queue(t: Tables) -> DataFrame:
    listings = t.listings().withColumn("posted_by", F.col("company_id") % 200).withColumn(
        "application_method", F.lit("external_url"))
    out = V.pending_listings(listings, t.companies(), _users(t))
    return out.withColumn("created_at", second_text("created_at"))


@query("pending_roles", """
    SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'BUILDING' THEN 'job_poster' ELSE 'company_admin' END AS role,
           lower(s_name) || '@example.com' AS user_email, s_name AS user_name, c_name AS company_name
    FROM customer JOIN supplier ON s_suppkey = c_nationkey WHERE NOT c_acctbal > 4000
""")
def pending_roles(t: Tables) -> DataFrame:
    return V.pending_roles(_roles(t), _users(t), t.companies()).drop("created_at")


@query("public_listings", """
    SELECT o_orderkey AS id, o_custkey AS company_id FROM orders JOIN customer ON c_custkey = o_custkey
    WHERE o_orderstatus = 'O' AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND c_acctbal > 0 AND NOT c_acctbal > 9000
""")
def public_listings(t: Tables) -> DataFrame:
    return V.public_listings(t.listings(), t.companies()).select("id", "company_id")


@query("recent_runs", """
    SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS started_at FROM events ORDER BY ts DESC, event_id DESC LIMIT 5
""")
def recent_runs(t: Tables) -> DataFrame:
    out = V.most_recent(t("events").select("event_id", "event_type", "ts"), "ts", 5, "event_id")
    return out.select("event_id", "event_type", second_text("ts").alias("started_at"))


@query("recent_pending", """
    SELECT o_orderkey AS id, 'Job ' || o_orderpriority AS job_title FROM orders WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH')
    ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 20
""")
def recent_pending(t: Tables) -> DataFrame:
    return V.most_recent(t.listings().where(~F.col("approved")), "created_at", 20).select("id", "job_title")


@query("last_completed", """
    SELECT user_id AS company_id, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_completed FROM events WHERE event_type = 'purchase' GROUP BY 1
""")
def last_completed(t: Tables) -> DataFrame:
    runs = t("events").where(F.col("event_type") == "purchase").select(F.col("user_id").alias("company_id"), F.col("ts").alias("completed_at"))
    return V.last_completed(runs).withColumn("last_completed", F.date_format("last_completed", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("run_stats", """
    WITH e AS (SELECT strftime(ts, '%Y-%m-%d') AS job_board, user_id AS company_id,
                 CASE WHEN event_type IN ('signup', 'purchase') THEN 'added' WHEN event_type = 'error' THEN 'skipped' ELSE 'updated' END AS outcome,
                 CASE WHEN event_type = 'error' THEN (['short_content', 'missing_url', 'outside_area'])[user_id % 2 + event_id % 2 + 1] END AS reason FROM events),
    r AS (SELECT job_board, company_id, reason, count(*) AS n FROM e WHERE reason IS NOT NULL GROUP BY 1, 2, 3),
    x AS (SELECT job_board, company_id, string_agg(reason || ':' || n, ',' ORDER BY reason) AS errors FROM r GROUP BY 1, 2)
    SELECT job_board, company_id, count(*) AS jobs_found, count(*) FILTER (WHERE outcome = 'added') AS jobs_added,
           count(*) FILTER (WHERE outcome = 'updated') AS jobs_updated, count(*) FILTER (WHERE outcome = 'skipped') AS jobs_skipped,
           coalesce(any_value(errors), '') AS errors
    FROM e LEFT JOIN x USING (job_board, company_id) GROUP BY 1, 2
""")
def run_stats(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    outcome = F.when(kind.isin("signup", "purchase"), "added").when(kind == "error", "skipped").otherwise("updated")
    reasons = F.array(F.lit("short_content"), F.lit("missing_url"), F.lit("outside_area"))
    index = (F.col("user_id") % 2 + F.col("event_id") % 2 + 1).cast("int")
    rows = t("events").select(
        F.date_format("ts", "yyyy-MM-dd").alias("job_board"), F.col("user_id").alias("company_id"),
        outcome.alias("outcome"), F.when(kind == "error", F.element_at(reasons, index)).alias("reason"))
    entries = F.transform(F.map_entries("errors"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return V.run_stats(rows).withColumn("errors", F.array_join(entries, ","))


@query("run_durations", """
    SELECT user_id, CAST(epoch(date_trunc('second', max(ts))) - epoch(date_trunc('second', min(ts))) AS BIGINT) AS duration_seconds
    FROM events GROUP BY 1
""")
def run_durations(t: Tables) -> DataFrame:
    runs = t("events").groupBy("user_id").agg(F.min("ts").alias("started_at"), F.max("ts").alias("completed_at"))
    return V.with_duration(runs).select("user_id", "duration_seconds")


FUNNEL_TEXTS = ["OK Tulsa - HQ", "2 Locations", "Houston", "3 locations", "tulsa"]
FUNNEL_REASON = ["Contains city", "Multi-location", "No indicator", "Multi-location", "Contains city"]
FUNNEL_PASS = [True, True, False, True, True]


def _funnel(t: Tables):
    place = pick(FUNNEL_TEXTS, F.col("doc_id"))
    low = F.lower(place)
    one = A.location_mentions(place, A.STAGE_ONE_WORDS)
    two = A.location_mentions("text", ("the",))
    reason = F.when(low.contains("tulsa"), "Contains city").when(low.contains("locations"), "Multi-location").otherwise("No indicator")
    return t("documents"), one, two, reason


_FUNNEL_SQL = f"""
    WITH d AS (SELECT {sql_pick(FUNNEL_REASON, 'doc_id')} AS reason, {sql_pick(FUNNEL_PASS, 'doc_id')} AS s1, contains(lower(text), 'the') AS s2 FROM documents)
"""


@query("filter_funnel", f"""{_FUNNEL_SQL}
    SELECT 1 AS stage, s1 AS accepted, reason, count(*) AS n FROM d GROUP BY 2, 3
    UNION ALL SELECT 2, s2, reason, count(*) FROM d WHERE s1 GROUP BY 2, 3
""")
def filter_funnel(t: Tables) -> DataFrame:
    return A.funnel(*_funnel(t))


@query("funnel_summary", f"""{_FUNNEL_SQL}
    SELECT count(*) AS total, count(*) FILTER (WHERE s1) AS accepted, count(*) FILTER (WHERE s1 AND s2) AS confirmed,
           count(*) FILTER (WHERE NOT s1) AS rejected, count(*) FILTER (WHERE s1 AND NOT s2) AS dropped,
           round(count(*) FILTER (WHERE s1 AND s2) * 100 / count(*) FILTER (WHERE s1), 1) AS success_rate
    FROM d
""")
def funnel_summary(t: Tables) -> DataFrame:
    docs, one, two, _ = _funnel(t)
    return A.funnel_summary(docs, one, two)


@query("rejected_examples", f"""{_FUNNEL_SQL.replace('SELECT', 'SELECT doc_id,', 1)}
    SELECT doc_id, reason, (SELECT greatest(count(*) - 10, 0) FROM d WHERE NOT s1) AS more FROM d WHERE NOT s1 ORDER BY doc_id LIMIT 10
""")
def rejected_examples(t: Tables) -> DataFrame:
    docs, one, _, reason = _funnel(t)
    return V.first_examples(docs.where(~one).select("doc_id", reason.alias("reason")), ["doc_id"], 10)


def _names(t: Tables):
    used = t("part").select(
        F.when(F.col("p_size") % 2 == 0, "even").otherwise("odd").alias("table_name"), F.col("p_brand").alias("name"),
        F.col("p_name").alias("place"))
    dimension = t("nation").select(
        F.explode(F.array(F.lit("even"), F.lit("odd"))).alias("table_name"),
        F.concat(F.lit("Brand#"), (F.col("n_nationkey") + 11).cast("string")).alias("name"))
    return used, dimension


_AUDIT_SQL = """
    WITH used AS (SELECT DISTINCT CASE WHEN p_size % 2 = 0 THEN 'even' ELSE 'odd' END AS table_name, p_brand AS name, p_name AS place FROM part),
    real AS (SELECT unnest(['even', 'odd']) AS table_name, 'Brand#' || (n_nationkey + 11) AS name FROM nation),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY table_name, name ORDER BY place) AS rn FROM used),
    mine AS (SELECT table_name, name, count(*) AS places,
                    string_agg(place, ', ' ORDER BY place) FILTER (WHERE rn <= 3)
                    || CASE WHEN count(*) > 3 THEN ', +' || (count(*) - 3) || ' more' ELSE '' END AS shown FROM ranked GROUP BY 1, 2),
    audit AS (SELECT coalesce(mine.table_name, real.table_name) AS table_name, coalesce(mine.name, real.name) AS name,
              CASE WHEN mine.name IS NULL THEN 'unused' WHEN real.name IS NULL THEN 'MISMATCH' ELSE 'OK' END AS marker,
              coalesce(places, 0) AS places, shown
              FROM mine FULL JOIN real ON mine.table_name = real.table_name AND mine.name = real.name)
"""


@query("name_audit", f"{_AUDIT_SQL} SELECT * FROM audit")
def name_audit(t: Tables) -> DataFrame:
    return A.name_audit(*_names(t))


@query("name_audit_totals", f"""{_AUDIT_SQL}
    SELECT table_name, count(*) FILTER (WHERE marker <> 'unused') AS names, count(*) FILTER (WHERE marker = 'MISMATCH') AS mismatches,
           count(*) FILTER (WHERE marker = 'unused') AS unused FROM audit GROUP BY 1
""")
def name_audit_totals(t: Tables) -> DataFrame:
    return A.mismatch_totals(A.name_audit(*_names(t)))


@query("names_never_used", f"{_AUDIT_SQL} SELECT table_name, name FROM real EXCEPT SELECT table_name, name FROM used")
def names_never_used(t: Tables) -> DataFrame:
    used, dimension = _names(t)
    return A.never_used(dimension, used)


@query("names_not_existing", f"{_AUDIT_SQL} SELECT table_name, name FROM audit WHERE marker = 'MISMATCH'")
def names_not_existing(t: Tables) -> DataFrame:
    used, dimension = _names(t)
    return A.not_existing(used, dimension)


SITE_NAMES = [None, "  ", "Main", "", "Yard"]


@query("site_review", f"""
    SELECT c_custkey AS id, n_name AS city_name, CASE WHEN c_custkey % 5 IN (2, 4) THEN 'keep' ELSE 'DELETE' END AS action
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey AND c_acctbal > 0
    WHERE c_nationkey = (SELECT s_nationkey FROM supplier WHERE s_name = 'Supplier#000000001')
""")
def sites_to_review(t: Tables) -> DataFrame:
    sites = t("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("company_id"),
        pick(SITE_NAMES, F.col("c_custkey")).alias("site_name"),
        F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("city_id"))
    cities = t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("city_name"))
    companies = t("supplier").select(F.col("s_nationkey").alias("id"), F.col("s_name").alias("common_name"))
    return site_review(sites, cities, companies, "Supplier#000000001").select("id", "city_name", "action")


@query("blank_sites", """
    SELECT c_nationkey, count(*) FILTER (WHERE c_custkey % 5 NOT IN (2, 4)) AS to_delete FROM customer GROUP BY 1
""")
def blank_sites(t: Tables) -> DataFrame:
    sites = t("customer").select("c_nationkey", pick(SITE_NAMES, F.col("c_custkey")).alias("site_name"))
    return sites.groupBy("c_nationkey").agg(F.count_if(site_action() == "DELETE").alias("to_delete"))


@query("saved_filters", """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def saved_filters(t: Tables) -> DataFrame:
    return feeds.saved_filters(t("events").select("event_id", "props"), "props").select("event_id", "k")


@query("filter_entries", """
    SELECT event_id, 'k' AS name, json_extract_string(props, '$.k') AS value, 'bigint' AS kind FROM events
    UNION ALL SELECT event_id, 'places', event_type || n, 'string' FROM events, (SELECT unnest(range(1, 3)) AS n) WHERE event_id % 2 = 0
    UNION ALL SELECT event_id, 'remote', 'true', 'boolean' FROM events WHERE event_id % 2 = 1
""")
def filter_entries(t: Tables) -> DataFrame:
    # filters that no schema names: a list of texts in some, a flag and an empty value in others
    more = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(', "places": ["'), "event_type", F.lit('1", "'), "event_type", F.lit('2"]}'))).otherwise(', "remote": true, "none": null}')
    text = F.concat(F.regexp_replace("props", r"}\s*$", ""), more)
    return feeds.filters_of_any_shape(t("events").select("event_id", text.alias("filters")), "filters", ["event_id"])


@query("filter_value_counts", """
    SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1
""")
def filter_value_counts(t: Tables) -> DataFrame:
    return A.facet_counts(feeds.saved_filters(t("events").select("props"), "props"), "k")


@query("source_configuration", """
    SELECT doc_id, CASE WHEN s_suppkey IS NULL THEN 'unknown_source' END AS config_error, s_name AS jobboard
    FROM documents LEFT JOIN supplier ON 'src' || s_suppkey = source AND s_suppkey < 15
""")
def source_configuration(t: Tables) -> DataFrame:
    config = t("supplier").where(F.col("s_suppkey") < 15).select(
        F.concat(F.lit("src"), F.col("s_suppkey").cast("string")).alias("source"), F.col("s_name").alias("jobboard"), F.lit(1).alias("pos"))
    # every source is configured twice; the first entry counts
    config = config.unionByName(config.select("source", F.lit("later").alias("jobboard"), F.lit(2).alias("pos")))
    return feeds.with_source_config(t("documents").select("doc_id", "source"), config, order=["pos"]).select("doc_id", "config_error", "jobboard")


# --- quality ----------------------------------------------------------------

METHODS = ["external_url", "email", "fax", "in_platform"]
FREQUENCIES = ["hourly", None, "yearly", "monthly"]
URLS = ["HTTP://a.example.com", "ftp://a", None, "https://a b"]


def _checked(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    return t("orders").select(
        "o_orderkey", F.when(F.col("o_orderpriority") == "5-LOW", "  ").otherwise(F.col("o_orderpriority")).alias("job_title"),
        pick(METHODS, k).alias("application_method"),
        F.when(F.col("o_orderstatus") == "O", "a@example.com").alias("application_email"),
        pick(URLS, F.col("o_custkey")).alias("posting_url"),
        (F.col("o_totalprice") - 20000).cast("decimal(10,2)").alias("minimum_salary"),
        F.when(F.col("o_orderstatus") != "P", F.lit(100000)).cast("decimal(10,2)").alias("maximum_salary"),
        pick(FREQUENCIES, k).alias("pay_frequency"), F.to_date("o_orderdate").alias("date_posted"),
        F.lit("1998-01-01").cast("date").alias("date_closed"),
        (F.col("o_custkey") % 130).cast("int").alias("travel_percentage"))


_CHECKED_SQL = f"""
    WITH o AS (SELECT o_orderkey, o_orderpriority = '5-LOW' AS b1, {sql_pick(METHODS, 'o_orderkey')} = 'fax' AS b2,
      {sql_pick(METHODS, 'o_orderkey')} = 'email' AND o_orderstatus <> 'O' AS b3,
      coalesce(NOT regexp_matches({sql_pick(URLS, 'o_custkey')}, '(?i)^https?://'), false) AS b4,
      CAST(o_totalprice AS DECIMAL(12,2)) - 20000 <= 0 AS b5,
      o_orderstatus <> 'P' AND CAST(o_totalprice AS DECIMAL(12,2)) - 20000 > 100000 AS b6,
      coalesce({sql_pick(FREQUENCIES, 'o_orderkey')} = 'yearly', false) AS b7, o_orderdate > TIMESTAMP '1998-01-01' AS b8,
      o_custkey % 130 > 100 AS b9 FROM orders)
"""
_RULE_NAMES = ["job_title_not_blank", "application_method_allowed", "email_for_email_method", "posting_url_http",
               "minimum_salary_positive", "minimum_salary_before_maximum_salary", "pay_frequency_allowed",
               "date_posted_before_date_closed", "travel_percentage_range"]


@query("quality_report", _CHECKED_SQL + " UNION ALL ".join(
    f"SELECT 'joblistings' AS table_name, '{name}' AS rule, count(*) FILTER (WHERE b{i}) AS violations FROM o"
    for i, name in enumerate(_RULE_NAMES, 1)))
def quality_report(t: Tables) -> DataFrame:
    rows = _checked(t)
    return Q.violation_counts(rows, Q.listing_rules(rows.columns), "joblistings")


@query("quality_rejects", _CHECKED_SQL + "SELECT o_orderkey, array_to_string(list_filter([" + ", ".join(
    f"CASE WHEN b{i} THEN '{name}' END" for i, name in enumerate(_RULE_NAMES, 1))
    + "], lambda x: x IS NOT NULL), ',') AS violations FROM o WHERE " + " OR ".join(f"b{i}" for i in range(1, 10)))
def quality_rejects(t: Tables) -> DataFrame:
    rows = _checked(t)
    _, bad = Q.split_by_quality(rows, Q.listing_rules(rows.columns))
    return bad.select("o_orderkey", F.array_join("violations", ",").alias("violations"))


@query("quality_runs", """
    WITH r AS (SELECT user_id, count(*) AS jobs_found, count(*) FILTER (WHERE event_type IN ('view', 'click')) AS jobs_added,
                      count(*) FILTER (WHERE event_type IN ('view', 'purchase')) AS jobs_updated,
                      count(*) FILTER (WHERE event_type = 'signup') - 3 AS jobs_skipped, min(value) AS lo, max(value) AS hi FROM events GROUP BY 1)
    SELECT 'scrapinglog' AS table_name, 'run_counts_not_negative' AS rule, count(*) FILTER (WHERE jobs_skipped < 0) AS violations FROM r
    UNION ALL SELECT 'scrapinglog', 'run_counts_add_up', count(*) FILTER (WHERE jobs_added + jobs_updated + jobs_skipped > jobs_found) FROM r
    UNION ALL SELECT 'scrapinglog', 'lo_before_hi', count(*) FILTER (WHERE lo >= hi) FROM r
""")
def quality_runs(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    runs = t("events").groupBy("user_id").agg(
        F.count(F.lit(1)).alias("jobs_found"), F.count_if(kind.isin("view", "click")).alias("jobs_added"),
        F.count_if(kind.isin("view", "purchase")).alias("jobs_updated"),
        (F.count_if(kind == "signup") - 3).alias("jobs_skipped"), F.min("value").alias("lo"), F.max("value").alias("hi"))
    return Q.violation_counts(runs, [*Q.run_counts(), Q.ordered("lo", "hi", strict=True)], "scrapinglog")


@query("quality_links", """
    SELECT 'companytechnologies' AS table_name, 'l_linestatus_allowed' AS rule, count(*) FILTER (WHERE l_linestatus = 'F') AS violations FROM lineitem
    UNION ALL SELECT 'companytechnologies', 'l_quantity_range', count(*) FILTER (WHERE l_quantity < 5 OR l_quantity > 45) FROM lineitem
    UNION ALL SELECT 'companytechnologies', 'url_http_no_blank', count(*) FILTER (WHERE l_returnflag = 'N') FROM lineitem
    UNION ALL SELECT 'companytechnologies', 'l_returnflag_length', 0 FROM region WHERE r_regionkey = 0
""")
def quality_links(t: Tables) -> DataFrame:
    url = F.when(F.col("l_returnflag") == "N", "https://a b").otherwise("https://a")
    rows = t("lineitem").select(
        "l_quantity", "l_returnflag", url.alias("url"),
        F.when(F.col("l_linestatus") == "O", "expert").otherwise("wizard").alias("l_linestatus"))
    rules = [Q.allowed("l_linestatus", "proficiency"), Q.between("l_quantity", 5, 45), Q.social_url("url"), Q.max_length("l_returnflag", 1)]
    return Q.violation_counts(rows, rules, "companytechnologies")


@query("quality_uniqueness", """
    SELECT l_orderkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def quality_uniqueness(t: Tables) -> DataFrame:
    return Q.repeated_keys(t("lineitem"), ["l_orderkey", "l_partkey"])


@query("quality_orphans", """
    SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 5000)
""")
def quality_orphans(t: Tables) -> DataFrame:
    known = t("supplier").where(F.col("s_acctbal") > 5000)
    out = Q.orphans(t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"), "l_suppkey", known, "s_suppkey")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey")


def _constrained(t: Tables) -> dict[str, DataFrame]:
    """The given tables under the names of the schema, with faults: repeated pairs, names and missing parents."""
    few = t("customer").where(F.col("c_acctbal") > 0)
    o, li = t("orders"), t("lineitem")
    company = few.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").cast("long").alias("company_type"), (F.col("c_custkey") * 3).alias("approved_by"))
    pairs = li.select(F.col("l_orderkey").alias("job_listing_id"), F.col("l_partkey").alias("skill_id"))
    seen = o.select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("job_listing_id"), F.col("o_custkey").alias("company_id"))
    return {
        "country": t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name")),
        "state": t("nation").select(F.col("n_nationkey").alias("id"), (F.col("n_regionkey") + 1).alias("country_id"), F.lit("same").alias("name")),
        "company_type": t("nation").where("n_nationkey < 20").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name")),
        "users": t("customer").select(F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("email"),
                                      F.when(F.col("c_acctbal") > 5000, "x").alias("oauth_provider"), F.col("c_mktsegment").alias("oauth_subject")),
        "company": company,
        "skills": t("part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
        "joblistings": o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("company_id"), F.col("o_custkey").alias("posted_by")),
        "joblistingskills": pairs, "saved_jobs": seen.drop("company_id"), "user_company_roles": seen.drop("job_listing_id"),
    }


_COMPANY_SQL = "company AS (SELECT c_custkey AS id, c_nationkey AS company_type, c_custkey * 3 AS approved_by FROM customer WHERE c_acctbal > 0)"
_UNIQUE_CHECKS = [
    ("country", "name", "SELECT r_name AS a, 1 AS b FROM region"), ("state", "country_id, name", "SELECT n_regionkey AS a, 1 AS b FROM nation"),
    ("company_type", "name", "SELECT n_name AS a, 1 AS b FROM nation WHERE n_nationkey < 20"), ("skills", "name", "SELECT p_name AS a, 1 AS b FROM part"),
    ("users", "email", "SELECT c_mktsegment AS a, 1 AS b FROM customer"),
    ("users", "oauth_provider, oauth_subject", "SELECT 'x' AS a, c_mktsegment AS b FROM customer WHERE c_acctbal > 5000"),
    ("user_company_roles", "user_id, company_id", "SELECT o_custkey AS a, o_custkey AS b FROM orders"),
    ("joblistingskills", "job_listing_id, skill_id", "SELECT l_orderkey AS a, l_partkey AS b FROM lineitem"),
    ("saved_jobs", "user_id, job_listing_id", "SELECT o_custkey AS a, o_orderkey AS b FROM orders"),
]
_PARENT_CHECKS = [
    ("state", "country_id", "country", "SELECT n_regionkey + 1 AS k FROM nation", "SELECT r_regionkey FROM region"),
    ("company", "company_type", "company_type", "SELECT company_type AS k FROM company", "SELECT n_nationkey FROM nation WHERE n_nationkey < 20"),
    ("company", "approved_by", "users", "SELECT approved_by AS k FROM company", "SELECT c_custkey FROM customer"),
    ("user_company_roles", "user_id", "users", "SELECT o_custkey AS k FROM orders", "SELECT c_custkey FROM customer"),
    ("user_company_roles", "company_id", "company", "SELECT o_custkey AS k FROM orders", "SELECT id FROM company"),
    ("joblistings", "company_id", "company", "SELECT o_custkey AS k FROM orders", "SELECT id FROM company"),
    ("joblistings", "posted_by", "users", "SELECT o_custkey AS k FROM orders", "SELECT c_custkey FROM customer"),
    ("joblistingskills", "job_listing_id", "joblistings", "SELECT l_orderkey AS k FROM lineitem", "SELECT o_orderkey FROM orders"),
    ("joblistingskills", "skill_id", "skills", "SELECT l_partkey AS k FROM lineitem", "SELECT p_partkey FROM part"),
    ("saved_jobs", "user_id", "users", "SELECT o_custkey AS k FROM orders", "SELECT c_custkey FROM customer"),
    ("saved_jobs", "job_listing_id", "joblistings", "SELECT o_orderkey AS k FROM orders", "SELECT o_orderkey FROM orders"),
]


@query("quality_unique_keys", "\n    UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{key}' AS columns, count(*) AS repeated_keys, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS rows_over FROM "
    f"(SELECT a, b, count(*) AS n FROM ({rows}) GROUP BY 1, 2 HAVING count(*) > 1)" for name, key, rows in _UNIQUE_CHECKS))
def quality_unique_keys(t: Tables) -> DataFrame:
    return Q.uniqueness_report(_constrained(t))


@query("quality_foreign_keys", f"WITH {_COMPANY_SQL} " + "\n    UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{key}' AS column, '{parent}' AS parent, count(*) AS orphans FROM ({rows}) WHERE k NOT IN ({known})"
    for name, key, parent, rows, known in _PARENT_CHECKS))
def quality_foreign_keys(t: Tables) -> DataFrame:
    return Q.orphan_report(_constrained(t))
