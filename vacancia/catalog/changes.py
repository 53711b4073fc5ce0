"""Change operators over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from vacancia.catalog.registry import (
    SQL_COMPANIES, SQL_INCOMING, SQL_LISTINGS, SQL_STORED, Tables, day_text, query, second_text,
)
from vacancia.functions import categories as C
from vacancia.operators import deletes as Del, dims, merge as M
from vacancia.plans.cycle import commit_cycle, commit_in_place, run_cycle
from vacancia.session import scratch_path
from vacancia.sources.state import Layout, commit_parts, read_state
from vacancia.sources.tables import read_appended, read_whole, with_defaults

AS_OF = "2002-01-01 12:00:00"

_CYCLE = f"""
    WITH {SQL_STORED}, {SQL_INCOMING}, {SQL_COMPANIES},
    totals AS (SELECT company_id, count(*) AS landed FROM incoming GROUP BY 1),
    marked AS (
      SELECT s.*, i.posting_url IS NOT NULL AS seen, c.last_full_scrape_completed AS cutoff, t.landed
      FROM stored s LEFT JOIN incoming i ON i.posting_url = s.posting_url
      LEFT JOIN companies c ON c.id = s.company_id LEFT JOIN totals t ON t.company_id = s.company_id),
    acted AS (
      SELECT *, CASE WHEN seen THEN 'touched'
                     WHEN job_status <> 'closed' AND landed IS NOT NULL AND GATE AND updated_at < cutoff THEN 'closed'
                     ELSE 'kept' END AS action FROM marked),
    fresh AS (
      SELECT (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY md5(company_id || chr(31) || posting_url)) AS id,
             company_id, posting_url FROM incoming WHERE posting_url NOT IN (SELECT posting_url FROM stored)),
    staged AS (
      SELECT id, company_id, posting_url, action, CASE WHEN action = 'closed' THEN 'closed' ELSE job_status END AS job_status,
             strftime(CASE WHEN action = 'kept' THEN updated_at ELSE TIMESTAMP '2002-01-01 12:00:00' END, '%Y-%m-%d %H:%M:%S') AS updated_at,
             strftime(CASE WHEN action = 'closed' THEN DATE '2002-01-01' ELSE date_closed END, '%Y-%m-%d') AS date_closed
      FROM acted
      UNION ALL
      SELECT id, company_id, posting_url, 'inserted', 'active', '2002-01-01 12:00:00', NULL FROM fresh)
"""
_STAGED = _CYCLE.replace("GATE", "true")


def _staged_text(staged: DataFrame) -> DataFrame:
    return staged.select(
        "id", "company_id", "posting_url", "action", "job_status",
        second_text("updated_at").alias("updated_at"), day_text("date_closed").alias("date_closed"))


@query("snapshot_merge", f"{_STAGED} SELECT * FROM staged")
def snapshot_merge(t: Tables) -> DataFrame:
    return _staged_text(M.merge_snapshot(t.stored(), t.incoming(), t.companies(), AS_OF, feed_order=["pos"]))


@query("merge_change_counts", f"{_STAGED} SELECT action, count(*) AS n FROM staged GROUP BY 1")
def merge_change_counts(t: Tables) -> DataFrame:
    return M.change_counts(M.merge_snapshot(t.stored(), t.incoming(), t.companies(), AS_OF))


@query("merge_change_set", f"{_STAGED} SELECT id, company_id, posting_url, action FROM staged WHERE action <> 'kept'")
def merge_change_set(t: Tables) -> DataFrame:
    return M.change_set(M.merge_snapshot(t.stored(), t.incoming(), t.companies(), AS_OF))


_GUARDED = _CYCLE.replace("GATE", "s_company % 7 <> 0 AND s_company % 5 <> 0").replace(
    "SELECT s.*, i.posting_url", "SELECT s.*, s.company_id AS s_company, i.posting_url").replace(
    "totals AS (SELECT company_id, count(*) AS landed FROM incoming GROUP BY 1)",
    "totals AS (SELECT o_custkey AS company_id, count(*) AS landed FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)").replace(
    SQL_INCOMING, SQL_INCOMING.replace("WHERE o_orderstatus <> 'F'", "WHERE o_orderstatus <> 'F' AND o_orderkey % 11 <> 0"))


@query("snapshot_merge_guarded", f"{_GUARDED} SELECT * FROM staged")
def snapshot_merge_guarded(t: Tables) -> DataFrame:
    # some postings land twice, some are dropped by the adapter; every fifth company announces
    # one more than landed, and every seventh announces nothing
    landed = t.incoming().unionByName(t.incoming().where(F.col("pos") % 3 == 0))
    feed = landed.where(F.col("pos") % 11 != 0)
    totals = t.incoming().groupBy("company_id").agg(F.count(F.lit(1)).alias("n"))
    more = F.when(F.col("company_id") % 5 == 0, 1).otherwise(0)
    announced = totals.where(F.col("company_id") % 7 != 0).select("company_id", (F.col("n") + more).alias("total"))
    return _staged_text(M.merge_snapshot(t.stored(), feed, t.companies(), AS_OF, announced=announced, landed=landed))


@query("snapshot_merge_active_only", f"""
    WITH {SQL_STORED}, {SQL_INCOMING}
    SELECT 'touched' AS action, count(*) AS n FROM incoming JOIN stored USING (posting_url) WHERE job_status = 'active'
    UNION ALL
    SELECT 'inserted', count(*) FROM incoming
    WHERE posting_url NOT IN (SELECT posting_url FROM stored WHERE job_status = 'active')
""")
def snapshot_merge_active_only(t: Tables) -> DataFrame:
    staged = M.merge_snapshot(t.stored(), t.incoming(), t.companies(), AS_OF, active_only=True)
    counted = M.change_counts(staged)
    return counted.where(F.col("action").isin("touched", "inserted"))


@query("snapshot_merge_keys_only", f"""
    WITH {SQL_STORED}, {SQL_INCOMING}
    SELECT company_id, posting_url, 'touched' AS action FROM incoming WHERE posting_url IN (SELECT posting_url FROM stored WHERE job_status = 'active')
    UNION ALL
    SELECT company_id, posting_url, 'inserted' FROM incoming WHERE posting_url NOT IN (SELECT posting_url FROM stored WHERE job_status = 'active')
""")
def snapshot_merge_keys_only(t: Tables) -> DataFrame:
    # the feed has nothing but its keys, and every posting twice: no column tells the copies apart
    feed = t.incoming().select("company_id", "posting_url")
    staged = M.merge_snapshot(t.stored(), feed.unionByName(feed), t.companies(), AS_OF, active_only=True)
    return staged.where(F.col("action").isin("touched", "inserted")).select("company_id", "posting_url", "action")


def _closed(listings: DataFrame) -> DataFrame:
    return listings.select(
        "id", "job_status", "action", day_text("date_closed").alias("date_closed"),
        second_text("updated_at").alias("updated_at"))


def _sql_close(condition: str, status: str, dated: bool = True) -> str:
    date = "DATE '2002-01-01'" if dated else "date_closed"
    return f"""
    WITH {SQL_STORED}, {SQL_COMPANIES},
    m AS (SELECT s.*, coalesce({condition}, false) AS stale FROM stored s LEFT JOIN companies c ON c.id = s.company_id)
    SELECT id, CASE WHEN stale THEN '{status}' ELSE job_status END AS job_status,
           CASE WHEN stale THEN 'closed' ELSE 'kept' END AS action,
           strftime(CASE WHEN stale THEN {date} ELSE date_closed END, '%Y-%m-%d') AS date_closed,
           strftime(CASE WHEN stale THEN TIMESTAMP '2002-01-01 12:00:00' ELSE updated_at END, '%Y-%m-%d %H:%M:%S') AS updated_at
    FROM m
    """


@query("stale_close", _sql_close("job_status <> 'closed' AND updated_at < c.last_full_scrape_completed", "closed"))
def stale_close(t: Tables) -> DataFrame:
    return _closed(M.close_stale(t.stored(), t.companies(), AS_OF))


@query("stale_expire_after_days", _sql_close("job_status = 'active' AND updated_at < TIMESTAMP '2002-01-01 12:00:00' - INTERVAL 900 DAY", "expired"))
def stale_expire_after_days(t: Tables) -> DataFrame:
    rule = M.stale_after_days(AS_OF, 900)
    return _closed(M.close_stale(t.stored(), t.companies(), AS_OF, rule=rule, status="expired", active_only=True))


@query("stale_since_start", _sql_close("job_status = 'active' AND updated_at < TIMESTAMP '1999-03-01' AND date_closed IS NULL", "closed"))
def stale_since_start(t: Tables) -> DataFrame:
    rule = M.stale_since_start("1999-03-01 00:00:00")
    return _closed(M.close_stale(t.stored(), t.companies(), AS_OF, rule=rule, active_only=True))


@query("stale_before_today", _sql_close("job_status = 'active' AND CAST(updated_at AS DATE) < DATE '2002-01-01'", "closed", dated=False))
def stale_before_today(t: Tables) -> DataFrame:
    rule = M.stale_before_today(AS_OF)
    return _closed(M.close_stale(t.stored(), t.companies(), AS_OF, rule=rule, active_only=True, dated=False))


@query("reopen", f"""
    WITH {SQL_LISTINGS}, asked AS (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'),
    m AS (SELECT *, job_status = 'closed' AND date_closed >= DATE '1999-06-01' AND company_id IN (SELECT c_custkey FROM asked) AS reopened FROM listings)
    SELECT id, reopened, CASE WHEN reopened THEN 'active' ELSE job_status END AS job_status,
           strftime(CASE WHEN NOT reopened THEN date_closed END, '%Y-%m-%d') AS date_closed
    FROM (SELECT id, job_status, date_closed, coalesce(reopened, false) AS reopened FROM m)
""")
def reopen(t: Tables) -> DataFrame:
    asked = t("customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("company_id"))
    out = M.reopen(t.listings(), asked, "1999-06-01", AS_OF)
    return out.select("id", "reopened", "job_status", day_text("date_closed").alias("date_closed"))


@query("reopen_count", f"""
    WITH {SQL_LISTINGS}
    SELECT count(*) AS jobs_reopened FROM listings WHERE job_status = 'closed' AND date_closed >= DATE '1999-06-01'
      AND company_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def reopen_count(t: Tables) -> DataFrame:
    asked = t("customer").where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("company_id"))
    out = M.reopen(t.listings(), asked, "1999-06-01", AS_OF)
    return out.agg(F.count_if("reopened").alias("jobs_reopened"))


@query("overwrite_match", """
    SELECT c_custkey AS id, CASE WHEN s_suppkey IS NOT NULL THEN CASE WHEN s_acctbal > 0 THEN s_name END ELSE c_name END AS job_title,
           CASE WHEN s_suppkey IS NOT NULL THEN '2002-01-01 12:00:00' END AS updated_at
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
""")
def overwrite_match(t: Tables) -> DataFrame:
    current = t("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_custkey").alias("posting_url"), F.col("c_name").alias("job_title"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    incoming = t("supplier").select(
        F.col("s_suppkey").alias("posting_url"), F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("job_title"))
    # every posting comes twice; the first one counts
    incoming = incoming.withColumn("pos", F.lit(1)).unionByName(
        incoming.select("posting_url", F.lit("later").alias("job_title"), F.lit(2).alias("pos")))
    out = M.overwrite_matched(current, incoming, AS_OF, ["job_title"], order=["pos"])
    return out.select("id", "job_title", second_text("updated_at").alias("updated_at"))


@query("patch_update", """
    SELECT c_custkey AS id, coalesce(nullif(CASE WHEN s_acctbal > 5000 THEN s_name WHEN s_acctbal > 0 THEN '' END, ''), c_name) AS common_name,
           coalesce(CASE WHEN s_acctbal > 0 THEN s_nationkey END, c_nationkey) AS city_id,
           CASE WHEN s_suppkey IS NOT NULL THEN '2002-01-01 12:00:00' END AS updated_at
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
""")
def patch_update(t: Tables) -> DataFrame:
    table = t("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("common_name"), F.col("c_nationkey").alias("city_id"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    name = F.when(F.col("s_acctbal") > 5000, F.col("s_name")).when(F.col("s_acctbal") > 0, "")
    patch = t("supplier").select(
        F.col("s_suppkey").alias("id"), name.alias("common_name"),
        F.when(F.col("s_acctbal") > 0, F.col("s_nationkey")).alias("city_id"))
    # every patch comes twice; the first one counts
    patch = patch.withColumn("pos", F.lit(1)).unionByName(
        patch.select("id", F.lit("later").alias("common_name"), F.lit(-1).cast(patch.schema["city_id"].dataType).alias("city_id"), F.lit(2).alias("pos")))
    out = M.patch_rows(table, patch, AS_OF, order=["pos"])
    return out.select("id", "common_name", "city_id", second_text("updated_at").alias("updated_at"))


@query("recompute_derived", """
    SELECT p_partkey AS id, CASE WHEN p_size > 25 THEN 'Legal'
             WHEN contains(p_name, 'hr') THEN 'Human Resources' ELSE 'Other' END AS function
    FROM part
""")
def recompute_derived(t: Tables) -> DataFrame:
    listings = t("part").select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("job_title"), F.lit("Legal").alias("function"),
        F.when(F.col("p_size") > 25, "closed").otherwise("active").alias("job_status"),
        F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    out = M.recompute(listings, {"function": C.function_name("job_title")}, AS_OF)
    return out.select("id", "function")


NAME_SQL = "c_mktsegment || ([' ', ', ', ' & '])[c_custkey % 3 + 1] || c_nationkey"


def _wanted(t: Tables) -> DataFrame:
    joiner = F.element_at(F.array(F.lit(" "), F.lit(", "), F.lit(" & ")), (F.col("c_custkey") % 3 + 1).cast("int"))
    kind = F.when(F.col("c_mktsegment") == "MACHINERY", "Guild").when(F.col("c_mktsegment") == "BUILDING", "Startup")
    return t("customer").select(
        F.concat("c_mktsegment", joiner, F.col("c_nationkey").cast("string")).alias("common_name"),
        F.concat(F.lit("https://x.example.com/"), F.col("c_custkey").cast("string")).alias("website"),
        F.concat(F.lit("https://b.example.com/"), (-F.col("c_custkey")).cast("string")).alias("jobboard"),
        kind.alias("company_type_name"), F.col("c_custkey").alias("pos"))


def _stored_companies(t: Tables) -> DataFrame:
    # half of the suppliers' nations have a company, with suffixes that leave gaps
    k, n = F.col("s_suppkey"), F.col("s_nationkey").cast("string")
    slug = F.concat(F.lit("building-"), n, F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("-"), (k % 3).cast("string"))))
    rows = t("supplier").where(F.col("s_acctbal") > 5000).groupBy(slug.alias("slug")).agg(F.min("s_suppkey").alias("id"))
    return rows.select("id", "slug", F.concat(F.lit("HOUSEHOLD "), F.split_part("slug", F.lit("-"), F.lit(2))).alias("common_name"))


_STORED_SQL = """
    st AS (SELECT 'building-' || s_nationkey || CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE '-' || (s_suppkey % 3) END AS slug, min(s_suppkey) AS id
           FROM supplier WHERE s_acctbal > 5000 GROUP BY 1)
"""

_SLUG_SQL = f"""
    WITH {_STORED_SQL},
    names AS (SELECT DISTINCT {NAME_SQL} AS common_name FROM customer FILTERED),
    b AS (SELECT common_name, trim(regexp_replace(lower(common_name), '[^a-z0-9]+', '-', 'g'), '-') AS base FROM names),
    taken AS (
      SELECT slug AS base, 0 AS suffix FROM st
      UNION SELECT regexp_extract(slug, '^(.*)-([1-9][0-9]*)$', 1), CAST(regexp_extract(slug, '^(.*)-([1-9][0-9]*)$', 2) AS INTEGER)
            FROM st WHERE regexp_matches(slug, '^(.*)-([1-9][0-9]*)$')
      UNION SELECT regexp_extract(base, '^(.*)-([1-9][0-9]*)$', 1), CAST(regexp_extract(base, '^(.*)-([1-9][0-9]*)$', 2) AS INTEGER)
            FROM b WHERE regexp_matches(base, '^(.*)-([1-9][0-9]*)$')),
    sized AS (SELECT base, count(*) AS n FROM b GROUP BY 1),
    cand AS (SELECT base, unnest(range(0, CAST(n + (SELECT count(*) FROM taken t WHERE t.base = sized.base) AS BIGINT))) AS suffix FROM sized),
    free AS (SELECT base, suffix, row_number() OVER (PARTITION BY base ORDER BY suffix) AS rn FROM cand
             WHERE NOT EXISTS (SELECT 1 FROM taken t WHERE t.base = cand.base AND t.suffix = cand.suffix)),
    num AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY md5(common_name), common_name) AS rn FROM b),
    slugged AS (SELECT common_name, base || CASE WHEN suffix > 0 THEN '-' || suffix ELSE '' END AS slug FROM num JOIN free USING (base, rn))
"""


@query("unique_slugs", _SLUG_SQL.replace("FILTERED", "") + " SELECT * FROM slugged")
def unique_slugs(t: Tables) -> DataFrame:
    return dims.unique_slugs(_wanted(t), _stored_companies(t))


@query("get_or_create_company", _SLUG_SQL.replace(
    "FILTERED", f"WHERE c_mktsegment <> 'MACHINERY' AND {NAME_SQL} NOT IN "
                "(SELECT 'HOUSEHOLD ' || split_part(slug, '-', 2) FROM st)") + """
    SELECT (SELECT max(id) FROM st) + row_number() OVER (ORDER BY md5(common_name), common_name) AS id, slug, common_name,
           CASE WHEN starts_with(common_name, 'BUILDING') THEN 2 ELSE 1 END AS company_type, true AS approved,
           'https://x.example.com/' || first_key AS website, 'https://b.example.com/' || -first_key AS jobboard
    FROM slugged JOIN (SELECT NAME AS common_name, min(c_custkey) AS first_key FROM customer GROUP BY 1) USING (common_name)
""".replace("NAME AS", NAME_SQL + " AS"))
def get_or_create_company(t: Tables) -> DataFrame:
    types = t.spark.createDataFrame([(1, "Private Company"), (2, "Startup")], "id int, name string")
    made, _ = dims.get_or_create_companies(_stored_companies(t), _wanted(t), types, AS_OF, order=["pos"])
    return made.select("id", "slug", "common_name", "company_type", "approved", "website", "jobboard")


@query("rejected_companies", f"""
    SELECT DISTINCT {NAME_SQL} AS common_name, 'unknown_company_type' AS reason FROM customer WHERE c_mktsegment = 'MACHINERY'
""")
def rejected_companies(t: Tables) -> DataFrame:
    types = t.spark.createDataFrame([(1, "Private Company"), (2, "Startup")], "id int, name string")
    _, bad = dims.checked_companies(_stored_companies(t), _wanted(t), types)
    return bad.select("common_name", "reason")


@query("update_company", """
    SELECT c_custkey AS id, coalesce(s_name, c_name) AS website, s_suppkey IS NOT NULL AS changed
    FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey
""")
def update_company(t: Tables) -> DataFrame:
    companies = t("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("website"), F.lit(None).cast("timestamp_ntz").alias("updated_at"))
    patch = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("website"))
    patch = patch.withColumn("pos", F.lit(1)).unionByName(patch.select("id", F.lit("later").alias("website"), F.lit(2).alias("pos")))
    return dims.update_company(companies, patch, "website", AS_OF, order=["pos"]).select("id", "website", "changed")


@query("stamp_completion", f"""
    WITH {SQL_COMPANIES}
    SELECT id, strftime(CASE WHEN id IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F') THEN TIMESTAMP '2002-01-01 12:00:00'
                             ELSE last_full_scrape_completed END, '%Y-%m-%d %H:%M:%S') AS completed
    FROM companies
""")
def stamp_completion(t: Tables) -> DataFrame:
    out = dims.stamp_completion(t.companies(), t.incoming(), AS_OF)
    return out.select("id", second_text("last_full_scrape_completed").alias("completed"))


@query("delete_pending", f"""
    WITH {SQL_LISTINGS}
    SELECT 'stays' AS part, count(*) AS n FROM listings WHERE approved
    UNION ALL SELECT 'goes', count(*) FROM listings WHERE NOT approved
    UNION ALL SELECT 'one company', count(*) FROM listings WHERE NOT approved AND company_id = 1
    UNION ALL SELECT 'one source', count(*) FROM listings WHERE job_title = 'Job 5-LOW'
""")
def delete_pending(t: Tables) -> DataFrame:
    listings = t.listings().withColumn("source_job_board", F.col("job_title"))
    stays, goes = Del.delete_pending(listings)
    _, mine = Del.delete_pending(listings, 1)
    _, source = Del.delete_source(listings, "Job 5-LOW")
    parts = [("stays", stays), ("goes", goes), ("one company", mine), ("one source", source)]
    out = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("part"), "n") for name, df in parts]
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


@query("delete_cascade", """
    SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
""")
def delete_cascade(t: Tables) -> DataFrame:
    gone = t("orders").where(F.col("o_orderstatus") == "P")
    stays, _ = Del.cascade(t("lineitem"), gone, "l_orderkey", "o_orderkey")
    return stays.select("l_orderkey", "l_linenumber", "l_partkey")


@query("delete_set_null", """
    SELECT o_orderkey, CASE WHEN c_custkey IS NULL THEN o_custkey END AS posted_by FROM orders
    LEFT JOIN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) ON c_custkey = o_custkey
""")
def delete_set_null(t: Tables) -> DataFrame:
    gone = t("customer").where(F.col("c_acctbal") < 0)
    rows = t("orders").select("o_orderkey", F.col("o_custkey").alias("posted_by"))
    return Del.set_null(rows, gone, "posted_by", "c_custkey").select("o_orderkey", "posted_by")


@query("new_listing_rows", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'draft' ELSE 'active' END AS job_status,
           false AS approved, 'external_url' AS application_method,
           CASE WHEN o_orderstatus = 'O' THEN o_orderpriority END AS posting_id
    FROM orders
""")
def new_listing_rows(t: Tables) -> DataFrame:
    rows = t("orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "F", "draft").when(F.col("o_orderstatus") == "O", "").alias("job_status"),
        F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).otherwise("").alias("posting_id"))
    return with_defaults(rows).select("o_orderkey", "job_status", "approved", "application_method", "posting_id")


def _feed(t: Tables) -> DataFrame:
    bad = F.col("o_totalprice") < 2000
    title = F.when(bad, " ").otherwise(F.concat(F.lit("Job "), "o_orderpriority"))
    return t("orders").where(F.col("o_orderstatus") != "F").select(
        F.col("o_custkey").alias("company_id"), title.alias("job_title"),
        F.concat(F.lit("https://jobs.example.com/"), "o_custkey", F.lit("/job/"), "o_orderkey").alias("posting_url"),
        F.lit("board").alias("source_job_board"))


@query("full_cycle", f"""
    WITH {SQL_STORED}, feed AS (SELECT o_custkey AS company_id, o_totalprice < 2000 AS bad,
        'https://jobs.example.com/' || o_custkey || '/job/' || o_orderkey AS posting_url FROM orders WHERE o_orderstatus <> 'F'),
    f AS (SELECT *, posting_url IN (SELECT posting_url FROM stored) AS known FROM feed)
    SELECT company_id, count(*) AS jobs_found, count(*) FILTER (WHERE NOT known AND NOT bad) AS jobs_added,
           count(*) FILTER (WHERE known) AS jobs_updated, count(*) FILTER (WHERE NOT known AND bad) AS jobs_skipped,
           CASE WHEN count(*) FILTER (WHERE NOT known AND bad) > 0
                THEN 'job_title_not_blank:' || count(*) FILTER (WHERE NOT known AND bad) ELSE '' END AS errors, 3600 AS duration
    FROM f GROUP BY 1
""")
def full_cycle(t: Tables) -> DataFrame:
    cycle = run_cycle(t.stored(), _feed(t), t.companies(), AS_OF, started="2002-01-01 11:00:00")
    entries = F.transform(F.map_entries("errors"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return cycle.run_log.select(
        "company_id", "jobs_found", "jobs_added", "jobs_updated", "jobs_skipped",
        F.array_join(entries, ",").alias("errors"), F.col("duration_seconds").cast("int").alias("duration"))


_CYCLE_STATE = _STAGED.replace(
    SQL_INCOMING, SQL_INCOMING.replace("SELECT o_custkey AS company_id,", "SELECT o_custkey AS company_id, o_totalprice < 2000 AS bad, o_orderpriority,")
).replace("AS id,\n             company_id, posting_url FROM incoming WHERE", "AS id,\n             company_id, posting_url, o_orderpriority FROM incoming WHERE NOT bad AND")


def _committed(t: Tables, announced: DataFrame | None = None) -> str:
    """A cycle written as the first version of its tables; the folder they are in."""
    root = scratch_path(t.spark, "cycle")
    commit_cycle(t.spark, root, run_cycle(t.stored(), _feed(t), t.companies(), AS_OF, announced=announced))
    return root


@query("cycle_state", f"{_CYCLE_STATE} SELECT id, company_id, posting_url, job_status, updated_at, date_closed FROM staged")
def cycle_state(t: Tables) -> DataFrame:
    state = read_whole(t.spark, _committed(t), "state")
    return state.select(
        "id", "company_id", "posting_url", "job_status", second_text("updated_at").alias("updated_at"), day_text("date_closed").alias("date_closed"))


@query("cycle_state_in_place", f"{_CYCLE_STATE} SELECT id, company_id, posting_url, job_status, updated_at, date_closed FROM staged")
def cycle_state_in_place(t: Tables) -> DataFrame:
    root, layout = scratch_path(t.spark, "in-place"), Layout(f"state_{uuid.uuid4().hex}", parts=8, buckets=4)
    commit_parts(t.spark, root, layout, t.stored())
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in t.stored().schema.fields)
    state = read_state(t.spark, root, layout, columns)
    commit_in_place(t.spark, root, layout, run_cycle(state, _feed(t), t.companies(), AS_OF, in_place=layout.buckets))
    return read_state(t.spark, root, layout, columns).select(
        "id", "company_id", "posting_url", "job_status", second_text("updated_at").alias("updated_at"), day_text("date_closed").alias("date_closed"))


@query("cycle_content", f"{_CYCLE_STATE} SELECT id, company_id, posting_url, 'Job ' || o_orderpriority AS job_title FROM fresh")
def cycle_content(t: Tables) -> DataFrame:
    return read_appended(t.spark, _committed(t), "content").select("id", "company_id", "posting_url", "job_title")


@query("cycle_companies", f"""
    WITH {SQL_COMPANIES}
    SELECT id, strftime(CASE WHEN id % 5 <> 0 AND id IN (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F') THEN TIMESTAMP '2002-01-01 12:00:00'
                             ELSE last_full_scrape_completed END, '%Y-%m-%d %H:%M:%S') AS completed
    FROM companies
""")
def cycle_companies(t: Tables) -> DataFrame:
    # every fifth company announces one more than landed
    more = F.when(F.col("company_id") % 5 == 0, 1).otherwise(0)
    announced = t.incoming().groupBy("company_id").agg(F.count(F.lit(1)).alias("n")).select("company_id", (F.col("n") + more).alias("total"))
    companies = read_whole(t.spark, _committed(t, announced), "companies")
    return companies.select("id", second_text("last_full_scrape_completed").alias("completed"))
