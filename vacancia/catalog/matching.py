"""Lookups, matches and duplicate handling over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vacancia.catalog.registry import (
    SQL_INCOMING, SQL_LISTINGS, SQL_STORED, Tables, pick, posting_url, query, sql_pick,
)
from vacancia.operators import dedup, resolve as R
from vacancia.operators.numbering import with_new_ids
from vacancia.operators.dims import get_or_create_sites
from vacancia.plans.audit import served_and_known

NAMES = ["Full-time", "Part-time", "Seasonal", "Contract"]
JOB_TYPES = [(1, "Full-time"), (2, "Part-time"), (3, "Contract")]


@query("dimension_lookup", f"""
    SELECT o_orderkey, {sql_pick(NAMES, 'o_orderkey')} AS job_type, {sql_pick([1, 2, None, 3], 'o_orderkey')} AS job_type_id
    FROM orders
""")
def dimension_lookup(t: Tables) -> DataFrame:
    dim = t.spark.createDataFrame(JOB_TYPES, "id int, name string")
    rows = t("orders").select("o_orderkey", pick(NAMES, F.col("o_orderkey")).alias("job_type"))
    return R.lookup_id(rows, dim, "job_type", "job_type_id").select("o_orderkey", "job_type", "job_type_id")


@query("city_lookup", """
    SELECT c_custkey, 'NATION_' || (c_custkey % 30) AS city_name, n_nationkey AS city_id
    FROM customer LEFT JOIN (SELECT nation.* FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'AMERICA')
         ON n_name = 'NATION_' || (c_custkey % 30)
""")
def city_lookup(t: Tables) -> DataFrame:
    cities = t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("city_name"), F.col("n_regionkey").alias("state_id"))
    states = t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    rows = t("customer").select("c_custkey", F.concat(F.lit("NATION_"), (F.col("c_custkey") % 30).cast("string")).alias("city_name"))
    return rows.join(R.city_ids(cities, states, "AMERICA"), "city_name", "left").select("c_custkey", "city_name", "city_id")


@query("location_required", """
    SELECT c_nationkey, count(*) FILTER (WHERE r_name = 'ASIA') AS kept, count(*) FILTER (WHERE r_name <> 'ASIA') AS skipped
    FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1
""")
def location_required(t: Tables) -> DataFrame:
    cities = t("nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("city_name"), F.col("n_regionkey").alias("state_id"))
    states = t("region").select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("name"))
    rows = t("customer").select("c_nationkey", F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")).alias("city_name"))
    known = rows.join(R.city_ids(cities, states, "ASIA"), "city_name", "left")
    return known.groupBy("c_nationkey").agg(
        F.count("city_id").alias("kept"), F.count_if(F.col("city_id").isNull()).alias("skipped"))


@query("url_match", f"""
    WITH {SQL_STORED}, {SQL_INCOMING}
    SELECT incoming.posting_url, stored.id AS existing_id FROM incoming LEFT JOIN stored USING (posting_url)
""")
def url_match(t: Tables) -> DataFrame:
    return R.match_by_url(t.incoming(), t.stored()).select("posting_url", "existing_id")


@query("active_url_match", f"""
    WITH {SQL_STORED}, {SQL_INCOMING}
    SELECT incoming.posting_url, incoming.company_id, stored.id AS existing_id FROM incoming
    LEFT JOIN stored ON stored.posting_url = incoming.posting_url AND stored.company_id = incoming.company_id AND job_status = 'active'
""")
def active_url_match(t: Tables) -> DataFrame:
    return R.match_by_url(t.incoming(), t.stored(), active_only=True).select("posting_url", "company_id", "existing_id")


@query("hash_match", """
    WITH old AS (SELECT md5(text) AS h, min(doc_id) AS existing_id FROM documents WHERE lang = 'en' GROUP BY 1)
    SELECT doc_id, existing_id FROM documents LEFT JOIN old ON h = md5(text)
""")
def hash_match(t: Tables) -> DataFrame:
    docs = t("documents").select("doc_id", "lang", F.md5("text").alias("scraping_hash"))
    old = docs.where(F.col("lang") == "en").withColumnRenamed("doc_id", "id")
    return R.match_by_hash(docs, old).select("doc_id", "existing_id")


@query("disjunctive_match", """
    WITH n AS (SELECT s_nationkey AS k, min(s_suppkey) AS i FROM supplier GROUP BY 1),
         x AS (SELECT right(s_name, 9) AS k, min(s_suppkey) AS i FROM supplier GROUP BY 1)
    SELECT c_custkey, least(n.i, x.i) AS existing_id FROM customer
    LEFT JOIN n ON n.k = c_nationkey LEFT JOIN x ON x.k = right(c_name, 9)
""")
def disjunctive_match(t: Tables) -> DataFrame:
    suffix = lambda c: F.substring(c, -9, 9)
    rows = t("customer").select("c_custkey", F.col("c_nationkey").alias("nation"), suffix("c_name").alias("suffix"))
    stored = t("supplier").select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), suffix("s_name").alias("suffix"))
    return R.match_either(rows, stored, ["nation"], ["suffix"]).select("c_custkey", "existing_id")


@query("new_postings", f"""
    WITH {SQL_STORED}, {SQL_INCOMING}
    SELECT posting_url, company_id FROM incoming WHERE posting_url NOT IN (SELECT posting_url FROM stored)
""")
def new_postings(t: Tables) -> DataFrame:
    return R.new_postings(t.incoming(), t.stored()).select("posting_url", "company_id")


@query("stale_postings", f"""
    WITH {SQL_STORED}, {SQL_INCOMING}
    SELECT id, posting_url FROM stored WHERE job_status <> 'closed' AND posting_url NOT IN (SELECT posting_url FROM incoming)
""")
def stale_postings(t: Tables) -> DataFrame:
    return R.not_seen(t.stored(), t.incoming()).select("id", "posting_url")


SITES_SQL = """
    sites AS (SELECT s_suppkey AS id, s_nationkey AS company_id,
                     CASE WHEN s_suppkey % 5 = 0 THEN '  ' ELSE upper('Site ' || (s_suppkey % 40)) END AS site_name,
                     (s_suppkey % 60) || ' Main St' AS address1,
                     CASE WHEN s_acctbal > 0 THEN s_suppkey % 9 END AS city_id FROM supplier)
"""


def sites(t: Tables) -> DataFrame:
    k = F.col("s_suppkey")
    return t("supplier").select(
        k.alias("id"), F.col("s_nationkey").cast("bigint").alias("company_id"),
        F.when(k % 5 == 0, "  ").otherwise(F.upper(F.concat(F.lit("Site "), (k % 40).cast("string")))).alias("site_name"),
        F.concat((k % 60).cast("string"), F.lit(" Main St")).alias("address1"),
        F.when(F.col("s_acctbal") > 0, k % 9).alias("city_id"),
    )


def located(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    return t("customer").select(
        "c_custkey", F.col("c_nationkey").cast("bigint").alias("company_id"),
        F.concat(F.lit(" site "), (k % 40).cast("string"), F.lit(" ")).alias("site_name"),
        F.concat((k % 60).cast("string"), F.lit(" MAIN st")).alias("address1"),
        F.when(F.col("c_acctbal") > 5000, k % 11).alias("city_id"),
    )


LOCATED_SQL = """
    located AS (SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS company_id, 'site ' || (c_custkey % 40) AS site_name,
                       (c_custkey % 60) || ' main st' AS address1,
                       CASE WHEN c_acctbal > 5000 THEN c_custkey % 11 END AS city_id FROM customer)
"""


@query("site_by_name", f"""
    WITH {SITES_SQL}, {LOCATED_SQL},
    one AS (SELECT company_id, lower(trim(site_name)) AS k, min(id) AS company_site_id FROM sites WHERE trim(site_name) <> '' GROUP BY 1, 2)
    SELECT c_custkey, company_site_id FROM located l LEFT JOIN one ON one.company_id = l.company_id AND k = site_name
""")
def site_by_name(t: Tables) -> DataFrame:
    return R.match_site(located(t), sites(t), "site_name", "site_name").select("c_custkey", "company_site_id")


@query("site_by_address", f"""
    WITH {SITES_SQL}, {LOCATED_SQL},
    one AS (SELECT company_id, lower(address1) AS k, min(id) AS company_site_id FROM sites GROUP BY 1, 2)
    SELECT c_custkey, company_site_id FROM located l LEFT JOIN one ON one.company_id = l.company_id AND k = address1
""")
def site_by_address(t: Tables) -> DataFrame:
    return R.match_site(located(t), sites(t), "address1", "address1").select("c_custkey", "company_site_id")


@query("city_from_site", f"""
    WITH {SITES_SQL}, {LOCATED_SQL},
    one AS (SELECT company_id, lower(trim(site_name)) AS k, min(id) AS company_site_id FROM sites WHERE trim(site_name) <> '' GROUP BY 1, 2)
    SELECT c_custkey, coalesce(l.city_id, sites.city_id) AS city_id FROM located l
    LEFT JOIN one ON one.company_id = l.company_id AND k = site_name LEFT JOIN sites ON sites.id = company_site_id
""")
def city_from_site(t: Tables) -> DataFrame:
    placed = R.match_site(located(t), sites(t), "site_name", "site_name")
    return R.city_from_site(placed, sites(t)).select("c_custkey", "city_id")


@query("get_or_create_site", f"""
    WITH {SITES_SQL}, {LOCATED_SQL},
    missing AS (SELECT company_id, site_name AS k, min(address1) AS address1 FROM located l
                WHERE NOT EXISTS (SELECT 1 FROM sites s WHERE s.company_id = l.company_id AND lower(trim(s.site_name)) = l.site_name)
                GROUP BY 1, 2)
    SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY md5(company_id || chr(31) || k), company_id, k) AS id,
           company_id, k AS site_name
    FROM missing
""")
def get_or_create_site(t: Tables) -> DataFrame:
    return get_or_create_sites(sites(t), located(t), "site_name").select("id", "company_id", "site_name")


@query("get_or_create_site_by_address", f"""
    WITH {SITES_SQL}, {LOCATED_SQL},
    missing AS (SELECT company_id, address1 AS k FROM located l
                WHERE NOT EXISTS (SELECT 1 FROM sites s WHERE s.company_id = l.company_id AND lower(s.address1) = l.address1)
                GROUP BY 1, 2)
    SELECT (SELECT max(s_suppkey) FROM supplier) + row_number() OVER (ORDER BY md5(company_id || chr(31) || k), company_id, k) AS id,
           company_id, k AS address1
    FROM missing
""")
def get_or_create_site_by_address(t: Tables) -> DataFrame:
    made = get_or_create_sites(sites(t), located(t), "address1")
    return made.select("id", "company_id", F.lower("address1").alias("address1"))


@query("feed_metadata_join", """
    WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey) AS rn
               FROM lineitem WHERE l_returnflag = 'R'),
    m AS (SELECT l_orderkey, l_shipdate AS shipped, CAST(l_partkey AS BIGINT) AS n FROM r WHERE rn = 1)
    SELECT o_orderkey, strftime(coalesce(shipped, o_orderdate), '%Y-%m-%d') AS date_posted, coalesce(n, 0) AS n
    FROM orders LEFT JOIN m ON l_orderkey = o_orderkey
""")
def feed_metadata_join(t: Tables) -> DataFrame:
    # an id has several entries; the first line counts
    meta = t("lineitem").where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("external_job_id"), "l_linenumber", F.col("l_shipdate").alias("shipped"), F.col("l_partkey").cast("bigint").alias("n"))
    rows = t("orders").select(F.col("o_orderkey").alias("external_job_id"), "o_orderdate")
    out = R.join_metadata(rows, meta, order=["l_linenumber"])
    return out.select(
        F.col("external_job_id").alias("o_orderkey"),
        F.date_format(F.coalesce("shipped", "o_orderdate"), "yyyy-MM-dd").alias("date_posted"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@query("company_type_join", """
    SELECT c_custkey, c_name, n_name AS company_type_name FROM customer JOIN nation ON n_nationkey = c_nationkey
    WHERE n_regionkey <> 0
""")
def company_type_join(t: Tables) -> DataFrame:
    types = t("nation").where(F.col("n_regionkey") != 0).select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    companies = t("customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("company_type"))
    return R.company_with_type(companies, types).select("c_custkey", "c_name", "company_type_name")


@query("keys_required", """
    SELECT o_custkey, count(*) FILTER (WHERE o_orderpriority <> '5-LOW') AS kept,
           count(*) FILTER (WHERE o_orderpriority = '5-LOW') AS dropped
    FROM orders GROUP BY 1
""")
def keys_required(t: Tables) -> DataFrame:
    url = F.when(F.col("o_orderpriority") != "5-LOW", posting_url()).otherwise("")
    rows = t("orders").select("o_custkey", url.alias("job_title"))
    valid, rejected = R.split_required(rows)
    marked = valid.select("o_custkey", F.lit(1).alias("ok")).unionByName(rejected.select("o_custkey", F.lit(0).alias("ok")))
    return marked.groupBy("o_custkey").agg(
        F.count_if(F.col("ok") == 1).alias("kept"), F.count_if(F.col("ok") == 0).alias("dropped"))


@query("required_fields", """
    SELECT doc_id, CASE WHEN lang IN ('en', 'de') THEN 'valid' ELSE 'missing_job_title' END AS reason FROM documents
""")
def required_fields(t: Tables) -> DataFrame:
    title = F.when(F.col("lang") == "en", "a").when(F.col("lang") == "de", "b").when(F.col("lang") == "fr", "")
    valid, rejected = R.split_required(t("documents").select("doc_id", title.alias("job_title")))
    return valid.select("doc_id", F.lit("valid").alias("reason")).unionByName(rejected.select("doc_id", "reason"))


@query("distinct_urls", r"SELECT DISTINCT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages")
def distinct_urls(t: Tables) -> DataFrame:
    return dedup.distinct_urls(t("pages").select(F.try_parse_url("url", F.lit("HOST")).alias("host")), "host")


@query("last_active_urls", f"""
    WITH {SQL_LISTINGS}
    SELECT company_id, 'u' || (company_id % 10) AS posting_url, max(id) AS id FROM listings WHERE job_status = 'active' GROUP BY 1, 2
""")
def last_active_urls(t: Tables) -> DataFrame:
    url = F.concat(F.lit("u"), (F.col("company_id") % 10).cast("string"))
    return dedup.active_urls(t.listings().withColumn("posting_url", url))


@query("last_seen_rows", """
    SELECT o_custkey, o_orderkey FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1
""")
def last_seen_rows(t: Tables) -> DataFrame:
    rows = t("orders").select("o_custkey", "o_orderkey", "o_orderdate")
    return dedup.keep_last(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("capped_new_rows", """
    SELECT o_orderkey, o_custkey, o_orderstatus <> 'F'
           AND row_number() OVER (PARTITION BY o_custkey, o_orderstatus = 'F' ORDER BY o_orderkey) > 5 AS deferred FROM orders
""")
def capped_new_rows(t: Tables) -> DataFrame:
    rows = t("orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    out = dedup.defer_new_rows(rows, F.col("o_orderstatus") == "F", ["o_custkey"], ["o_orderkey"], 5)
    return out.select("o_orderkey", "o_custkey", "deferred")


@query("surrogate_keys", f"""
    WITH {SQL_STORED}, {SQL_INCOMING},
    new AS (SELECT * FROM incoming WHERE posting_url NOT IN (SELECT posting_url FROM stored))
    SELECT posting_url, (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY md5(posting_url), posting_url) AS id FROM new
""")
def surrogate_keys(t: Tables) -> DataFrame:
    new = R.new_postings(t.incoming(), t.stored()).select("posting_url")
    return with_new_ids(new, ["posting_url"], t.stored())


@query("served_and_known", """
    SELECT n_name AS city_name FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'EUROPE'
    INTERSECT SELECT 'NATION_' || s_nationkey FROM supplier WHERE s_acctbal > 0
""")
def served_cities_known(t: Tables) -> DataFrame:
    region = t("region").where(F.col("r_name") != "EUROPE").select(F.col("r_regionkey").alias("n_regionkey"))
    cities = t("nation").join(region, "n_regionkey", "left_semi").select(F.col("n_name").alias("city_name"))
    served = t("supplier").where(F.col("s_acctbal") > 0).select(F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string")).alias("city_name"))
    return served_and_known(served, cities)


@query("either_path_union", f"""
    SELECT DISTINCT c_custkey, s_suppkey FROM customer JOIN supplier ON right(s_name, 9) = right(c_name, 9)
""")
def either_path_union(t: Tables) -> DataFrame:
    # the two paths of a match on one key or another, as a set of pairs
    c = t("customer").select("c_custkey", F.substring("c_name", -9, 9).alias("k"), F.col("c_custkey").alias("n"))
    s = t("supplier").select("s_suppkey", F.substring("s_name", -9, 9).alias("k"), F.col("s_suppkey").alias("n"))
    by_suffix = c.join(s.drop("n"), "k").select("c_custkey", "s_suppkey")
    by_number = c.drop("k").join(s.drop("k"), "n").select("c_custkey", "s_suppkey")
    return by_suffix.union(by_number).distinct()
