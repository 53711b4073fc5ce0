"""Cities, addresses, board addresses and ids over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vacancia.catalog.registry import Tables, pick, query, sql_pick
from vacancia.functions import places as P
from vacancia.operators.dedup import keep_first
from vacancia.operators.resolve import first_labels_of, match_dictionary
from vacancia.plans.audit import facet_counts, in_scope, with_facet

PLACE_TEXTS = [
    "SAND SPRINGS, OK", "Dallas", "Remote - USA", "3 Locations", "USA - Oklahoma - Tulsa", "Remote Tulsa", "",
    "Tulsa or Broken Arrow", None,
]
PLACE_CITY = ["Sand Springs", None, None, None, "Tulsa", "Tulsa", None, "Broken Arrow", None]
PLACE_REASON = ["served", "rejected", "remote", "multi", "served", "served", "rejected", "served", "rejected"]


def key() -> F.Column:
    return F.col("c_custkey")


@query("served_city", f"""
    SELECT c_custkey, {sql_pick(PLACE_CITY, 'c_custkey')} AS city,
           {sql_pick(PLACE_CITY, 'c_custkey')} IS NOT NULL AS served,
           {sql_pick(PLACE_REASON, 'c_custkey')} AS reason
    FROM customer
""")
def served_city(t: Tables) -> DataFrame:
    text = pick(PLACE_TEXTS, key())
    return t("customer").select(
        "c_custkey", P.served_city(text).alias("city"), P.mentions_city(text).alias("served"),
        P.acceptance(text).alias("reason"),
    )


@query("served_city_filter", f"""
    SELECT c_custkey, {sql_pick(PLACE_CITY, 'c_custkey')} AS city FROM customer
    WHERE {sql_pick(PLACE_CITY, 'c_custkey')} IS NOT NULL
""")
def served_city_filter(t: Tables) -> DataFrame:
    out = t("customer").select("c_custkey", P.served_city(pick(PLACE_TEXTS, key())).alias("city"))
    return out.where(F.col("city").isNotNull())


@query("served_three_way", f"""
    SELECT {sql_pick(PLACE_REASON, 'c_custkey')} AS reason, count(*) AS n FROM customer
    WHERE {sql_pick(PLACE_REASON, 'c_custkey')} <> 'rejected' GROUP BY 1
""")
def served_three_way(t: Tables) -> DataFrame:
    out = t("customer").select(P.acceptance(pick(PLACE_TEXTS, key())).alias("reason"))
    return out.where(F.col("reason") != "rejected").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("served_city_of_array", f"""
    SELECT c_custkey, coalesce({sql_pick(PLACE_CITY, 'c_custkey')}, {sql_pick(PLACE_CITY, 'c_custkey + 4')},
                               {sql_pick(PLACE_CITY, 'c_nationkey')}) AS city
    FROM customer
""")
def served_city_of_array(t: Tables) -> DataFrame:
    texts = F.array(pick(PLACE_TEXTS, key()), pick(PLACE_TEXTS, key() + 4), pick(PLACE_TEXTS, F.col("c_nationkey")))
    return t("customer").select("c_custkey", P.served_city_of(texts).alias("city"))


_PLACE = "SELECT c_custkey, 'Plant ' || c_mktsegment || ' / ' || n_name || ', next to ' || 'NATION_' || (c_custkey % 7) AS place FROM customer JOIN nation ON n_nationkey = c_nationkey"
_DICTIONARY_SQL = f"""
    WITH p AS ({_PLACE}),
    m AS (SELECT c_custkey, n_name, row_number() OVER (PARTITION BY c_custkey ORDER BY length(n_name) DESC, n_name) AS rn
          FROM p JOIN nation ON contains(lower(place), lower(n_name)))
    SELECT c_custkey, n_name AS city FROM m WHERE rn = 1
"""


def _places(t: Tables) -> DataFrame:
    nation = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    place = F.concat(F.lit("Plant "), "c_mktsegment", F.lit(" / "), "n_name", F.lit(", next to "),
                     F.lit("NATION_"), (key() % 7).cast("string"))
    return t("customer").join(nation, "c_nationkey").select("c_custkey", place.alias("place"))


@query("dictionary_match", _DICTIONARY_SQL)
def dictionary_match(t: Tables) -> DataFrame:
    out = match_dictionary(_places(t), "place", t("nation"), ["c_custkey"], "city", name="n_name")
    return out.select("c_custkey", "city")


@query("dictionary_match_by_join", _DICTIONARY_SQL)
def dictionary_match_by_join(t: Tables) -> DataFrame:
    # the dictionary also holds every name twice over, which no text has
    words = t("nation").select(F.col("n_name").alias("name")).unionByName(t("nation").select(F.concat("n_name", "n_name").alias("name")))
    return match_dictionary(_places(t), "place", words, ["c_custkey"], "city").select("c_custkey", "city")


@query("address_parts", """
    SELECT s_suppkey,
           CASE s_suppkey % 5 WHEN 0 THEN 'NATION_' || s_nationkey WHEN 1 THEN 'NATION_' || s_nationkey
                              WHEN 2 THEN 'NATION_' || s_nationkey END AS city,
           CASE s_suppkey % 5 WHEN 0 THEN s_suppkey || ' E 11th St' WHEN 1 THEN s_suppkey || ' East Avenue'
                              WHEN 2 THEN 'NATION_' || s_nationkey WHEN 3 THEN 'somewhere' END AS street
    FROM supplier
""")
def address_parts(t: Tables) -> DataFrame:
    number = F.col("s_suppkey").cast("string")
    town = F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string"))
    address = F.element_at(F.array(
        F.concat(number, F.lit(" E 11th St, "), town, F.lit(", OK 74104, USA")),
        F.concat(number, F.lit(" East Avenue, "), town, F.lit(", ok, 74115, US")),
        F.concat(town, F.lit(", OK, US")), F.lit("somewhere"), F.lit(" , TX"),
    ), (F.col("s_suppkey") % 5 + 1).cast("int"))
    return t("supplier").select(
        "s_suppkey", P.address_city(address, F.lit("OK")).alias("city"), P.street(address).alias("street"))


@query("location_segments", """
    SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN 'NATION_' || c_nationkey WHEN 1 THEN 'Tulsa' ELSE '' END AS last_part,
           CASE c_custkey % 3 WHEN 0 THEN 'USA - ' || c_mktsegment || ' - NATION_' || c_nationkey
                              WHEN 1 THEN 'Tulsa' ELSE '' END AS first_part,
           CASE WHEN c_custkey % 3 < 2 THEN c_mktsegment END AS line
    FROM customer
""")
def location_segments(t: Tables) -> DataFrame:
    text = F.element_at(F.array(
        F.concat(F.lit("USA - "), "c_mktsegment", F.lit(" - NATION_"), F.col("c_nationkey").cast("string")),
        F.lit("Tulsa"), F.lit(""),
    ), (key() % 3 + 1).cast("int"))
    page = F.when(key() % 3 < 2, F.concat(F.lit("Job\nLocation : "), "c_mktsegment", F.lit(" <br>\nmore")))
    return t("customer").select(
        "c_custkey", P.last_segment(text).alias("last_part"),
        P.first_segment(F.concat(text, F.lit(", OK, US"))).alias("first_part"), P.location_line(page).alias("line"))


@query("url_facets", r"""
    SELECT page_id, CASE WHEN contains(url, 'ref=x') THEN 'x' END AS ref,
           nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
           CASE WHEN contains(url, 'utm_source=feed') THEN 'feed|a b' END AS sources
    FROM pages
""")
def url_facets(t: Tables) -> DataFrame:
    more = F.when(F.contains("url", F.lit("utm_source")), F.concat("url", F.lit("&utm_source=a+b&utm_source="))).otherwise(F.col("url"))
    out = t("pages").select("page_id", P.facets(more, ("page", "ref", "utm_source", "locations")).alias("f"))
    return out.select(
        "page_id", F.get(F.try_element_at("f", F.lit("ref")), 0).alias("ref"),
        F.get(F.try_element_at("f", F.lit("page")), 0).alias("page"),
        F.array_join(F.try_element_at("f", F.lit("utm_source")), "|").alias("sources"),
    )


@query("board_addresses", r"""
    WITH u AS (SELECT page_id, url, regexp_extract(url, '^(https?)://([^/?#]+)([^?#]*)', 1) AS scheme,
                      regexp_extract(url, '^(https?)://([^/?#]+)([^?#]*)', 2) AS host,
                      regexp_extract(url, '^(https?)://([^/?#]+)([^?#]*)', 3) AS path FROM pages),
    b AS (SELECT *, coalesce(list_filter(string_split(path, '/'), lambda x: x <> '' AND lower(x) <> 'en-us')[-1], 'External') AS board FROM u)
    SELECT page_id, scheme || '://' || host AS origin, string_split(host, '.')[1] AS tenant, board,
           scheme || '://' || host || '/wday/cxs/' || string_split(host, '.')[1] || '/' || board || '/jobs' AS endpoint,
           scheme || '://' || host || '/' || board AS base
    FROM b
""")
def board_addresses(t: Tables) -> DataFrame:
    return t("pages").select("page_id", P.board_parts("url").alias("b")).select("page_id", "b.*")


@query("source_scope", """
    SELECT page_id, CASE WHEN contains(url, 'utm_source') THEN 'facet' WHEN contains(url, 'page=2') THEN 'search' ELSE 'error' END AS mode,
           CASE WHEN contains(url, 'utm_source') THEN 'feed' WHEN contains(url, 'page=2') THEN '2' END AS value
    FROM pages
""")
def source_scope(t: Tables) -> DataFrame:
    url = F.replace(F.replace("url", F.lit("utm_source="), F.lit("hiringCompany=")), F.lit("page="), F.lit("q="))
    return t("pages").select("page_id", P.source_scope(url).alias("s")).select("page_id", "s.*")


@query("posting_urls", r"""
    SELECT page_id, CASE page_id % 3 WHEN 0 THEN url WHEN 1 THEN 'https://host.example.com/job/' || page_id
                                     ELSE 'https://host.example.com/job/' || page_id END AS absolute,
           CASE WHEN contains(url, '?') THEN url || '&in_iframe=1' ELSE url || '?in_iframe=1' END AS framed
    FROM pages
""")
def posting_urls(t: Tables) -> DataFrame:
    ident = F.col("page_id").cast("string")
    href = F.element_at(F.array(F.col("url"), F.concat(F.lit("/job/"), ident), F.concat(F.lit("job/"), ident)),
                        (F.col("page_id") % 3 + 1).cast("int"))
    once = P.with_query_flag("url", "in_iframe=1")
    return t("pages").select(
        "page_id", P.absolute_url(href, "https://host.example.com").alias("absolute"),
        P.with_query_flag(once, "in_iframe=1").alias("framed"))


@query("requisition_ids", """
    SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'R' || (100000 + p_partkey) END AS requisition,
           CASE WHEN p_partkey % 2 = 1 THEN CAST(p_partkey AS VARCHAR) END AS listing,
           CASE WHEN p_partkey % 2 = 0 THEN CAST(p_partkey AS VARCHAR) END AS detail
    FROM part
""")
def requisition_ids(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    text = F.when(k % 2 == 0, F.concat(F.lit(" R"), (k + 100000).cast("string"), F.lit(" "))).otherwise(
        F.concat(F.lit("Posting JOBID : "), k.cast("string")))
    url = F.concat(F.when(k % 2 == 0, "/Recruiting/Jobs/Details/").otherwise("/jobs/details/"), k.cast("string"), F.lit("?x"))
    return t("part").select(
        "p_partkey", P.requisition_id(text).alias("requisition"), P.listing_id(text).alias("listing"),
        P.detail_id(url).alias("detail"))


@query("position_lines", """
    SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_type END AS position FROM part
""")
def position_lines(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    text = F.when(k % 3 == 1, F.concat(F.lit("x Position Type: "), "p_type", F.lit(" Department: Shop Salary 3"))).when(
        k % 3 == 2, F.concat(F.lit("POSITION TYPE "), "p_type", F.lit("\nSalary"))).otherwise(F.lit("none"))
    return t("part").select("p_partkey", P.position_line(text).alias("position"))


@query("location_facets", """
    SELECT n_name AS location, count(*) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY 1
""")
def location_facets(t: Tables) -> DataFrame:
    nation = t("nation").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("location"))
    return facet_counts(t("customer").join(nation, "c_nationkey"), "location")


@query("facet_filter", """
    SELECT c_custkey, c_nationkey FROM customer
    WHERE c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 2))
""")
def facet_filter(t: Tables) -> DataFrame:
    wanted = t("nation").where(F.col("n_regionkey").isin(1, 2))
    return with_facet(t("customer"), "c_nationkey", wanted, "n_nationkey").select("c_custkey", "c_nationkey")


@query("scope_filter", """
    SELECT c_custkey FROM customer
    WHERE CASE c_nationkey % 3 WHEN 0 THEN c_mktsegment = 'BUILDING'
                               WHEN 1 THEN contains(lower(c_name), '#00000000') ELSE false END
""")
def scope_filter(t: Tables) -> DataFrame:
    board = pick(["https://b.example.com/x?hiringCompany=BUILDING&q=no", "https://b.example.com/x?q=%2300000000",
                  "https://b.example.com/x"], F.col("c_nationkey"))
    return in_scope(t("customer"), F.col("c_mktsegment"), P.source_scope(board), F.col("c_name")).select("c_custkey")


@query("first_labels", """
    SELECT user_id, event_type, CAST(k AS BIGINT) AS k FROM (
      SELECT user_id, event_type, json_extract_string(props, '$.k') AS k,
             row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS rn FROM events) WHERE rn = 1
""")
def first_labels(t: Tables) -> DataFrame:
    pairs = t("events").select("event_id", "user_id", "event_type", F.get_json_object("props", "$.k").alias("k"))
    out = first_labels_of(pairs, ["user_id"], "event_type", "k", "event_id")
    return out.select("user_id", "event_type", F.col("k").cast("bigint").alias("k"))


@query("first_seen_urls", r"""
    SELECT host, page_id FROM (
      SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, page_id,
             row_number() OVER (PARTITION BY regexp_extract(url, '^https?://([^/?#]+)', 1) ORDER BY page_id) AS rn
      FROM pages) WHERE rn = 1
""")
def first_seen_urls(t: Tables) -> DataFrame:
    hosts = t("pages").select(F.try_parse_url("url", F.lit("HOST")).alias("host"), "page_id")
    return keep_first(hosts, ["host"], ["page_id"])
