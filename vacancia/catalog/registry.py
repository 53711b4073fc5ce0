"""Registry of queries, and the job-board tables derived from the given ones."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from textwrap import dedent

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacancia.sources.tables import read_table

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale factor, and what is derived from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def __call__(self, name: str) -> DataFrame:
        # one read of a table's footer per query, however often the query names the table
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, self.folder, name)
        return self._frames[name]

    def listings(self) -> DataFrame:
        """Orders as listings, customers as their companies."""
        o = self("orders")
        status = F.when(F.col("o_orderstatus") == "O", "active").when(
            F.col("o_orderstatus") == "F", "closed").otherwise("draft")
        return o.select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("company_id"),
            posting_url().alias("posting_url"),
            F.concat(F.lit("Job "), "o_orderpriority").alias("job_title"),
            status.alias("job_status"),
            F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("approved"),
            F.col("o_orderdate").alias("created_at"), F.col("o_orderdate").alias("updated_at"),
            F.col("o_orderdate").alias("last_scraped"),
            F.when(F.col("o_orderstatus") == "F", F.to_date("o_orderdate")).alias("date_closed"),
            F.md5(posting_url()).alias("scraping_hash"),
        )

    def stored(self) -> DataFrame:
        """Listings of earlier cycles; a low priority is a closed posting."""
        closed = F.col("o_orderpriority") == "5-LOW"
        return self("orders").where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz")).select(
            F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("company_id"),
            posting_url().alias("posting_url"),
            F.when(closed, "closed").otherwise("active").alias("job_status"),
            F.lit(True).alias("approved"),
            F.when(closed, F.to_date("o_orderdate")).alias("date_closed"),
            F.col("o_orderdate").alias("last_scraped"), F.col("o_orderdate").alias("created_at"),
            F.col("o_orderdate").alias("updated_at"),
        )

    def incoming(self) -> DataFrame:
        """The current snapshot: every order that is not finished."""
        return self("orders").where(F.col("o_orderstatus") != "F").select(
            F.col("o_custkey").alias("company_id"), posting_url().alias("posting_url"),
            F.col("o_orderkey").alias("pos"),
        )

    def companies(self) -> DataFrame:
        """Customers as companies; a negative balance never completed a cycle."""
        done = F.when(F.col("c_acctbal") >= 0, F.lit("1998-06-01 00:00:00").cast("timestamp_ntz"))
        return self("customer").select(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("common_name"),
            (F.col("c_acctbal") > 0).alias("approved"), (F.col("c_acctbal") > 9000).alias("defunct"),
            F.col("c_mktsegment").alias("company_type"),
            done.alias("last_full_scrape_completed"),
        )


def posting_url() -> Column:
    return F.concat(F.lit("https://jobs.example.com/"), "o_custkey", F.lit("/job/"), "o_orderkey")


# The same derived tables for the SQL side.
SQL_URL = "'https://jobs.example.com/' || o_custkey || '/job/' || o_orderkey"
SQL_LISTINGS = f"""
listings AS (
  SELECT o_orderkey AS id, o_custkey AS company_id, {SQL_URL} AS posting_url,
         'Job ' || o_orderpriority AS job_title,
         CASE o_orderstatus WHEN 'O' THEN 'active' WHEN 'F' THEN 'closed' ELSE 'draft' END AS job_status,
         o_orderpriority IN ('1-URGENT', '2-HIGH') AS approved, o_orderdate AS created_at,
         CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS date_closed
  FROM orders)
"""
SQL_STORED = f"""
stored AS (
  SELECT o_orderkey AS id, o_custkey AS company_id, {SQL_URL} AS posting_url,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'closed' ELSE 'active' END AS job_status,
         CASE WHEN o_orderpriority = '5-LOW' THEN CAST(o_orderdate AS DATE) END AS date_closed,
         o_orderdate AS updated_at
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
"""
SQL_INCOMING = f"""
incoming AS (
  SELECT o_custkey AS company_id, {SQL_URL} AS posting_url FROM orders WHERE o_orderstatus <> 'F')
"""
SQL_COMPANIES = """
companies AS (
  SELECT c_custkey AS id, c_name AS common_name, c_acctbal > 0 AS approved, c_acctbal > 9000 AS defunct,
         c_mktsegment AS company_type,
         CASE WHEN c_acctbal >= 0 THEN TIMESTAMP '1998-06-01' END AS last_full_scrape_completed
  FROM customer)
"""


def pick(values: Sequence[str | None], index: Column) -> Column:
    """One of several texts by a number from the row."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(index, F.lit(len(values))) + 1).cast("int"))


def sql_pick(values: Sequence, index: str) -> str:
    def lit(v) -> str:
        if v is None:
            return "NULL"
        return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)

    return f"([{', '.join(lit(v) for v in values)}])[({index}) % {len(values)} + 1]"


def day_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def second_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def as_double(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def query(name: str, sql: str | None = None):
    """Register a function of Tables as a query, with its SQL when there is one."""

    def register(fn: Callable[[Tables], DataFrame]):
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            _ORACLES[name] = dedent(sql).strip()
        return fn

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    return dict(_ORACLES)
