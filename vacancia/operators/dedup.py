"""First, last and distinct postings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


ORDERED_IN = 64  # buckets in which the rows of one group are ordered first


def _pick(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    if not order:  # nothing tells the rows of a key apart
        return df.dropDuplicates(list(key))
    # a filter on row_number() = 1 is also applied before the shuffle, so one row per key
    # and map task moves, however often a key repeats
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_rn") == 1).drop("_rn")


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, key, [F.col(c).asc() for c in order])


def keep_last(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    return _pick(df, key, [F.col(c).desc() for c in order])


def first_of_key(df: DataFrame, key: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """One row per key for the right side of a join: the first in ``order``, columns for ordering left out.

    Without an order it is the least row by all other columns, which is the same at every run.
    """
    rest = [c for c in df.columns if c not in key and c not in order]
    return keep_first(df, key, [*order, *rest]).drop(*order)


def distinct_urls(df: DataFrame, url: str = "posting_url") -> DataFrame:
    return df.select(url).distinct()


def active_urls(listings: DataFrame) -> DataFrame:
    """(company_id, posting_url, id) of the active listings; of equal URLs the last row stays."""
    active = listings.where((F.col("job_status") == "active") & (F.coalesce("posting_url", F.lit("")) != ""))
    return active.groupBy("company_id", "posting_url").agg(F.max("id").alias("id"))


def hash_groups(df: DataFrame, hash_col: str, id_col: str) -> DataFrame:
    """First id and number of copies per content hash."""
    return df.groupBy(hash_col).agg(
        F.min(id_col).alias("first_id"), F.count(F.lit(1)).alias("copies")
    )


def top_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], cap: int) -> DataFrame:
    """At most ``cap`` rows of each group."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    return ranked.where(F.col("_rn") <= cap).drop("_rn")


def defer_new_rows(postings: DataFrame, known: Column, group: Sequence[str], order: Sequence[str],
                   cap: int | None = None) -> DataFrame:
    """All postings; ``deferred`` marks the new ones after the first ``cap`` of a company.

    A run that wants to fetch few pages takes the rows that are not deferred and finds the
    others again in its next run. There is no cap unless one is given. Known rows are not
    ordered at all. The new rows of a company are ordered inside buckets of the order columns;
    only the first ``cap`` of each bucket can be among the first of the company.
    """
    if cap is None:
        return postings.withColumn("deferred", F.lit(False))
    marked = postings.withColumn("_known", F.coalesce(known, F.lit(False)))
    new = marked.where(~F.col("_known")).withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(ORDERED_IN)))
    by = [F.col(c) for c in order]
    inside = new.withColumn("_place", F.row_number().over(Window.partitionBy(*group, "_bucket").orderBy(*by)))
    near = inside.where(F.col("_place") <= cap).withColumn("_place", F.row_number().over(Window.partitionBy(*group).orderBy(*by)))
    plain = postings.columns
    parts = [
        marked.where("_known").select(*plain, F.lit(False).alias("deferred")),
        inside.where(F.col("_place") > cap).select(*plain, F.lit(True).alias("deferred")),
        near.select(*plain, (F.col("_place") > cap).alias("deferred")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
