"""Deletes as anti-filters. Each returns (what stays, what goes)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vacancia.functions.text import blank_to_null


def _split(df: DataFrame, gone: Column) -> tuple[DataFrame, DataFrame]:
    gone = F.coalesce(gone, F.lit(False))
    return df.where(~gone), df.where(gone)


def delete_pending(listings: DataFrame, company_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    gone = ~F.col("approved")
    if company_id is not None:
        gone = gone & (F.col("company_id") == company_id)
    return _split(listings, gone)


def delete_source(listings: DataFrame, board: str) -> tuple[DataFrame, DataFrame]:
    return _split(listings, F.col("source_job_board") == board)


def delete_all(listings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Full reset: an empty table of the same columns; keys start again at 1."""
    return listings.limit(0), listings


def site_action(site_name: str = "site_name") -> Column:
    return F.when(blank_to_null(site_name).isNull(), F.lit("DELETE")).otherwise(F.lit("keep"))


def site_review(sites: DataFrame, cities: DataFrame, companies: DataFrame, company: str) -> DataFrame:
    """Sites of one company with their city and whether the name is blank; keepers first, by id."""
    mine = companies.where(F.col("common_name") == company).select(F.col("id").alias("company_id"))
    city = cities.select(F.col("id").alias("city_id"), "city_name")
    out = sites.join(mine, "company_id", "left_semi").join(city, "city_id", "left")
    return out.withColumn("action", site_action()).orderBy(F.col("action").desc(), "id")


def delete_blank_sites(sites: DataFrame, company_id: int | None = None) -> tuple[DataFrame, DataFrame]:
    gone = blank_to_null("site_name").isNull()
    if company_id is not None:
        gone = gone & (F.col("company_id") == company_id)
    return _split(sites, gone)


def cascade(children: DataFrame, gone: DataFrame, key: str, parent_key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Children of deleted parents go too."""
    ids = gone.select(F.col(parent_key).alias(key)).distinct()
    return children.join(ids, key, "left_anti"), children.join(ids, key, "left_semi")


def set_null(children: DataFrame, gone: DataFrame, key: str, parent_key: str = "id") -> DataFrame:
    """Children of deleted parents stay and lose the key."""
    ids = gone.select(F.col(parent_key).alias(key)).distinct().withColumn("_gone", F.lit(True))
    out = children.join(ids, key, "left")
    return out.withColumn(key, F.when(F.col("_gone").isNull(), F.col(key))).drop("_gone")
