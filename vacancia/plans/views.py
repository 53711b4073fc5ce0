"""The serving views as functions over DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F



def _dim(df: DataFrame, id_col: str, name_col: str, key: str, out: str) -> DataFrame:
    return df.select(F.col(id_col).alias(key), F.col(name_col).alias(out))


def is_public(status: str = "job_status") -> Column:
    return F.col("approved") & (F.col(status) == "active")


def job_counts(listings: DataFrame) -> DataFrame:
    """(company_id, active_jobs, total_jobs): active means approved and of status active."""
    return listings.groupBy("company_id").agg(
        F.count_if(is_public()).alias("active_jobs"), F.count(F.lit(1)).alias("total_jobs")
    )


def company_profile(company: DataFrame, listings: DataFrame, company_type: DataFrame,
                    company_industries: DataFrame, industries: DataFrame,
                    company_functions: DataFrame, functions: DataFrame,
                    sites: DataFrame, cities: DataFrame, states: DataFrame, countries: DataFrame) -> DataFrame:
    """Approved companies, one row per combination of industry, function and headquarters.

    Listings are counted per company before the join, so the wide side never meets them.
    """
    head = sites.where(F.col("is_headquarters")).select("company_id", "city_id", "state_id", "country_id")
    head = (
        head.join(_dim(cities, "id", "city_name", "city_id", "hq_city"), "city_id", "left")
        .join(_dim(states, "id", "name", "state_id", "hq_state"), "state_id", "left")
        .join(_dim(countries, "id", "name", "country_id", "hq_country"), "country_id", "left")
        .select("company_id", "hq_city", "hq_state", "hq_country")
    )
    industry = company_industries.join(
        _dim(industries, "id", "name", "industry_id", "primary_industry"), "industry_id", "left"
    ).select("company_id", "primary_industry")
    function = company_functions.join(
        _dim(functions, "id", "name", "function_id", "primary_function"), "function_id", "left"
    ).select("company_id", "primary_function")
    out = (
        company.where(F.col("approved")).withColumnRenamed("id", "company_id")
        .join(_dim(company_type, "id", "name", "company_type", "company_type_name"), "company_type", "left")
        .join(job_counts(listings), "company_id", "left")
        .join(industry, "company_id", "left")
        .join(function, "company_id", "left")
        .join(head, "company_id", "left")
    )
    zero = F.lit(0).cast("bigint")
    return out.select(
        F.col("company_id").alias("id"), F.col("common_name").alias("company_name"),
        *[c for c in ("legal_name", "website", "jobboard") if c in company.columns],
        F.col("company_type_name").alias("company_type"),
        *[F.col("date_founded").alias("founded_date")] * ("date_founded" in company.columns),
        "primary_industry", "primary_function", "hq_city", "hq_state", "hq_country",
        *[c for c in ("is_scraped",) if c in company.columns],
        F.coalesce("active_jobs", zero).alias("active_jobs"),
        F.coalesce("total_jobs", zero).alias("total_jobs"),
        *[c for c in ("created_at", "updated_at") if c in company.columns],
    )


def pending_companies(company: DataFrame, roles: DataFrame, users: DataFrame) -> DataFrame:
    """Companies to approve with the admin who sent them in, oldest first."""
    admins = roles.where(F.col("role") == "company_admin").select(F.col("company_id").alias("id"), "user_id")
    people = users.select(
        F.col("id").alias("user_id"), F.col("email").alias("submitted_by_email"),
        F.col("full_name").alias("submitted_by_name"),
    )
    out = company.where(~F.col("approved")).join(admins, "id", "left").join(people, "user_id", "left")
    return out.drop("user_id").orderBy("created_at", "id")


def pending_listings(listings: DataFrame, company: DataFrame, users: DataFrame) -> DataFrame:
    """Postings to approve with company and poster, oldest first."""
    people = users.select(F.col("id").alias("posted_by"), F.col("email").alias("posted_by_email"))
    waiting = listings.where(~F.col("approved")).select(
        "id", "company_id", "posted_by", "job_title", "created_at", "application_method"
    )
    out = (
        waiting.join(_dim(company, "id", "common_name", "company_id", "company_name"), "company_id")
        .join(people, "posted_by", "left")
    )
    return out.select(
        "id", "job_title", "created_at", "company_name", "posted_by_email", "application_method"
    ).orderBy("created_at", "id")


def pending_roles(roles: DataFrame, users: DataFrame, company: DataFrame) -> DataFrame:
    """Roles to approve with user and company, oldest first."""
    people = users.select(
        F.col("id").alias("user_id"), F.col("email").alias("user_email"), F.col("full_name").alias("user_name")
    )
    out = (
        roles.where(~F.col("approved"))
        .join(people, "user_id")
        .join(_dim(company, "id", "common_name", "company_id", "company_name"), "company_id")
    )
    return out.select("id", "role", "created_at", "user_email", "user_name", "company_name").orderBy("created_at", "id")


def skill_demand(skills: DataFrame, categories: DataFrame, listing_skills: DataFrame,
                 listings: DataFrame | None = None) -> DataFrame:
    """Listings per skill, those that require it and those that prefer it, most wanted first.

    Without ``listings`` every link counts, inactive listings included. With it only links
    of approved active listings do. Links are counted per skill before the skill is joined.
    """
    links = listing_skills.select("job_listing_id", "skill_id", "required_skill", "preferred_skill")
    if listings is not None:
        live = listings.where(is_public()).select(F.col("id").alias("job_listing_id"))
        links = links.join(live, "job_listing_id", "left_semi")
    counted = links.groupBy("skill_id").agg(
        F.count("job_listing_id").alias("listing_count"),
        F.count_if("required_skill").alias("required_count"),
        F.count_if("preferred_skill").alias("preferred_count"),
    )
    base = skills.select(F.col("id").alias("skill_id"), F.col("name").alias("skill_name"), "skill_category_id")
    out = (
        base.join(_dim(categories, "id", "name", "skill_category_id", "category"), "skill_category_id", "left")
        .join(counted, "skill_id", "left")
    )
    counts = ("listing_count", "required_count", "preferred_count")
    return out.select(
        "skill_id", "skill_name", "category",
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in counts],
    ).orderBy(F.col("listing_count").desc(), "skill_id")


def public_listings(listings: DataFrame, company: DataFrame) -> DataFrame:
    """Approved active postings of approved companies that still exist."""
    shown = company.where(F.col("approved") & ~F.col("defunct")).select(F.col("id").alias("company_id"))
    return listings.where(is_public()).join(shown, "company_id", "left_semi")


def most_recent(df: DataFrame, by: str, n: int, tie: str = "id") -> DataFrame:
    return df.orderBy(F.col(by).desc(), F.col(tie).desc()).limit(n)


def last_completed(runs: DataFrame) -> DataFrame:
    """Last completed cycle per company."""
    return runs.groupBy("company_id").agg(F.max("completed_at").alias("last_completed"))


def run_stats(outcomes: DataFrame, key: Sequence[str] = ("job_board", "company_id"),
              weight: str | None = None) -> DataFrame:
    """One run-log row per key from outcome rows (key..., outcome, reason, weight).

    Outcomes are ``added``, ``updated`` and ``skipped``. Errors are counted per reason first;
    reasons come from a fixed vocabulary, so the map of a run stays small.
    """
    key = list(key)
    counted = F.count(F.lit(1)) if weight is None else F.sum(weight)
    partial = outcomes.groupBy(*key, "outcome", "reason").agg(counted.alias("n"))
    is_error = F.col("reason").isNotNull()

    def total(outcome: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("outcome") == outcome, F.col("n"))), F.lit(0)).cast("bigint")

    entry = F.when(is_error & (F.col("outcome") == "skipped"), F.struct("reason", "n"))
    return partial.groupBy(*key).agg(
        F.sum("n").cast("bigint").alias("jobs_found"), total("added").alias("jobs_added"),
        total("updated").alias("jobs_updated"), total("skipped").alias("jobs_skipped"),
        F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("errors"),
    )


def with_duration(runs: DataFrame) -> DataFrame:
    """``duration_seconds`` of the finished runs."""
    seconds = F.unix_seconds(F.col("completed_at").cast("timestamp")) - F.unix_seconds(
        F.col("started_at").cast("timestamp"))
    return runs.withColumn("duration_seconds", F.when(F.col("completed_at").isNotNull(), seconds))


def first_examples(df: DataFrame, order: Sequence[str], n: int = 10) -> DataFrame:
    """The first rows as examples, with how many more there are."""
    more = df.agg(F.greatest(F.count(F.lit(1)) - n, F.lit(0)).alias("more"))
    return df.orderBy(*order).limit(n).withColumn("more", more.scalar())
