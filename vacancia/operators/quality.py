"""Table constraints as data-quality rules.

A rule is (name, column that is true when the row is good). As in SQL a NULL result
passes. All row rules of a table are evaluated in one pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacancia.functions.text import strip

Rule = tuple[str, Column]

# Allowed values.
ALLOWED = {
    "application_method": ("external_url", "email", "in_platform"),
    "pay_frequency": ("hourly", "daily", "weekly", "biweekly", "monthly", "annually"),
    "degree": ("required", "preferred", "not_mentioned"),
    "availability": ("required", "occasional", "not_mentioned"),
    "travel_requirements": ("none", "minimal", "moderate", "extensive", "constant", "not_mentioned"),
    "run_status": ("running", "completed", "failed", "cancelled"),
    "company_role": ("company_admin", "job_poster"),
    "proficiency": ("beginner", "intermediate", "advanced", "expert", "unknown"),
    "extraction_method": ("manual", "ai", "hybrid"),
    "application_status": ("submitted", "reviewing", "shortlisted", "rejected", "hired", "withdrawn"),
}


def not_blank(c: str) -> Rule:
    return f"{c}_not_blank", F.col(c).isNotNull() & (F.length(strip(c)) > 0)


def allowed(c: str, kind: str) -> Rule:
    return f"{c}_allowed", F.col(c).isin(*ALLOWED[kind])


def required_when(c: str, condition: Column, name: str) -> Rule:
    return name, ~condition | F.col(c).isNotNull()


def http_url(c: str) -> Rule:
    return f"{c}_http", F.col(c).rlike(r"(?i)^https?://")


def social_url(c: str) -> Rule:
    return f"{c}_http_no_blank", F.col(c).rlike(r"(?i)^https?://[^\s]+$")


def positive(c: str) -> Rule:
    return f"{c}_positive", F.col(c) > 0


def ordered(low: str, high: str, strict: bool = False) -> Rule:
    test = F.col(low) < F.col(high) if strict else F.col(low) <= F.col(high)
    return f"{low}_before_{high}", test


def between(c: str, low, high=None) -> Rule:
    test = F.col(c) >= low
    return f"{c}_range", test if high is None else test & (F.col(c) <= high)


def run_counts() -> list[Rule]:
    counts = ("jobs_found", "jobs_added", "jobs_updated", "jobs_skipped")
    inner = F.col("jobs_added") + F.col("jobs_updated") + F.col("jobs_skipped")
    every = F.lit(True)
    for c in counts:
        every = every & (F.col(c) >= 0)
    return [("run_counts_not_negative", every), ("run_counts_add_up", inner <= F.col("jobs_found"))]


def max_length(c: str, n: int) -> Rule:
    return f"{c}_length", F.length(c) <= n


def listing_rules(columns: Sequence[str]) -> list[Rule]:
    """Rules of the listings table, those whose columns are there."""
    degrees = ("associate_degree", "bachelors_degree", "masters_degree", "doctorate_degree")
    availability = ("weekends_required", "evenings_required", "holidays_required")
    wanted: list[tuple[tuple[str, ...], Rule]] = [
        (("job_title",), not_blank("job_title")),
        (("application_method",), allowed("application_method", "application_method")),
        (("application_method", "application_email"), required_when(
            "application_email", F.col("application_method") == "email", "email_for_email_method")),
        (("posting_url",), http_url("posting_url")),
        (("minimum_salary",), positive("minimum_salary")),
        (("minimum_salary", "maximum_salary"), ordered("minimum_salary", "maximum_salary")),
        (("pay_frequency",), allowed("pay_frequency", "pay_frequency")),
        (("date_posted", "date_closed"), ordered("date_posted", "date_closed")),
        (("experience_years_min", "experience_years_max"), ordered("experience_years_min", "experience_years_max")),
        (("travel_requirements",), allowed("travel_requirements", "travel_requirements")),
        (("travel_percentage",), between("travel_percentage", 0, 100)),
        (("extraction_confidence",), between("extraction_confidence", 0, 1)),
    ]
    wanted += [((c,), allowed(c, "degree")) for c in degrees]
    wanted += [((c,), allowed(c, "availability")) for c in availability]
    wanted += [((c,), between(c, 0)) for c in ("experience_years_min", "experience_years_max")]
    have = set(columns)
    return [rule for needs, rule in wanted if have.issuperset(needs)]


def table_rules(table: str, columns: Sequence[str]) -> list[Rule]:
    """Rules of the other tables, those whose columns are there."""
    wanted: dict[str, list[tuple[tuple[str, ...], Rule]]] = {
        "company": [
            (("common_name",), not_blank("common_name")),
            (("date_founded", "date_closed"), ordered("date_founded", "date_closed", strict=True)),
        ],
        "companysite": [(("employee_count",), between("employee_count", 0))],
        "company_socials": [(("company_url",), social_url("company_url"))],
        "user_company_roles": [(("role",), allowed("role", "company_role"))],
        "company_invites": [(("role",), allowed("role", "company_role"))],
        "companytechnologies": [
            (("proficiency_level",), allowed("proficiency_level", "proficiency")),
            (("years_experience",), between("years_experience", 0)),
        ],
        "joblistingskills": [
            (("proficiency_level",), allowed("proficiency_level", "proficiency")),
            (("extraction_method",), allowed("extraction_method", "extraction_method")),
            (("years_required",), between("years_required", 0)),
            (("confidence_score",), between("confidence_score", 0, 1)),
        ],
        "joblistingcertifications": [
            (("extraction_method",), allowed("extraction_method", "extraction_method")),
            (("confidence_score",), between("confidence_score", 0, 1)),
        ],
        "user_skills": [
            (("proficiency_level",), allowed("proficiency_level", "proficiency")),
            (("years_experience",), between("years_experience", 0)),
        ],
        "user_certifications": [
            (("obtained_date", "expiry_date"), ordered("obtained_date", "expiry_date", strict=True)),
            (("credential_url",), http_url("credential_url")),
        ],
        "applications": [(("status",), allowed("status", "application_status"))],
        "scrapinglog": [
            (("status",), allowed("status", "run_status")),
            (("started_at", "completed_at"), ordered("started_at", "completed_at")),
            *[(("jobs_found", "jobs_added", "jobs_updated", "jobs_skipped"), rule) for rule in run_counts()],
        ],
    }
    if table == "joblistings":
        return listing_rules(columns)
    have = set(columns)
    return [rule for needs, rule in wanted[table] if have.issuperset(needs)]


# Columns that must be unique together, by table.
UNIQUE_KEYS = {
    "country": [("name",)],
    "state": [("country_id", "name")],
    "company_type": [("name",)],
    "companysitetype": [("name",)],
    "benefits": [("name",)],
    "features": [("name",)],
    "functions": [("name",)],
    "functionspecialties": [("function_id", "specialty")],
    "industries": [("name",)],
    "jobstatus": [("name",)],
    "jobtype": [("name",)],
    "officelocations": [("name",)],
    "social_media_types": [("name",)],
    "skill_categories": [("name",)],
    "skills": [("name",)],
    "users": [("email",), ("oauth_provider", "oauth_subject")],
    "user_company_roles": [("user_id", "company_id")],
    "company_invites": [("token",)],
    "company_socials": [("company_id", "social_media_type_id")],
    "companybenefits": [("company_id", "benefit_id")],
    "companyfunctions": [("company_id", "function_id")],
    "companyindustries": [("company_id", "industry_id")],
    "companytechnologies": [("company_id", "skill_id")],
    "joblistingskills": [("job_listing_id", "skill_id")],
    "saved_jobs": [("user_id", "job_listing_id")],
    "sitefeatures": [("site_id", "feature_id")],
    "user_skills": [("user_id", "skill_id")],
    "user_certifications": [("user_id", "certification_id")],
    "joblistingcertifications": [("job_listing_id", "certification_id")],
}

# Keys that must name a row of a parent table, by table.
PARENTS = {
    "state": {"country_id": "country"},
    "cities": {"state_id": "state"},
    "functionspecialties": {"function_id": "functions"},
    "certifications": {"provider_id": "certification_providers"},
    "skills": {"skill_category_id": "skill_categories", "certification_id": "certifications"},
    "company": {"company_type": "company_type", "approved_by": "users"},
    "user_company_roles": {"user_id": "users", "company_id": "company", "approved_by": "users"},
    "company_invites": {"company_id": "company", "invited_by": "users", "accepted_by": "users"},
    "companysite": {
        "company_id": "company", "country_id": "country", "state_id": "state", "city_id": "cities", "site_type": "companysitetype"},
    "company_socials": {"company_id": "company", "social_media_type_id": "social_media_types"},
    "companybenefits": {"benefit_id": "benefits", "company_id": "company"},
    "companyfunctions": {"company_id": "company", "function_id": "functions"},
    "companyindustries": {"company_id": "company", "industry_id": "industries"},
    "companytechnologies": {"company_id": "company", "skill_id": "skills"},
    "notes": {"company_id": "company", "created_by": "users"},
    "joblistings": {
        "company_id": "company", "company_site_id": "companysite", "posted_by": "users", "approved_by": "users",
        "job_status_id": "jobstatus", "function": "functions", "specialty": "functionspecialties", "job_type_id": "jobtype",
        "experience_id": "experience", "office_location_id": "officelocations", "city_id": "cities"},
    "joblistingskills": {"job_listing_id": "joblistings", "skill_id": "skills"},
    "applications": {"job_listing_id": "joblistings", "applicant_user_id": "users", "status_updated_by": "users"},
    "saved_jobs": {"user_id": "users", "job_listing_id": "joblistings"},
    "saved_searches": {"user_id": "users"},
    "notifications": {
        "user_id": "users", "related_job_id": "joblistings", "related_company_id": "company", "related_application_id": "applications"},
    "scrapinglog": {"company_id": "company"},
    "sitefeatures": {"feature_id": "features", "site_id": "companysite"},
    "user_skills": {"user_id": "users", "skill_id": "skills"},
    "user_certifications": {"user_id": "users", "certification_id": "certifications", "verified_by": "users"},
    "joblistingcertifications": {"job_listing_id": "joblistings", "certification_id": "certifications"},
}


def _report(tables: dict[str, DataFrame], names: Sequence[tuple], columns: str, marked: Sequence[DataFrame], found: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``found`` makes of all marked rows, for every name in ``names``; zero where there is none."""
    spark = next(iter(tables.values())).sparkSession if tables else SparkSession.active()
    every = spark.createDataFrame(list(names), columns)
    if not marked:
        return every
    keys = every.columns
    return every.join(found(reduce(DataFrame.unionByName, marked)), keys, "left")


def uniqueness_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, columns, repeated_keys, rows_over) for every unique key of the given tables.

    A key with a NULL in it is never a repeat. Keys whose columns a table lacks are left out.
    A table is read once: a row gives a row for each of its keys, and the keys of all tables are
    counted in one aggregation.
    """
    names, marked = [], []
    for name, keys in UNIQUE_KEYS.items():
        keys = [k for k in keys if name in tables and set(k) <= set(tables[name].columns)]
        names += [(name, ", ".join(k)) for k in keys]
        values = [F.when(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in k]), F.array(*[F.col(c).cast("string") for c in k])) for k in keys]
        if keys:
            entries = F.array(*[F.struct(F.lit(", ".join(k)).alias("columns"), v.alias("key")) for k, v in zip(keys, values)])
            marked.append(tables[name].select(F.lit(name).alias("table_name"), F.explode(entries).alias("e")).select("table_name", "e.*").where("key IS NOT NULL"))

    def repeats(rows: DataFrame) -> DataFrame:
        counts = rows.groupBy("table_name", "columns", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        return counts.groupBy("table_name", "columns").agg(F.count(F.lit(1)).alias("repeated_keys"), F.sum(F.col("n") - 1).alias("rows_over"))

    out = _report(tables, names, "table_name string, columns string", marked, repeats)
    return out.select("table_name", "columns", *[_or_zero(out, c) for c in ("repeated_keys", "rows_over")])


def _or_zero(df: DataFrame, c: str) -> Column:
    return (F.coalesce(c, F.lit(0)) if c in df.columns else F.lit(0)).cast("bigint").alias(c)


def orphan_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, column, parent, orphans) for every key of the given tables whose parent is given.

    A table is read once: a row gives a row for each key that it holds, and one for each key that
    may name it. Children and parents of all keys meet in one aggregation, without a join.
    """
    keys = [
        (name, key, parent) for name, own in PARENTS.items() for key, parent in own.items()
        if name in tables and parent in tables and key in tables[name].columns
    ]
    marked = []
    for name, table in tables.items():
        held = [(k, F.col(k[1]), 1) for k in keys if k[0] == name] + [(k, F.col("id"), 0) for k in keys if k[2] == name]
        if held:
            entries = F.array(*[
                F.struct(*[F.lit(x).alias(c) for x, c in zip(k, ("table_name", "column", "parent"))], value.cast("string").alias("key"), F.lit(child).alias("child"))
                for k, value, child in held
            ])
            marked.append(table.select(F.explode(entries).alias("e")).select("e.*").where("key IS NOT NULL"))

    def orphaned(rows: DataFrame) -> DataFrame:
        met = rows.groupBy("table_name", "column", "parent", "key").agg(F.sum("child").alias("children"), F.min("child").alias("alone"))
        return met.where("alone = 1").groupBy("table_name", "column", "parent").agg(F.sum("children").alias("orphans"))

    out = _report(tables, keys, "table_name string, column string, parent string", marked, orphaned)
    return out.select("table_name", "column", "parent", _or_zero(out, "orphans"))


def with_violations(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``violations``: names of the rules a row breaks."""
    marks = [F.when(~F.coalesce(ok, F.lit(True)), F.lit(name)) for name, ok in rules]
    return df.withColumn("violations", F.filter(F.array(*marks), lambda v: v.isNotNull()))


def split_by_quality(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their violations)."""
    marked = with_violations(df, rules)
    return marked.where(F.size("violations") == 0).drop("violations"), marked.where(F.size("violations") > 0)


def violation_counts(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """(table_name, rule, violations) for every rule, zero included, in one pass."""
    one = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(True))).alias(f"v{i}") for i, (_, ok) in enumerate(rules)])
    entries = F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(name).alias("rule"), F.col(f"v{i}").alias("violations"))
        for i, (name, _) in enumerate(rules)
    ])
    return one.select(F.explode(entries).alias("e")).select("e.*")


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that should be unique and are not, with how often each occurs."""
    counted = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") > 1)


def orphans(children: DataFrame, key: str, parents: DataFrame, parent_key: str = "id") -> DataFrame:
    """Children whose key names no parent; a NULL key is no orphan."""
    keyed = children.where(F.col(key).isNotNull())
    return keyed.join(parents.select(F.col(parent_key).alias(key)), key, "left_anti")
