"""Explicit schemas of the tables and feeds, as DDL, and the defaults of the listings table."""

from __future__ import annotations

from decimal import Decimal


def struct(ddl: str) -> str:
    return " ".join(ddl.split())


LISTINGS = struct(
    """
    id BIGINT, company_id BIGINT, company_site_id BIGINT, posted_by BIGINT,
    job_title STRING, job_description STRING, posting_id STRING, posting_url STRING,
    application_method STRING, application_email STRING, date_posted DATE, date_closed DATE,
    perpetual BOOLEAN, approved BOOLEAN, approved_by BIGINT, approved_at TIMESTAMP_NTZ,
    job_status STRING, function STRING, specialty STRING, job_type STRING,
    experience_id BIGINT, office_location STRING, city_id BIGINT,
    minimum_salary DECIMAL(10,2), maximum_salary DECIMAL(10,2), pay_frequency STRING,
    experience_years_min INT, experience_years_max INT,
    associate_degree STRING, bachelors_degree STRING, masters_degree STRING,
    doctorate_degree STRING, first_shift BOOLEAN, second_shift BOOLEAN, third_shift BOOLEAN,
    rotating_shift BOOLEAN, flexible_schedule BOOLEAN, weekends_required STRING,
    evenings_required STRING, holidays_required STRING, travel_requirements STRING,
    travel_percentage INT, is_temporary BOOLEAN, is_seasonal BOOLEAN, is_volunteer BOOLEAN,
    is_individual_contributor BOOLEAN, is_people_manager BOOLEAN, source_job_board STRING,
    external_job_id STRING, scraping_hash STRING, last_scraped TIMESTAMP_NTZ,
    extraction_confidence DECIMAL(3,2), extraction_timestamp TIMESTAMP,
    extraction_version STRING, raw_text_length INT,
    created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ
    """
)

# Column defaults of the listings table.
LISTING_DEFAULTS = {
    "application_method": "external_url",
    "perpetual": False,
    "approved": False,
    "job_status": "active",
    "associate_degree": "not_mentioned",
    "bachelors_degree": "not_mentioned",
    "masters_degree": "not_mentioned",
    "doctorate_degree": "not_mentioned",
    "first_shift": False,
    "second_shift": False,
    "third_shift": False,
    "rotating_shift": False,
    "flexible_schedule": False,
    "weekends_required": "not_mentioned",
    "evenings_required": "not_mentioned",
    "holidays_required": "not_mentioned",
    "travel_requirements": "not_mentioned",
    "is_temporary": False,
    "is_seasonal": False,
    "is_volunteer": False,
    "is_individual_contributor": False,
    "is_people_manager": False,
    "extraction_confidence": Decimal("1.00"),
    "extraction_version": "2.0",
}

# The part of a listing that a cycle may change. It is kept apart from the long texts,
# so that touching a posting does not rewrite its description.
STATE_COLUMNS = (
    "id", "company_id", "posting_url", "job_title", "job_status", "approved",
    "scraping_hash", "date_closed", "last_scraped", "created_at", "updated_at",
)

# Job types and states that are seeded.
JOB_TYPE_NAMES = (
    "Full-time", "Part-time", "Contract", "Contract-to-hire", "Temporary", "Internship", "As Needed",
)
JOB_STATUSES = ("active", "closed", "expired", "draft")

COMPANY = struct(
    """
    id BIGINT, slug STRING, common_name STRING, legal_name STRING, website STRING,
    jobboard STRING, date_founded DATE, date_closed DATE, defunct BOOLEAN, approved BOOLEAN,
    company_type STRING, is_scraped BOOLEAN, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ,
    last_full_scrape_completed TIMESTAMP_NTZ
    """
)

COMPANY_SITE = struct(
    """
    id BIGINT, company_id BIGINT, site_name STRING, site_type STRING, address1 STRING,
    country_id BIGINT, state_id BIGINT, city_id BIGINT, is_headquarters BOOLEAN,
    is_active BOOLEAN
    """
)

RUN_LOG = struct(
    """
    job_board STRING, company_id BIGINT, jobs_found BIGINT, jobs_added BIGINT,
    jobs_updated BIGINT, jobs_skipped BIGINT, errors MAP<STRING, BIGINT>, status STRING,
    started_at TIMESTAMP_NTZ, completed_at TIMESTAMP_NTZ, duration_seconds BIGINT
    """
)

SAVED_FILTERS = struct("city_id BIGINT, function_id BIGINT, remote BOOLEAN, k BIGINT")

# --- feeds ------------------------------------------------------------------

FEED_WORKDAY = struct(
    """
    total INT, offset INT, jobPostings ARRAY<STRUCT<title: STRING, externalPath: STRING,
    locationsText: STRING, postedOn: STRING, locations: ARRAY<STRUCT<descriptor: STRING>>>>
    """
)
FEED_WORKDAY_FACETS = struct(
    """
    facets ARRAY<STRUCT<facetParameter: STRING,
    facets: ARRAY<STRUCT<id: STRING, descriptor: STRING, count: INT>>>>
    """
)
FEED_ADP = struct(
    """
    jobRequisitions ARRAY<STRUCT<
      requisitionTitle: STRING, clientRequisitionID: STRING, postDate: STRING,
      workLevelCode: STRUCT<shortName: STRING>,
      payGradeRange: STRUCT<
        minimumRate: STRUCT<amountValue: DECIMAL(18,2)>,
        maximumRate: STRUCT<amountValue: DECIMAL(18,2)>>,
      customFieldGroup: STRUCT<
        stringFields: ARRAY<STRUCT<nameCode: STRUCT<codeValue: STRING>, stringValue: STRING>>,
        dateFields: ARRAY<STRUCT<nameCode: STRUCT<codeValue: STRING>, dateValue: STRING>>>,
      requisitionLocations: ARRAY<STRUCT<
        nameCode: STRUCT<shortName: STRING>, address: STRUCT<cityName: STRING>>>>>
    """
)
FEED_LEVER = struct(
    """
    id STRING, text STRING, description STRING, createdAt BIGINT,
    categories STRUCT<location: STRING, team: STRING, department: STRING>
    """
)
FEED_FOUNTAIN = struct(
    """
    page INT, openings ARRAY<STRUCT<id: STRING, title: STRING, to_param: STRING,
    location_name: STRING, location_address: STRING, location_state_code: STRING,
    job_type: STRING>>, pagination STRUCT<next_page: INT, total_pages: INT>
    """
)
FEED_ASSA = struct("items ARRAY<STRUCT<id: STRING, title: STRING, locations: ARRAY<STRUCT<city: STRING>>>>")
FEED_PAYCOM = struct(
    "id STRING, title STRING, department STRING, position STRING, location STRUCT<description: STRING>"
)
CARDS = struct(
    """
    job_title STRING, posting_url STRING, posted_date_raw STRING, requisition_number STRING,
    schedule STRING, job_category STRING, location_type STRING, physical_location STRING
    """
)
PAGES = struct("page_id BIGINT, url STRING, html STRING")
