"""Feed adapters: each maps the postings of one source shape to canonical columns.

What has to be searched for in a text is a column of its own first, and the canonical
columns come from those: an expression that is used many times, such as the text of a
date, is then evaluated once per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from vacancia.functions import categories as C, dates as D, money as M, places as P, text as X
from vacancia.functions.rules import Rule
from vacancia.functions.text import col
from vacancia.operators.dedup import first_of_key

# Least description length per source shape.
MINIMUM_CONTENT = {"workday": 100, "adp": 50, "lever": 50, "paylocity": 50, "icims": 200, "fountain": 100}


def split_thin(postings: DataFrame, source: str, text: str = "job_description") -> tuple[DataFrame, DataFrame]:
    """(kept, rejected) by the least description length of a source."""
    ok = X.is_long_enough(text, MINIMUM_CONTENT[source])
    return postings.where(ok), postings.where(~ok).withColumn("reason", F.lit("short_content"))


def _salary(c: Column) -> Column:
    return c.cast(M.AMOUNT)


def _carry(df: DataFrame, carry: Sequence[str]) -> list[Column]:
    return [F.col(c) for c in carry]


def workday(postings: DataFrame, base_url: Column | str, as_of, city: str = "Tulsa",
            cities: Sequence[str] = P.SERVED_CITIES, rules: Sequence[Rule] = C.FUNCTION_KEYWORDS,
            names: Sequence[str] = C.FUNCTION_NAMES, carry: Sequence[str] = ()) -> DataFrame:
    """``externalPath`` makes the URL; rows without one are dropped."""
    base = F.lit(base_url) if isinstance(base_url, str) else base_url
    kept = postings.where(F.coalesce(F.col("externalPath") != "", F.lit(False)))
    kept = kept.withColumn("_words", F.lower(F.coalesce("title", F.lit("Unknown"))))
    return kept.select(
        *_carry(kept, carry),
        F.coalesce("title", F.lit("Unknown")).alias("job_title"),
        F.concat(base, F.col("externalPath")).alias("posting_url"),
        F.to_date(D.parse_relative("postedOn", as_of)).alias("date_posted"),
        F.coalesce(P.served_city("locationsText", cities), F.lit(city)).alias("city_name"),
        C.chosen_work_location("locationsText", F.lit(None).cast("string")).alias("office_location"),
        C.function_name("_words", rules, names).alias("function"),
    )


def named_field(fields: Column | str, code: str, value: str) -> Column:
    """Value of the first field whose code matches."""
    return F.get(F.filter(col(fields), lambda f: f["nameCode"]["codeValue"] == code), 0)[value]


def adp(postings: DataFrame, board_url: Column | str, dated_field: bool = False,
        cities: Sequence[str] = P.SERVED_CITIES, carry: Sequence[str] = ()) -> DataFrame:
    """ExternalJobID names the posting; the date is ``postDate`` or the PostingDate field."""
    external = named_field("customFieldGroup.stringFields", "ExternalJobID", "stringValue")
    date_text = (
        named_field("customFieldGroup.dateFields", "PostingDate", "dateValue")
        if dated_field else F.col("postDate")
    )
    texts = F.flatten(F.transform(
        F.col("requisitionLocations"),
        lambda l: F.array(X.strip(l["address"]["cityName"]), X.strip(l["nameCode"]["shortName"])),
    ))
    base = F.lit(board_url) if isinstance(board_url, str) else board_url
    out = postings.withColumns({
        "external_job_id": external, "_title": X.title_with_flags("requisitionTitle"),
        "_date": date_text, "_places": texts, "_type": F.col("workLevelCode.shortName"),
    })
    out = out.where(F.coalesce(F.col("external_job_id") != "", F.lit(False)))
    title = F.col("_title")
    return out.select(
        *_carry(out, carry),
        "external_job_id",
        title["title"].alias("job_title"),
        F.col("clientRequisitionID").alias("posting_id"),
        F.concat(base, F.lit("&jobId="), F.col("external_job_id")).alias("posting_url"),
        F.to_date(D.parse_iso("_date")).alias("date_posted"),
        _salary(F.col("payGradeRange.minimumRate.amountValue")).alias("minimum_salary"),
        _salary(F.col("payGradeRange.maximumRate.amountValue")).alias("maximum_salary"),
        C.job_type("_type").alias("job_type"),
        title["experience_id"].alias("experience_id"),
        title["first_shift"].alias("first_shift"),
        title["third_shift"].alias("third_shift"),
        P.served_city_of(F.col("_places"), cities).alias("city_name"),
    )


def lever(postings: DataFrame, base_url: str, cities: Sequence[str] = P.SERVED_CITIES, rules: Sequence[Rule] = C.MAKER_KEYWORDS,
          names: Sequence[str] = C.FUNCTION_NAMES, carry: Sequence[str] = ()) -> DataFrame:
    """Only postings whose first location segment is a served city; epoch-millisecond dates."""
    out = postings.withColumns({
        "_words": C.joined_text("text", "categories.team", "categories.department"),
        "_place": F.lower(P.first_segment("categories.location")),
    })
    out = out.withColumn("city_name", P.served_city("_place", cities))
    out = out.where(F.col("city_name").isNotNull() & F.coalesce(F.col("id") != "", F.lit(False)))
    return out.select(
        *_carry(out, carry),
        F.coalesce("text", F.lit("Unknown")).alias("job_title"),
        F.concat(F.lit(base_url), F.lit("/"), F.col("id")).alias("posting_url"),
        X.structural_html("description").alias("job_description"),
        F.to_date(D.from_epoch_millis(F.nullif("createdAt", F.lit(0)))).alias("date_posted"),
        C.function_name("_words", rules, names).alias("function"),
        "city_name",
    )


def fountain(postings: DataFrame, apply_url: str, employer: str, as_of, description: Column | None = None,
             city: str = "Tulsa", cities: Sequence[str] = P.SERVED_CITIES, rules: Sequence[Rule] = C.SCHOOL_KEYWORDS,
             names: Sequence[str] = C.FUNCTION_NAMES, carry: Sequence[str] = ()) -> DataFrame:
    """Openings keyed by ``to_param``; a short page text gives way to a made-up sentence."""
    kept = postings.where(F.coalesce(F.col("to_param") != "", F.lit(False)))
    description = F.lit(None).cast("string") if description is None else description
    out = kept.withColumns({
        "_text": description,
        "_url": F.concat(F.lit(apply_url + "/"), F.col("to_param"), F.lit("?brand_id=all")),
        "_title": F.coalesce("title", F.lit("Unknown")),
        "_site": X.empty_to_null("location_name"),
        "_town": P.address_city("location_address", "location_state_code"),
        "_words": C.joined_text("title", "location_name"),
    }).withColumns({"_revised": D.revised_text("_text"), "_pay": M.grade_pay("_text")})
    sentence = F.concat(
        "_title", F.lit(" — "), F.coalesce("_site", F.lit(employer)),
        F.lit(". See full details and apply at "), "_url", F.lit("."),
    )
    long_enough = X.is_long_enough("_text", MINIMUM_CONTENT["fountain"])
    return out.select(
        *_carry(out, carry),
        F.col("id").alias("posting_id"),
        F.col("_title").alias("job_title"),
        F.col("_url").alias("posting_url"),
        F.when(long_enough, F.col("_text")).otherwise(sentence).alias("job_description"),
        F.to_date(F.coalesce(D.parse_formats("_revised", D.REVISED_FORMATS), D.moment(as_of))).alias("date_posted"),
        _salary(F.col("_pay.minimum")).alias("minimum_salary"),
        _salary(F.col("_pay.maximum")).alias("maximum_salary"),
        F.col("_pay.frequency").alias("pay_frequency"),
        C.job_type("job_type").alias("job_type"),
        F.coalesce(P.served_city("_town", cities), F.lit(city)).alias("city_name"),
        P.street("location_address").alias("address1"),
        X.empty_to_null(X.strip("_site")).alias("site_name"),
        C.function_name("_words", rules, names).alias("function"),
    )


def card_block(html: Column | str, label: str) -> Column:
    """Value that follows a label element on a card."""
    return X.strip(X.unescape(X.first_match(
        html, rf"(?is)>\s*{label}\s*</[a-z]+\s*>\s*<[^>]*>\s*([^<]+?)\s*<")))


def anchor(html: Column | str, class_name: str) -> Column:
    """Source of the first link with a class, whatever the order of its attributes."""
    return F.regexp_extract(col(html), rf'(?is)<a\b[^>]*class="[^"]*{class_name}[^"]*"[^>]*>.*?</a\s*>', 0)


def href_of(link: Column | str) -> Column:
    return X.first_match(link, r'(?is)^<a\b[^>]*?href="([^"]+)"')


def icims(cards: DataFrame, html: str = "html", carry: Sequence[str] = (),
          cities: Sequence[str] = P.SERVED_CITIES, rules: Sequence[Rule] = C.FUNCTION_KEYWORDS,
          names: Sequence[str] = C.FUNCTION_NAMES) -> DataFrame:
    """Cards with an anchor for the title, label-then-value fields and a category pair.

    The title is the visible text, else the link's title without its leading number.
    """
    linked = cards.where(F.col(html).rlike(r'(?i)<a\b[^>]*class="[^"]*iCIMS_Anchor'))
    found = linked.select(
        *_carry(linked, carry),
        anchor(html, "iCIMS_Anchor").alias("_link"),
        card_block(html, "Job Locations").alias("location"),
        F.try_element_at(X.label_values(html), F.lit("category")).alias("category"),
    )
    named = F.regexp_replace(X.first_match("_link", r'(?is)^<a\b[^>]*?title="([^"]*)"'), r"^\d+\s*-\s*", "")
    titled = found.select(
        *carry,
        F.coalesce(X.empty_to_null(X.collapse(X.page_text("_link"))), X.empty_to_null(named)).alias("job_title"),
        href_of("_link").alias("_href"),
        "location",
        "category",
    )
    out = titled.where(F.col("job_title").isNotNull() & F.col("_href").isNotNull())
    return out.select(
        *carry,
        "job_title",
        P.with_query_flag("_href", "in_iframe=1").alias("posting_url"),
        "location",
        "category",
        P.served_city("location", cities).alias("city_name"),
        C.function_with_precedence("category", "job_title", names, rules).alias("function"),
    )


def ultipro(cards: DataFrame, as_of, origin: str, carry: Sequence[str] = (),
            cities: Sequence[str] = P.SERVED_CITIES, rules: Sequence[Rule] = C.FUNCTION_KEYWORDS,
            names: Sequence[str] = C.FUNCTION_NAMES) -> DataFrame:
    """Cards already split into their eight fields; the location type defaults to on-site."""
    return cards.select(
        *_carry(cards, carry),
        X.strip("job_title").alias("job_title"),
        P.absolute_url("posting_url", origin).alias("posting_url"),
        F.col("requisition_number").alias("posting_id"),
        F.to_date(D.normalise_date("posted_date_raw", as_of)).alias("date_posted"),
        C.job_type("schedule").alias("job_type"),
        F.coalesce(C.work_location("location_type"), F.lit("On-site")).alias("office_location"),
        C.function_with_precedence("job_category", "job_title", names, rules).alias("function"),
        P.served_city("physical_location", cities).alias("city_name"),
    )


def assa(items: DataFrame, base_url: str, city: str = "Tulsa", carry: Sequence[str] = ()) -> DataFrame:
    """Items with a location array; kept when any location names the city."""
    kept = items.where(F.exists("locations", lambda l: F.coalesce(F.contains(l["city"], F.lit(city)), F.lit(False))))
    return kept.select(
        *_carry(kept, carry),
        F.col("title").alias("job_title"),
        F.concat(F.lit(base_url), F.col("id")).alias("posting_url"),
        F.lit(city).alias("city_name"),
    )


def applitrack(elements: DataFrame, base_url: str, as_of, html: str = "html",
               carry: Sequence[str] = ()) -> DataFrame:
    """Listing elements: JobID, then the first ``Date Posted`` and ``Position Type`` entries."""
    item = r'(?is)<span class="label">([^<]*)</span>\s*<span class="normal">([^<]*)</span>'
    labels = F.transform(X.all_matches(html, item, 1), X.strip)
    values = F.transform(X.all_matches(html, item, 2), X.strip)
    zipped = F.arrays_zip(labels.alias("k"), values.alias("v"))

    def first(label: str) -> Column:
        return F.get(F.filter("_entries", lambda x: F.contains(x["k"], F.lit(label))), 0)["v"]

    title = X.first_match(html, r"""(?is)<td[^>]*id="wrapword"[^>]*>(.*?)</td\s*>""")
    found = elements.select(
        *_carry(elements, carry),
        X.strip(X.page_text(title)).alias("job_title"),
        P.listing_id(X.page_text(html)).alias("posting_id"),
        zipped.alias("_entries"),
    ).withColumns({"_date": first("Date Posted"), "_type": first("Position Type")})
    return found.select(
        *carry,
        "job_title",
        "posting_id",
        F.concat(
            F.lit(base_url + "&AppliTrackJobId="), F.col("posting_id"),
            F.lit("&AppliTrackLayoutMode=detail&AppliTrackViewPosting=1"),
        ).alias("posting_url"),
        F.to_date(D.normalise_date("_date", as_of)).alias("date_posted"),
        C.job_type("_type").alias("job_type"),
    )


def taleo_rows(pages: DataFrame, origin: str, as_of, html: str = "html",
               carry: Sequence[str] = (),
               cities: Sequence[str] = P.SERVED_CITIES) -> DataFrame:
    """One row per ``data-row`` of a listing page: title, link, date, location, deadline."""
    row_shape = r'(?is)<tr\b[^>]*class="[^"]*data-row[^"]*"[^>]*>(.*?)</tr\s*>'
    rows = pages.select(*_carry(pages, carry), F.posexplode(X.all_matches(html, row_shape, 1)).alias("pos", "_row"))
    rows = rows.where(F.contains("_row", F.lit("jobTitle-link"))).withColumn("_link", anchor("_row", "jobTitle-link"))
    def span(name: str) -> Column:
        return X.collapse(X.page_text(X.first_match("_row", rf'(?is)<span\b[^>]*class="{name}"[^>]*>(.*?)</span\s*>')))

    found = rows.select(
        *carry,
        "pos",
        X.collapse(X.page_text("_link")).alias("job_title"),
        href_of("_link").alias("_href"),
        span("jobDate").alias("_date"),
        span("jobLocation").alias("location"),
        D.deadline_text(X.spaced_page_text("_row")).alias("_deadline"),
    )
    found = found.withColumn("_place", F.lower(P.first_segment("location")))
    return found.select(
        *carry,
        "pos",
        "job_title",
        P.absolute_url("_href", origin).alias("posting_url"),
        F.to_date(D.normalise_date("_date", as_of)).alias("date_posted"),
        "location",
        P.served_city("_place", cities).alias("city_name"),
        F.to_date(D.normalise_date("_deadline", as_of)).alias("date_closed"),
    )


def paycom(postings: DataFrame, base_url: str, city: str = "Tulsa", rules: Sequence[Rule] = C.FUNCTION_KEYWORDS,
           names: Sequence[str] = C.FUNCTION_NAMES, carry: Sequence[str] = ()) -> DataFrame:
    kept = postings.where(F.coalesce(F.contains("location.description", F.lit(city)), F.lit(False)))
    return kept.select(
        *_carry(kept, carry),
        F.col("title").alias("job_title"),
        F.concat(F.lit(base_url), F.col("id")).alias("posting_url"),
        F.col("location.description").alias("site_name"),
        C.position_type(F.coalesce("position", F.lit(""))).alias("position_type"),
        C.function_name("department", rules, names).alias("function"),
    )


def paylocity(cards: DataFrame, base_url: str, as_of, html: str = "html", carry: Sequence[str] = ()) -> DataFrame:
    """Cards with a detail link; the first ``d/d/yyyy`` on the card is the date."""
    ident = P.detail_id(html)
    heading = X.first_match(html, r"(?is)<(?:h2|h3|h4|a)\b[^>]*>(.*?)</(?:h2|h3|h4|a)\s*>")
    found = cards.select(
        *_carry(cards, carry),
        X.empty_to_null(X.collapse(X.page_text(heading))).alias("_heading"),
        ident.alias("posting_id"),
        X.first_match(X.page_text(html), r"(\d{1,2}/\d{1,2}/\d{4})").alias("_date"),
    ).where(F.col("posting_id").isNotNull())
    return found.select(
        *carry,
        F.coalesce("_heading", F.lit("Unknown Title")).alias("job_title"),
        "posting_id",
        F.concat(F.lit(base_url), F.col("posting_id")).alias("posting_url"),
        F.to_date(D.normalise_date("_date", as_of)).alias("date_posted"),
    )


def link_blocks(pages: DataFrame, origin: str, html: str = "html", carry: Sequence[str] = ()) -> DataFrame:
    """Posting links with a titled span, and the ``Job ID:`` value before the next link."""
    blocks = F.split(F.col(html), r"(?i)<a(?=\s)")
    rows = pages.select(*_carry(pages, carry), F.posexplode(blocks).alias("pos", "_b"))
    out = rows.where(F.col("pos") > 0).select(
        *carry,
        "pos",
        X.collapse(X.page_text(X.first_match(
            "_b", r'(?is)<span[^>]*itemprop="title"[^>]*>(.*?)</span\s*>'))).alias("job_title"),
        X.first_match("_b", r'(?is)^[^>]*?href="([^"]+)"').alias("_href"),
        X.strip(X.first_match("_b", r"(?is)Job ID:\s*<span[^>]*>([^<]*)</span\s*>")).alias("posting_id"),
    )
    out = out.where(F.col("job_title").isNotNull() & F.col("_href").isNotNull())
    return out.select(*carry, "pos", "job_title", P.absolute_url("_href", origin).alias("posting_url"), "posting_id")


def container_rows(pages: DataFrame, patterns: Sequence[str], html: str = "html",
                   carry: Sequence[str] = ()) -> DataFrame:
    """Blocks of the first container shape that a page has any of, in page order."""
    found = [X.all_matches(html, p, 1) for p in patterns]
    chosen = F.coalesce(*[F.when(F.size(f) > 0, f) for f in found])
    return pages.select(*_carry(pages, carry), F.posexplode(chosen).alias("pos", "block"))


def page_links(pages: DataFrame, html: str = "html", carry: Sequence[str] = ()) -> DataFrame:
    rows = pages.select(*_carry(pages, carry), F.explode(X.links(html)).alias("_l"))
    return rows.select(*carry, "_l.*")


# Containers of a posting's text on a detail page, tried in this order.
DETAIL_CONTAINERS = (
    (r'<[a-z][^>]*\bdata-automation-id="jobPostingDescription"', None),
    (r'<[a-z][^>]*\bdata-automation-id="jobDescription"', None),
    (r'<[a-z][^>]*\bclass="(?:[^"]*\s)?jobPostingDescription(?:\s[^"]*)?"', None),
    (r'<[a-z][^>]*\brole="main"', None),
    (r"<main\b", "main"),
)

# Labels of a detail page, and the shape of a requisition id.
REMOTE_LABEL, TIME_LABEL, PAY_LABEL = r"remote\s+type", r"time\s+type", r"salary|pay\s+range|compensation"
REQUISITION_TEXT = r"(?:^|>)\s*(R\d{5,})\s*(?:<|$)"
DETAIL_FIELDS = ("posting_id", "job_type", "office_location", "minimum_salary", "maximum_salary", "job_description")


def workday_detail(pages: DataFrame, html: str = "html", carry: Sequence[str] = ()) -> DataFrame:
    """Fields of a posting's own page: labels first, the pay in the page's text as a fallback.

    The description is the first container with enough text, else the body, cleaned.
    """
    def labelled(pattern: str) -> Column:
        name = F.get(F.filter(F.map_keys("_labels"), lambda k: k.rlike(pattern)), 0)
        return F.get(F.transform(F.array(name), lambda k: F.try_element_at(F.col("_labels"), k)), 0)

    out = pages.select(*_carry(pages, carry), F.col(html).alias("_html"), X.label_values(html).alias("_labels"))
    out = X.with_page_content(out, "_html", "_content", DETAIL_CONTAINERS)
    out = out.withColumns({
        "_id": X.first_match("_html", REQUISITION_TEXT), "_remote": labelled(REMOTE_LABEL), "_time": labelled(TIME_LABEL),
        "_pay": labelled(PAY_LABEL), "_text": X.unescape(X.page_text("_html")),
    })
    out = out.withColumns({"_own": M.annual_range("_pay"), "_any": M.annual_range("_text")})
    pay = F.when(F.col("_own.minimum").isNotNull(), F.col("_own")).otherwise(F.col("_any"))
    return out.withColumn("_range", pay).select(
        *_carry(out, carry),
        F.col("_id").alias("posting_id"),
        C.job_type("_time").alias("job_type"),
        C.work_location("_remote").alias("office_location"),
        _salary(F.col("_range.minimum")).alias("minimum_salary"),
        _salary(F.col("_range.maximum")).alias("maximum_salary"),
        F.nullif(X.structural_html("_content"), F.lit("")).alias("job_description"),
    )


# Labels and containers of other families' detail pages.
STATUS_LABEL, PLACE_LABEL, RANGE_LABEL = "employment status", "", "posted range"
ICIMS_CONTAINERS = ((r'<div\b[^>]*\bclass="(?:[^"]*\s)?iCIMS_JobContainer(?:\s[^"]*)?"', "div"),)
TEXT_CONTAINERS = (
    (r'<div\b[^>]*\bclass="(?:[^"]*\s)?jobDisplay(?:\s[^"]*)?"', "div"),
    (r"<main\b", "main"), (r"<article\b", "article"), (r'<div\b[^>]*\brole="main"', "div"),
)


def icims_detail(pages: DataFrame, html: str = "html", carry: Sequence[str] = ()) -> DataFrame:
    """Fields of a posting's page by its header labels; the work location stands under a blank label.

    The description is the job container, cleaned, and empty without one.
    """
    of = lambda label: F.try_element_at("_labels", F.lit(label))
    out = pages.select(*_carry(pages, carry), F.col(html).alias("_html"), X.label_values(html).alias("_labels"))
    out = out.withColumns({"_range": M.to_range(of(RANGE_LABEL)), "_content": X.element_body("_html", *ICIMS_CONTAINERS[0])})
    return out.select(
        *_carry(out, carry),
        C.job_type(of(STATUS_LABEL)).alias("job_type"),
        C.work_location(of(PLACE_LABEL)).alias("office_location"),
        _salary(F.col("_range.minimum")).alias("minimum_salary"),
        _salary(F.col("_range.maximum")).alias("maximum_salary"),
        F.nullif(X.structural_html("_content"), F.lit("")).alias("job_description"),
    )


def text_detail(pages: DataFrame, html: str = "html", carry: Sequence[str] = (), minimum: int = 100) -> DataFrame:
    """The description alone, as collapsed text: the first container with enough of it, else the stripped body."""
    out = X.with_page_content(pages.select(*_carry(pages, carry), F.col(html).alias("_html")), "_html", "_content", TEXT_CONTAINERS, minimum)
    text = out.withColumn("_text", X.spaced_page_text("_content"))
    return text.select(*_carry(out, carry), F.when(F.length("_text") > minimum, F.col("_text")).alias("job_description"))


DETAIL_ADAPTERS = {"workday": workday_detail, "icims": icims_detail, "text": text_detail}


def with_detail(listing: DataFrame, detail: DataFrame, key: str, fields: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """Detail-page value, else listing value, for each field; the listing decides the rows.

    Of several details with one key the first in ``order`` counts.
    """
    side = first_of_key(detail.select(key, *fields, *order), [key], order)
    side = side.select(key, *[F.col(f).alias("_" + f) for f in fields])
    out = listing.join(side, key, "left")
    for f in fields:
        value = F.coalesce("_" + f, f) if f in listing.columns else F.col("_" + f)
        out = out.withColumn(f, value)
    return out.drop(*["_" + f for f in fields])
