"""Broken and undeclared documents, key reports in one pass, the word index, the stream's state."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F

from vacancia.operators import dedup, merge as M, quality, resolve
from vacancia.plans.cycle import run_cycle
from vacancia.sources import feeds
from vacancia.streaming import jobs

WORKDAY = "total INT, jobPostings ARRAY<STRUCT<title: STRING, externalPath: STRING>>"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# ---- quarantine -----------------------------------------------------------------------------


def pages(spark):
    texts = [
        (1, '{"total": 2, "jobPostings": [{"title": "a", "externalPath": "/a"}]}'), (1, '{"total": 2, "jobPostings": [{"title": "b", "ext'),
        (2, '{"total": "many", "jobPostings": [{"title": "c", "externalPath": "/c"}]}'), (3, ""), (4, None), (5, "<html>busy</html>"),
        (6, '{"total": 0, "jobPostings": []}'), (7, "{}"), (8, '{"total": 1, "extra": {"x": [1]}, "jobPostings": null}'),
    ]
    return spark.createDataFrame(texts, "company_id bigint, page string")


def test_broken_pages_are_kept_apart(spark):
    documents, quarantine = feeds.split_documents(pages(spark), "page", WORKDAY)
    assert documents.columns == ["company_id", "total", "jobPostings"]
    assert sorted(r.company_id for r in documents.collect()) == [1, 6, 7, 8]
    assert sorted((r.company_id, r.reason) for r in quarantine.collect()) == [(1, "malformed"), (2, "malformed"), (3, "empty"), (4, "empty"), (5, "malformed")]
    assert documents.count() + quarantine.count() == pages(spark).count()


def test_bare_lists_are_split_too(spark):
    texts = spark.createDataFrame([(1, '[{"title": "a"}]'), (2, '[{"title": "a"'), (3, "[]")], "company_id bigint, page string")
    documents, quarantine = feeds.split_documents(texts, "page", "ARRAY<STRUCT<title: STRING>>")
    assert sorted(r.company_id for r in documents.collect()) == [1, 3] and [r.company_id for r in quarantine.collect()] == [2]


def test_landed_files_say_where_a_broken_page_came_from(spark):
    folder = tempfile.mkdtemp(prefix="vacancia-landed-")
    for name, text in (("a", '{"total": 1,\n "jobPostings": []}'), ("b", '{"total": 1,\n "jobP')):
        with open(f"{folder}/{name}.json", "w") as out:
            out.write(text)
    _, quarantine = feeds.split_documents(feeds.landed_texts(spark, folder, multi_line=True), "text", WORKDAY)
    assert [r.file.rsplit("/", 1)[1] for r in quarantine.collect()] == ["b.json"]


def test_a_company_with_a_broken_page_closes_nothing(spark):
    old = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    state = spark.range(1, 5).select("id", (F.col("id") % 2).alias("company_id"), F.concat(F.lit("http://u"), "id").alias("posting_url"), F.lit("active").alias("job_status"),
                                     F.lit(None).cast("date").alias("date_closed"), *[old.alias(c) for c in ("last_scraped", "created_at", "updated_at")])
    companies = spark.range(2).select("id", F.lit("2024-05-01 00:00:00").cast("timestamp_ntz").alias("last_full_scrape_completed"))
    feed = spark.createDataFrame([(0, "http://u2", "b", "t"), (1, "http://u1", "b", "t")], "company_id bigint, posting_url string, source_job_board string, job_title string")
    broken = spark.createDataFrame([(1, "malformed"), (1, "empty")], "company_id bigint, reason string")
    cycle = run_cycle(state, feed, companies, "2024-06-15 12:00:00", broken=broken)
    assert sorted((r.company_id, r.action) for r in cycle.changes.collect()) == [(0, "closed"), (0, "touched"), (1, "touched")]
    assert {r.company_id: r.status for r in cycle.run_log.collect()} == {0: "completed", 1: "failed"}


# ---- documents of any shape -----------------------------------------------------------------


def test_postings_of_undeclared_shapes(spark):
    fields = {"title": ("title", "Position Title"), "place": ("city", "where")}
    docs = spark.createDataFrame([
        (1, '{"a": {"b": [{"Position Title": "x", "where": "Tulsa"}, {"Position Title": "y"}]}, "c": [1, 2]}'),
        (2, '[{"title": "z", "city": 7}, {"other": 1}, "text"]'), (3, '{"a": [], "b": [{"title": "first"}], "c": [{"title": "second"}]}'),
        (4, '{"title": "no list"}'), (5, "not json"), (6, None), (7, "[]"), (8, '{"a": [{"title": null}]}'), (9, '[[{"title": "nested"}]]'),
    ], "k int, doc string")
    got = sorted((r.k, r.pos, r.title, r.place) for r in feeds.postings_of_any_shape(docs, "doc", ["k"], fields).collect())
    assert got == [(1, 0, "x", "Tulsa"), (1, 1, "y", None), (2, 0, "z", "7"), (3, 0, "first", None), (9, 0, "nested", None)]


def test_filters_of_undeclared_names(spark):
    rows = spark.createDataFrame([(1, '{"city": "Tulsa", "types": ["a", "b"], "max": 2.5, "gone": null, "deep": {"x": 1}}'), (2, "broken {"), (3, "{}")], "k int, filters string")
    got = sorted((r.k, r.name, r.value) for r in feeds.filters_of_any_shape(rows, "filters", ["k"]).where("kind NOT LIKE 'object%'").collect())
    assert got == [(1, "city", "Tulsa"), (1, "max", "2.5"), (1, "types", "a"), (1, "types", "b")]


# ---- keys in one pass -----------------------------------------------------------------------


def constrained(spark):
    return {
        "users": spark.createDataFrame([(1, "a", "g", "x"), (2, "a", "g", "x"), (3, None, "g", None), (4, "b", None, "x")], "id bigint, email string, oauth_provider string, oauth_subject string"),
        "company": spark.createDataFrame([(1, 9, 1), (2, None, 7)], "id bigint, company_type bigint, approved_by bigint"),
        "joblistings": spark.createDataFrame([(1, 1, 2), (2, 5, 2), (3, 5, None), (4, None, 8)], "id bigint, company_id bigint, posted_by bigint"),
        "saved_jobs": spark.createDataFrame([(1, 1), (1, 1), (1, 1), (2, 9)], "user_id bigint, job_listing_id bigint"),
    }


def test_key_reports(spark):
    tables = constrained(spark)
    unique = {(r.table_name, r.columns): (r.repeated_keys, r.rows_over) for r in quality.uniqueness_report(tables).collect()}
    assert unique == {("users", "email"): (1, 1), ("users", "oauth_provider, oauth_subject"): (1, 1), ("saved_jobs", "user_id, job_listing_id"): (1, 2)}
    orphans = {(r.table_name, r.column): r.orphans for r in quality.orphan_report(tables).collect()}
    assert orphans == {("company", "approved_by"): 1, ("joblistings", "company_id"): 2, ("joblistings", "posted_by"): 1, ("saved_jobs", "user_id"): 0, ("saved_jobs", "job_listing_id"): 1}


def test_key_reports_read_each_table_once_and_join_no_rows(spark):
    tables = {k: v.repartition(1) for k, v in constrained(spark).items()}
    for report, read in ((quality.uniqueness_report, 2), (quality.orphan_report, 4)):
        plan = plan_of(report(tables)).split("== Initial Plan ==")[0]
        assert plan.count("REPARTITION_BY_NUM") == read
        assert len(re.findall(r"(?:Hash|Merge|Loop)Join", plan)) == 1  # with the list of keys


def test_key_reports_of_no_table_and_of_tables_without_keys(spark):
    assert quality.uniqueness_report({}).count() == 0 and quality.orphan_report({}).count() == 0
    plain = {"users": spark.createDataFrame([(1,)], "id bigint")}
    assert quality.uniqueness_report(plain).columns == ["table_name", "columns", "repeated_keys", "rows_over"]
    assert quality.orphan_report(plain).count() == 0


# ---- dictionary by words --------------------------------------------------------------------


def test_a_text_makes_at_most_a_row_for_each_word(spark):
    text = " ".join(f"word{i % 4000} Broken Arrow" for i in range(7000))
    df = spark.createDataFrame([(1, text)], "k int, t string")
    side = spark.createDataFrame([("broken arrow",), ("rd17",)], "_low string")
    words = resolve._likely(df, "t", side, ["k"])
    assert sorted(r._low for r in words.collect()) == ["broken arrow", "rd17"]
    assert df.select(F.explode(F.array_distinct(F.split(F.lower("t"), resolve.SPACE_RUN)))).count() <= 4002


@pytest.mark.parametrize("text, expected", [
    ("Jobs in BROKEN ARROW, OK", "Broken Arrow"), ("broken  arrow", "  "), ("unbroken arrows", "Broken Arrow"), ("x\tb", None), ("", None), (None, None),
    ("tulsaville", "Tulsa"), ("a  b", "  "), ("Sand Springs", "Sand Springs"), ("n.y.", "n.y."), ("new york city", "New York City"),
])
def test_dictionary_by_words(spark, text, expected):
    names = spark.createDataFrame([(n,) for n in ("Broken Arrow", "Tulsa", "  ", "Sand Springs", "n.y.", "New York", "New York City", "a")], "name string")
    df = spark.createDataFrame([(1, text)], "k int, t string")
    assert resolve.match_dictionary(df, "t", names, ["k"], "city").first()["city"] == expected


# ---- first rows, deferred rows ---------------------------------------------------------------


def test_the_first_of_a_key_without_any_order(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "k string, n int")
    assert sorted(map(tuple, dedup.keep_first(df, ["k", "n"], []).collect())) == [("a", 1), ("b", 2)]
    assert sorted(map(tuple, dedup.first_of_key(df, ["k", "n"]).collect())) == [("a", 1), ("b", 2)]


def test_deferred_rows_of_a_large_company(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("company_id"), F.format_string("u%05d", "id").alias("posting_url"), (F.col("id") % 2 == 0).alias("old"))
    out = dedup.defer_new_rows(df, F.col("old"), ["company_id"], ["posting_url"], 40)
    assert out.count() == 5000 and out.where("old AND deferred").isEmpty()
    taken = {c: sorted(r.posting_url for r in out.where(f"NOT old AND NOT deferred AND company_id = {c}").collect()) for c in range(3)}
    assert taken == {c: [f"u{i:05d}" for i in range(5000) if i % 3 == c and i % 2][:40] for c in range(3)}


# ---- state of a stream -----------------------------------------------------------------------


def test_a_stream_with_state_on_disk_goes_on_after_a_restart(spark):
    landed, root = tempfile.mkdtemp(prefix="vacancia-landed-"), tempfile.mkdtemp(prefix="vacancia-stream-")
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)

    def land(k, ids):
        spark.createDataFrame([(i, f"2024-01-0{k} 00:00:00") for i in ids], "id bigint, at string").select("id", F.to_timestamp("at").alias("at")).coalesce(1).write.parquet(f"{landed}/day={k}")

    def run():
        source = jobs.landed_stream(spark, f"{landed}/day=*", spark.read.parquet(f"{landed}/day=1").schema)
        return jobs.run_to_table(jobs.drop_repeated(source, ["id"], "at", "30 days"), "dedup", root=root)

    land(1, range(50))
    assert run().count() == 50
    land(2, range(25, 75))
    assert sorted(r.id for r in run().collect()) == list(range(75))
    assert spark.conf.get(key) == before  # the setting is the stream's alone
    files = [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/checkpoint/state").select("path").collect()]
    assert any(f.endswith(".changelog") for f in files)


def test_counts_are_taken_while_changes_are_written(spark):
    from vacancia.session import materialise_counted

    out, counts = materialise_counted(spark.range(10), "counted", even=F.count_if(F.col("id") % 2 == 0), none=F.sum(F.lit(None).cast("int")))
    assert out.count() == 10 and counts == {"even": 5, "none": 0}


def test_closing_side_is_one_row_for_each_company(spark):
    companies = spark.range(3).select("id", F.lit(None).cast("timestamp_ntz").alias("last_full_scrape_completed"))
    gate = spark.createDataFrame([(1, True), (2, False)], "company_id bigint, complete boolean")
    assert [r.company_id for r in M.closing_companies(companies, gate).where("_closing").collect()] == [1]
