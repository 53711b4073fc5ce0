"""Operators: numbering, matching, merge invariants, dimensions, deletes, quality."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from vacancia.functions import categories as C
from vacancia.operators import dedup, deletes as Del, dims, merge as M, quality as Q, resolve as R
from vacancia.operators.numbering import number_rows, with_new_ids
from vacancia.plans import audit, cycle, views
from vacancia.sources import tables

NOW = "2024-06-15 12:00:00"
STATE = "id bigint, company_id bigint, posting_url string, job_title string, job_status string, approved boolean, date_closed date, last_scraped timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
COMPANIES = "id bigint, last_full_scrape_completed timestamp_ntz"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def at(day):
    return dt.datetime(2024, 6, day)


def row(i, company, url, status="active", updated=1, closed=None):
    return (i, company, url, f"t{i}", status, False, closed, at(updated), at(1), at(updated))


def state(spark, *rows):
    return spark.createDataFrame(list(rows), STATE)


def companies(spark, **completed):
    return spark.createDataFrame([(int(k[1:]), v) for k, v in completed.items()], COMPANIES)


def by_url(staged):
    return {r["posting_url"]: r for r in staged.collect()}


# --- numbering --------------------------------------------------------------

def test_numbers_are_dense_in_each_group_however_large(spark):
    # one group holds a third of the rows
    rows = [("hot" if i % 3 == 0 else f"g{i % 7}", f"n{i}") for i in range(6000)]
    out = number_rows(spark.createDataFrame(rows, "g string, n string"), ["n"], ["g"]).collect()
    seen = {}
    for r in out:
        seen.setdefault(r["g"], []).append(r["rn"])
    assert len(out) == len(rows)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in seen.values())


def test_numbers_do_not_depend_on_the_layout(spark):
    rows = [(f"n{i}",) for i in range(500)]
    df = spark.createDataFrame(rows, "n string")
    a = dict((r["n"], r["rn"]) for r in number_rows(df.repartition(7), ["n"]).collect())
    b = dict((r["n"], r["rn"]) for r in number_rows(df.coalesce(1), ["n"]).collect())
    assert a == b


def test_new_ids_follow_the_largest(spark):
    stored = spark.createDataFrame([(41,), (7,)], "id bigint")
    new = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert sorted(r["id"] for r in with_new_ids(new, ["k"], stored).collect()) == [42, 43, 44]
    assert sorted(r["id"] for r in with_new_ids(new, ["k"], stored.limit(0)).collect()) == [1, 2, 3]


# --- duplicates -------------------------------------------------------------

def test_first_and_last(spark):
    df = spark.createDataFrame([("u", 2, "b"), ("u", 1, "a"), ("v", 1, "c")], "url string, pos int, x string")
    assert sorted(r["x"] for r in dedup.keep_first(df, ["url"], ["pos"]).collect()) == ["a", "c"]
    assert sorted(r["x"] for r in dedup.keep_last(df, ["url"], ["pos"]).collect()) == ["b", "c"]


def test_one_row_per_key_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(dedup.keep_first(df, ["k"], ["id"]))
    assert "WindowGroupLimit" in plan.split("Exchange")[1], plan


def test_cap_defers_new_rows_and_loses_none(spark):
    df = spark.createDataFrame([(i, i < 4, "c") for i in range(10)], "id int, known boolean, c string")
    out = dedup.defer_new_rows(df, F.col("known"), ["c"], ["id"], 2)
    assert {r["id"]: r["deferred"] for r in out.collect()} == {i: i > 5 for i in range(10)}
    assert dedup.defer_new_rows(df, F.col("known"), ["c"], ["id"]).where("deferred").count() == 0


def test_one_row_per_key_on_the_right_side(spark):
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 3), (2, None, 1), (2, "z", 1)], "k int, v string, pos int")
    assert {tuple(r) for r in dedup.first_of_key(df, ["k"], ["pos"]).collect()} == {(1, "b"), (2, None)}
    assert {tuple(r) for r in dedup.first_of_key(df, ["k"]).select("k", "v").collect()} == {(1, "a"), (2, None)}
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert R.join_metadata(left, df, "k", ["pos"]).count() == 3


def test_active_urls_last_row_wins(spark):
    s = state(spark, row(1, 1, "u"), row(3, 1, "u"), row(9, 1, "u", "closed"), row(4, 1, ""), row(5, 1, None))
    assert [tuple(r) for r in dedup.active_urls(s).collect()] == [(1, "u", 3)]


# --- lookups ----------------------------------------------------------------

NAMES = ["alpha", "alpha one", "beta", "Beta", "gamma ray", "ray", "a", "xyz"]


def brute_match(text, names):
    hits = [n for n in sorted(set(names)) if text is not None and n.lower() in text.lower()]
    return min(hits, key=lambda n: (-len(n), n)) if hits else None


def test_dictionary_match_against_brute_force(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice(["alpha", " one", "beta", "BETA", "gam", "ma ray", " ", "q", "xy", "z"]) for _ in range(rng.randint(0, 6))) for _ in range(200)]
    texts += [None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = {r["k"]: r["m"] for r in R.match_dictionary(df, "t", names, ["k"], "m").collect()}
    assert got == {i: brute_match(t, NAMES) for i, t in enumerate(texts)}


def test_rules_by_join_equal_the_expression(spark):
    from vacancia.functions.categories import FUNCTION_KEYWORDS, FUNCTION_NAMES

    texts = ["Web Developer", "account manager", "Cook", "Machine operator", "Brand lead", "security guard", "chief HR", "", "marketing contract"]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    rules = spark.createDataFrame([(i, c, w) for i, (c, ws) in enumerate(FUNCTION_KEYWORDS) for w in ws], "priority int, category string, keyword string")
    names = spark.createDataFrame([(n,) for n in FUNCTION_NAMES], "name string")
    joined = R.match_rules(df, "t", rules, names, ["k"], "f").select("k", F.coalesce("f", F.lit("Other")).alias("f"))
    inline = df.select("k", C.function_name("t").alias("f"))
    assert sorted(joined.collect()) == sorted(inline.collect())


def test_match_either_is_two_equi_joins(spark):
    rows = spark.createDataFrame([("u1", "t", 1), ("x", "t", 1), ("x", "none", 1), (None, None, 1)], "posting_url string, job_title string, company_id bigint")
    stored = spark.createDataFrame([(5, "u1", "z", 1), (3, "u2", "t", 1), (4, "u3", "t", 1)], "id bigint, posting_url string, job_title string, company_id bigint")
    out = R.match_either(rows, stored, ["posting_url"], ["job_title", "company_id"])
    assert sorted((r["posting_url"] or "", r["job_title"] or "", r["existing_id"]) for r in out.collect()) == [
        ("", "", None), ("u1", "t", 3), ("x", "none", None), ("x", "t", 3)]
    assert "NestedLoop" not in plan_of(out) and "Cartesian" not in plan_of(out)


def test_lookup_does_not_multiply_rows(spark):
    dim = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, name string")
    out = R.lookup_id(spark.createDataFrame([("a",), ("z",)], "n string"), dim, "n", "n_id").collect()
    assert sorted((r["n"], r["n_id"]) for r in out) == [("a", 1), ("z", None)]


def test_sites(spark):
    sites = spark.createDataFrame([(1, 1, " Main ", "5 A St", 7), (2, 1, None, "6 B St", None), (3, 2, "main", None, None)],
                                  "id bigint, company_id bigint, site_name string, address1 string, city_id bigint")
    posts = spark.createDataFrame([(1, "MAIN", "5 a st", None), (1, "Yard", "6 b ST", 3), (2, "Main", "9", None), (1, " ", "", None)],
                                  "company_id bigint, site_name string, address1 string, city_id bigint")
    by_name = R.match_site(posts, sites, "site_name", "site_name")
    assert sorted((r["site_name"], r["company_site_id"]) for r in by_name.collect()) == [(" ", None), ("MAIN", 1), ("Main", 3), ("Yard", None)]
    by_address = R.match_site(posts, sites, "address1", "address1")
    assert sorted((r["address1"], r["company_site_id"]) for r in by_address.collect()) == [("", None), ("5 a st", 1), ("6 b ST", 2), ("9", None)]
    assert {r["site_name"]: r["city_id"] for r in R.city_from_site(by_name, sites).collect()} == {"MAIN": 7, "Yard": 3, "Main": None, " ": None}
    made = dims.get_or_create_sites(sites, posts).collect()
    assert [(r["id"], r["company_id"], r["site_name"], r["is_active"]) for r in made] == [(4, 1, "Yard", True)]


# --- merge ------------------------------------------------------------------

def test_merge_case(spark):
    before = state(spark, row(1, 1, "A"), row(2, 1, "B"), row(3, 1, "C", "closed", closed=dt.date(2024, 6, 1)))
    incoming = spark.createDataFrame([(1, "A"), (1, "C"), (1, "D")], "company_id bigint, posting_url string")
    staged = M.merge_snapshot(before, incoming, companies(spark, c1=at(10)), NOW)
    got = by_url(staged)
    assert {u: (r["action"], r["job_status"]) for u, r in got.items()} == {
        "A": ("touched", "active"), "B": ("closed", "closed"), "C": ("touched", "closed"), "D": ("inserted", "active")}
    assert got["B"]["date_closed"] == dt.date(2024, 6, 15) and got["C"]["date_closed"] == dt.date(2024, 6, 1)
    assert got["D"]["id"] == 4 and got["D"]["approved"] is False
    assert got["A"]["last_scraped"] == got["A"]["updated_at"] == dt.datetime(2024, 6, 15, 12)
    assert got["A"]["job_title"] == "t1"
    assert {r["action"]: r["n"] for r in M.change_counts(staged).collect()} == {"touched": 2, "closed": 1, "inserted": 1}


def test_active_only_mode_inserts_a_returning_posting_again(spark):
    before = state(spark, row(3, 1, "C", "closed"), row(4, 2, "D"))
    incoming = spark.createDataFrame([(1, "C"), (1, "D")], "company_id bigint, posting_url string")
    staged = M.merge_snapshot(before, incoming, companies(spark, c1=None), NOW, active_only=True)
    got = sorted((r["posting_url"], r["company_id"], r["action"]) for r in staged.collect())
    assert got == [("C", 1, "inserted"), ("C", 1, "kept"), ("D", 1, "inserted"), ("D", 2, "kept")]


def test_closing_needs_a_completed_cycle_a_snapshot_and_completeness(spark):
    before = state(spark, *[row(i, i, f"u{i}") for i in (1, 2, 3, 4, 5)])
    done = companies(spark, c1=at(10), c2=None, c3=at(10), c4=at(1), c5=at(10))
    incoming = spark.createDataFrame([(c, f"new{c}") for c in (1, 2, 4, 5)], "company_id bigint, posting_url string")
    announced = spark.createDataFrame([(1, 1), (2, 1), (4, 1), (5, 2)], "company_id bigint, total int")
    got = by_url(M.merge_snapshot(before, incoming, done, NOW, announced=announced))
    # 2 never completed, 3 landed nothing, 4 was seen exactly at the completion, 5 landed half
    assert {u: got[u]["action"] for u in ("u1", "u2", "u3", "u4", "u5")} == {
        "u1": "closed", "u2": "kept", "u3": "kept", "u4": "kept", "u5": "kept"}


def test_completeness_counts_what_landed(spark):
    landed = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (2, "b"), (3, "a")], "company_id bigint, posting_url string")
    announced = spark.createDataFrame([(1, 3), (2, 2), (2, 1), (4, 1)], "company_id bigint, total int")
    got = lambda **k: {r["company_id"]: r["complete"] for r in M.complete_companies(landed, announced, **k).collect()}
    assert got() == {1: False, 2: True, 3: False}  # a repeat counts once; no total is not complete
    assert got(unknown=True) == {1: False, 2: True, 3: True}
    # the feed is what an adapter left over: its company is complete all the same
    before = state(spark, row(1, 2, "gone"))
    feed = landed.where("company_id = 2 and posting_url = 'a'")
    merged = by_url(M.merge_snapshot(before, feed, companies(spark, c2=at(10)), NOW, announced=announced, landed=landed))
    assert merged["gone"]["action"] == "closed"


def test_versions_of_tables(spark, tmp_path):
    root = str(tmp_path / "listings")
    assert tables.current_version(spark, root) == 0
    tables.write_listings(state(spark, row(1, 1, "a"), row(2, 65, "b"), row(3, 2, "c")), root)
    now = tables.read_listings(spark, root)
    tables.write_listings(now.where("company_id <> 2"), root)  # a company vanishes, read and written at once
    assert sorted(r["id"] for r in tables.read_listings(spark, root).collect()) == [1, 2]
    assert [r["id"] for r in tables.read_listings(spark, root, 65).collect()] == [2]
    tables.write_listings(now.limit(0), root)
    assert tables.read_listings(spark, root).count() == 0 and tables.current_version(spark, root) == 3
    for k in (1, 2):
        tables.commit_tables(spark, root, {}, {"log": spark.range(k)})
    spark.range(9).write.parquet(f"{root}/log/version=6")  # a run that died before its commit
    assert tables.read_appended(spark, root, "log").count() == 3
    tables.commit_tables(spark, root, {}, {"log": spark.range(4)})
    assert tables.read_appended(spark, root, "log").count() == 7


def test_incomplete_companies_are_not_stamped(spark):
    before = state(spark, row(1, 1, "http://A"), row(2, 2, "http://B"))
    feed = spark.createDataFrame([(c, f"t{c}", f"http://new{c}", "board") for c in (1, 2)], "company_id bigint, job_title string, posting_url string, source_job_board string")
    announced = spark.createDataFrame([(1, 1), (2, 50)], "company_id bigint, total int")
    c = cycle.run_cycle(before, feed, companies(spark, c1=at(10), c2=at(10)), NOW, announced=announced)
    assert {r["id"]: r["last_full_scrape_completed"].day for r in c.companies.collect()} == {1: 15, 2: 10}
    assert {r["company_id"]: r["status"] for r in c.run_log.collect()} == {1: "completed", 2: "failed"}
    assert {r["posting_url"]: r["job_status"] for r in c.state.collect()}["http://B"] == "active"


def test_cycle_policies_reject_with_a_reason(spark):
    before = state(spark, row(1, 1, "http://known"), row(2, 1, "http://away"))
    places = {"http://known": "Tulsa", "http://away": "Austin", "http://n1": "Tulsa", "http://n2": "Tulsa", "http://n3": "Tulsa", "http://n4": None}
    feed = spark.createDataFrame([(1, "Welder", u, "board", p) for u, p in places.items()],
                                 "company_id bigint, job_title string, posting_url string, source_job_board string, place string")

    def enrich(new):
        return new.withColumn("job_description", F.when(F.col("posting_url") == "http://n1", "short").otherwise("a long text about the job"))

    c = cycle.run_cycle(before, feed, companies(spark, c1=at(10)), NOW, enrich=enrich, served=F.col("place") == "Tulsa", fetch_limit=2, minimum_text=10)
    assert {r["posting_url"]: r["violations"] for r in c.rejected.collect()} == {
        "http://away": ["not_served"], "http://n4": ["not_served"], "http://n3": ["deferred"], "http://n1": ["short_content"]}
    assert {r["posting_url"]: r["job_status"] for r in c.state.collect()} == {"http://known": "active", "http://away": "closed", "http://n2": "active"}
    log = c.run_log.collect()[0]
    assert (log["jobs_added"], log["jobs_updated"], log["jobs_skipped"]) == (1, 1, 4)


def test_repeated_stored_url_touches_the_last_row(spark):
    before = state(spark, row(1, 1, "A"), row(2, 1, "A"), row(3, 1, ""), row(4, 1, None))
    incoming = spark.createDataFrame([(1, "A", 5), (1, "A", 6), (1, "", 7)], "company_id bigint, posting_url string, pos int")
    staged = M.merge_snapshot(before, incoming, companies(spark, c1=None), NOW, feed_order=["pos"])
    assert sorted((r["id"], r["action"]) for r in staged.collect()) == [(1, "kept"), (2, "touched"), (3, "kept"), (4, "kept")]


def random_world(spark, seed):
    rng = random.Random(seed)
    rows = [row(i, rng.randint(1, 4), f"u{i}", rng.choice(["active", "closed", "draft"]), rng.randint(1, 14)) for i in range(1, 120)]
    urls = [f"u{rng.randint(1, 160)}" for _ in range(90)]
    incoming = [(rng.randint(1, 4), u, n) for n, u in enumerate(urls)]
    done = companies(spark, c1=at(7), c2=at(9), c3=None, c4=at(14))
    return rows, incoming, done


def brute_merge(rows, incoming, cutoffs):
    """Row-at-a-time merge: the behaviour the set-wise form must have."""
    world = {r[0]: dict(zip(("id", "company", "url", "title", "status", "approved", "closed", "scraped", "created", "updated"), r)) for r in rows}
    now = dt.datetime(2024, 6, 15, 12)
    inserted, first = set(), {}
    for company, url, _ in incoming:
        first.setdefault(url, company)
    for url, company in first.items():
        hits = [r for r in world.values() if r["url"] == url]
        if hits:
            max(hits, key=lambda r: r["id"])["updated"] = now
        else:
            inserted.add((company, url))
    for company in {c for c, _, _ in incoming}:
        cut = cutoffs[company]
        for r in world.values():
            if cut and r["company"] == company and r["status"] != "closed" and r["updated"] < cut:
                r["status"], r["closed"] = "closed", now.date()
    return {(r["company"], r["url"], r["status"], r["closed"]) for r in world.values()} | {(c, u, "active", None) for c, u in inserted}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_against_row_at_a_time(spark, seed):
    rows, incoming, done = random_world(spark, seed)
    cutoffs = {1: at(7), 2: at(9), 3: None, 4: at(14)}
    feed = spark.createDataFrame(incoming, "company_id bigint, posting_url string, pos int")
    staged = M.merge_snapshot(state(spark, *rows), feed, done, NOW, feed_order=["pos"])
    got = {(r["company_id"], r["posting_url"], r["job_status"], r["date_closed"]) for r in staged.collect()}
    assert got == brute_merge(rows, incoming, cutoffs)


def test_merge_invariants(spark):
    rows, incoming, done = random_world(spark, 4)
    feed = spark.createDataFrame(incoming, "company_id bigint, posting_url string, pos int")
    once = M.next_table(M.merge_snapshot(state(spark, *rows), feed, done, NOW, feed_order=["pos"]))
    ids = [r["id"] for r in once.collect()]
    assert len(ids) == len(set(ids))
    again = M.merge_snapshot(once, feed, done, NOW, feed_order=["pos"])
    counts = {r["action"]: r["n"] for r in M.change_counts(again).collect()}
    # the same snapshot again inserts nothing, closes nothing and changes no row
    assert "inserted" not in counts and "closed" not in counts
    assert sorted(M.next_table(again).select(*once.columns).collect(), key=lambda r: r["id"]) == sorted(once.collect(), key=lambda r: r["id"])


def test_stale_variants(spark):
    s = state(spark, row(1, 1, "a", updated=1), row(2, 1, "b", updated=9), row(3, 1, "c", "draft", 1), row(4, 1, "d", "closed", 1))
    c = companies(spark, c1=None)

    def run(**kw):
        return {r["id"]: (r["job_status"], r["date_closed"]) for r in M.close_stale(s, c, NOW, **kw).collect()}

    today = dt.date(2024, 6, 15)
    assert run(rule=M.stale_after_days(NOW, 7), status="expired", active_only=True) == {1: ("expired", today), 2: ("active", None), 3: ("draft", None), 4: ("closed", None)}
    assert run(rule=M.stale_since_start("2024-06-05 00:00:00"), active_only=True)[1] == ("closed", today)
    assert run(rule=M.stale_before_today(NOW), active_only=True, dated=False) == {1: ("closed", None), 2: ("closed", None), 3: ("draft", None), 4: ("closed", None)}


def test_reopen_and_patch(spark):
    s = state(spark, row(1, 1, "a", "closed", closed=dt.date(2024, 6, 3)), row(2, 1, "b", "closed", closed=dt.date(2024, 6, 1)), row(3, 2, "c", "closed", closed=dt.date(2024, 6, 9)))
    out = M.reopen(s, spark.createDataFrame([(1,)], "company_id bigint"), "2024-06-02", NOW)
    assert {r["id"]: (r["job_status"], r["date_closed"], r["reopened"]) for r in out.collect()} == {
        1: ("active", None, True), 2: ("closed", dt.date(2024, 6, 1), False), 3: ("closed", dt.date(2024, 6, 9), False)}
    patch = spark.createDataFrame([(1, "", None), (2, "new", "closed")], "id bigint, job_title string, job_status string")
    got = {r["id"]: (r["job_title"], r["job_status"], r["updated_at"].day) for r in M.patch_rows(s, patch, NOW).collect()}
    assert got == {1: ("t1", "closed", 15), 2: ("new", "closed", 15), 3: ("t3", "closed", 1)}
    assert M.patch_rows(s, patch.select("id"), NOW) is s


def test_recompute_touches_open_rows_only(spark):
    s = state(spark, row(1, 1, "a"), row(2, 1, "b", "closed")).withColumn("function", F.lit("Legal")).withColumn("job_title", F.lit("Cook"))
    got = {r["id"]: r["function"] for r in M.recompute(s, {"function": C.function_name("job_title")}, NOW).collect()}
    assert got == {1: "Other", 2: "Legal"}


# --- dimensions -------------------------------------------------------------

def brute_slugs(names, stored):
    """What creating the names one after the other gives, up to which name gets which suffix."""
    import re

    used, out = set(stored), []
    for base in sorted(re.sub("[^a-z0-9]+", "-", n.lower()).strip("-") for n in names):
        slug, k = base, 0
        while slug in used:
            k += 1
            slug = f"{base}-{k}"
        used.add(slug)
        out.append(slug)
    return sorted(out)


@pytest.mark.parametrize("names, stored", [
    (["Acme", "ACME", "acme.", "Other"], ["acme-1", "acme-3"]),
    (["Acme"], []),
    (["Acme", "acme!"], ["acme"]),
    ([f"Hot{'.' * i}" for i in range(40)] + ["Cold"], ["hot", "hot-5", "hot-7", "hot-100"]),
])
def test_slugs_against_one_by_one(spark, names, stored):
    new = spark.createDataFrame([(n,) for n in names], "common_name string")
    old = spark.createDataFrame([(i, s) for i, s in enumerate(stored)], "id bigint, slug string")
    got = sorted(r["slug"] for r in dims.unique_slugs(new, old).collect())
    assert got == brute_slugs(names, stored)


def test_companies(spark):
    stored = spark.createDataFrame([(4, "acme", "Acme")], "id bigint, slug string, common_name string")
    wanted = spark.createDataFrame([("Acme", None), ("ACME", None), ("ACME", None), ("Zed", "Startup"), ("Bad", "Guild")], "common_name string, company_type_name string")
    wanted = wanted.withColumns({"website": F.lit("w"), "jobboard": F.lit(None).cast("string")})
    types = spark.createDataFrame([(1, "Private Company"), (2, "Startup")], "id int, name string")
    made, bad = dims.get_or_create_companies(stored, wanted, types, NOW)
    rows = {r["common_name"]: r for r in made.collect()}
    assert {n: (r["slug"], r["company_type"], r["approved"], r["is_scraped"]) for n, r in rows.items()} == {"ACME": ("acme-1", 1, True, True), "Zed": ("zed", 2, True, True)}
    assert sorted(r["id"] for r in rows.values()) == [5, 6]
    assert [(r["common_name"], r["reason"]) for r in bad.collect()] == [("Bad", "unknown_company_type")]


# --- deletes, defaults, quality ---------------------------------------------

def test_deletes(spark):
    s = state(spark, row(1, 1, "a"), row(2, 2, "b")).withColumn("approved", F.col("id") == 2)
    stays, goes = Del.delete_pending(s)
    assert [r["id"] for r in stays.collect()] == [2] and [r["id"] for r in goes.collect()] == [1]
    links = spark.createDataFrame([(1, 9), (2, 9), (None, 9)], "job_listing_id bigint, x int")
    left, gone = Del.cascade(links, goes, "job_listing_id")
    assert sorted(r["job_listing_id"] or 0 for r in left.collect()) == [0, 2] and gone.count() == 1
    assert sorted(r["job_listing_id"] or 0 for r in Del.set_null(links, goes, "job_listing_id").collect()) == [0, 0, 2]
    empty, all_rows = Del.delete_all(s)
    assert empty.count() == 0 and all_rows.count() == 2


def test_defaults(spark):
    df = spark.createDataFrame([("a", "", None), (None, "draft", True)], "job_title string, job_status string, approved boolean")
    rows = tables.with_defaults(df).collect()
    assert [(r["job_title"], r["job_status"], r["approved"], r["bachelors_degree"]) for r in rows] == [("a", "active", False, "not_mentioned"), (None, "draft", True, "not_mentioned")]
    canonical = tables.to_canonical(tables.with_defaults(df))
    assert len(canonical.columns) == 57 and canonical.schema["minimum_salary"].dataType.simpleString() == "decimal(10,2)"


def test_null_passes_a_rule(spark):
    df = spark.createDataFrame([(None, None), ("ftp://x", -1.0), ("HTTPS://x", 2.0)], "posting_url string, minimum_salary double")
    rules = [Q.http_url("posting_url"), Q.positive("minimum_salary")]
    good, bad = Q.split_by_quality(df, rules)
    assert good.count() == 2
    assert [r["violations"] for r in bad.collect()] == [["posting_url_http", "minimum_salary_positive"]]
    assert {r["rule"]: r["violations"] for r in Q.violation_counts(df, rules, "t").collect()} == {"posting_url_http": 1, "minimum_salary_positive": 1}


def test_every_listing_rule_runs_on_the_canonical_columns(spark):
    canonical = tables.to_canonical(tables.with_defaults(spark.createDataFrame([("T",)], "job_title string")))
    rules = Q.listing_rules(canonical.columns)
    assert len(rules) == 21
    good, _ = Q.split_by_quality(canonical, rules)
    assert good.count() == 1


@pytest.mark.parametrize("table, ddl, good, bad", [
    ("company", "common_name string, date_founded date, date_closed date", ("a", dt.date(2020, 1, 1), dt.date(2021, 1, 1)), (" ", dt.date(2020, 1, 1), dt.date(2020, 1, 1))),
    ("company_socials", "company_url string", ("https://a",), ("https://a b",)),
    ("user_company_roles", "role string", ("job_poster",), ("boss",)),
    ("joblistingskills", "proficiency_level string, confidence_score double", ("expert", None), ("expert", 1.5)),
    ("user_certifications", "obtained_date date, expiry_date date", (dt.date(2020, 1, 1), None), (dt.date(2020, 1, 1), dt.date(2020, 1, 1))),
    ("applications", "status string", ("hired",), ("gone",)),
    ("scrapinglog", "status string, jobs_found int, jobs_added int, jobs_updated int, jobs_skipped int", ("completed", 3, 1, 1, 1), ("completed", 2, 1, 1, 1)),
    ("companysite", "employee_count int", (0,), (-1,)),
])
def test_rules_of_other_tables(spark, table, ddl, good, bad):
    df = spark.createDataFrame([good, bad], ddl)
    valid, rejected = Q.split_by_quality(df, Q.table_rules(table, df.columns))
    assert [tuple(r) for r in valid.collect()] == [good] and rejected.count() == 1


# --- views and audit --------------------------------------------------------

def test_skill_demand_counts_inactive_listings_unless_asked(spark):
    skills = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 9)], "id int, name string, skill_category_id int")
    cats = spark.createDataFrame([(1, "x")], "id int, name string")
    links = spark.createDataFrame([(10, 1, True, False), (11, 1, False, True), (11, 2, True, True)], "job_listing_id bigint, skill_id int, required_skill boolean, preferred_skill boolean")
    jobs = state(spark, row(10, 1, "u")).withColumn("approved", F.lit(True))
    assert [tuple(r) for r in views.skill_demand(skills, cats, links).collect()] == [(1, "a", "x", 2, 1, 1), (2, "b", None, 1, 1, 1), (3, "c", None, 0, 0, 0)]
    assert [tuple(r) for r in views.skill_demand(skills, cats, links, jobs).collect()] == [(1, "a", "x", 1, 1, 0), (2, "b", None, 0, 0, 0), (3, "c", None, 0, 0, 0)]


def test_name_audit(spark):
    used = spark.createDataFrame([("f", "A", f"p{i}") for i in range(5)] + [("f", "B", "p9"), ("f", "B", "p9")], "table_name string, name string, place string")
    real = spark.createDataFrame([("f", "A"), ("f", "C")], "table_name string, name string")
    got = {r["name"]: (r["marker"], r["places"], r["shown"]) for r in audit.name_audit(used, real).collect()}
    assert got == {"A": ("OK", 5, "p0, p1, p2, +2 more"), "B": ("MISMATCH", 1, "p9"), "C": ("unused", 0, None)}
    assert [tuple(r) for r in audit.mismatch_totals(audit.name_audit(used, real)).collect()] == [("f", 2, 1, 1)]


# --- cycle ------------------------------------------------------------------

def test_full_cycle(spark):
    before = state(spark, row(1, 1, "http://A"), row(2, 1, "http://B"), row(3, 2, "http://Z"))
    feed = spark.createDataFrame(
        [(1, "http://A", "a", 1), (1, "http://D", "Welder", 2), (1, "http://D", "again", 3), (1, "http://E", " ", 4), (1, "", "no url", 5), (1, "ftp://F", "f", 6)],
        "company_id bigint, posting_url string, job_title string, pos int").withColumn("source_job_board", F.lit("board"))
    calls = []

    def enrich(new):
        calls.append(new.columns)
        return new.withColumn("job_description", F.concat(F.lit("about "), "job_title"))

    done = companies(spark, c1=at(10), c2=at(10))
    c = cycle.run_cycle(before, feed, done, NOW, enrich=enrich, feed_order=["pos"], started="2024-06-15 11:00:00")
    assert {r["posting_url"]: r["job_status"] for r in c.state.collect()} == {"http://A": "active", "http://B": "closed", "http://Z": "active", "http://D": "active"}
    assert [(r["id"], r["posting_url"], r["job_title"], r["job_description"]) for r in c.content.collect()] == [(4, "http://D", "Welder", "about Welder")]
    log = c.run_log.collect()[0]
    assert (log["jobs_found"], log["jobs_added"], log["jobs_updated"], log["jobs_skipped"], log["duration_seconds"]) == (6, 1, 2, 3, 3600)
    assert log["errors"] == {"job_title_not_blank": 1, "posting_url_missing": 1, "posting_url_http": 1}
    assert sorted((r["posting_url"], r["action"]) for r in c.changes.collect()) == [("http://A", "touched"), ("http://B", "closed"), ("http://D", "inserted")]
    assert {r["id"]: r["last_full_scrape_completed"].day for r in c.companies.collect()} == {1: 15, 2: 10}
    assert c.rejected.count() == 3
    assert calls


def test_reader_and_writer_round_trip(spark, tmp_path):
    from vacancia.sources import feeds
    from vacancia import schema as S
    import json

    doc = {"total": 2, "offset": 0, "jobPostings": [{"title": "Welder", "externalPath": "/job/1", "postedOn": "Posted Today", "extra": 1}, {"title": "x"}]}
    (tmp_path / "p1.json").write_text(json.dumps(doc) + "\n")
    rows = feeds.read_workday(feeds.read_documents(spark, str(tmp_path / "p1.json"), S.FEED_WORKDAY)).collect()
    assert [(r["total"], r["pos"], r["title"], r["externalPath"]) for r in rows] == [(2, 0, "Welder", "/job/1"), (2, 1, "x", None)]
    (tmp_path / "list.json").write_text(json.dumps([{"id": "a", "text": "t", "createdAt": 0}, {"id": "b", "categories": {"team": "x"}}], indent=1))
    rows = feeds.read_documents(spark, str(tmp_path / "list.json"), S.FEED_LEVER, multi_line=True).collect()
    assert [(r["id"], r["categories"] and r["categories"]["team"]) for r in rows] == [("a", None), ("b", "x")]
    (tmp_path / "files").mkdir()
    (tmp_path / "files" / "a.bin").write_bytes(b"%PDF-1.4 x")
    (tmp_path / "files" / "b.pdf").write_bytes(b"PK\x03\x04")
    kinds = {r["path"].rsplit("/", 1)[1]: r["kind"] for r in feeds.read_binary_kinds(spark, str(tmp_path / "files")).collect()}
    assert kinds == {"a.bin": "pdf", "b.pdf": "docx"}
    out = str(tmp_path / "listings")
    s = state(spark, row(1, 1, "a"), row(2, 65, "b"), row(3, 2, "c"))
    tables.write_listings(s, out)
    tables.write_listings(state(spark, row(9, 1, "z")), out, 1)  # only company 1
    assert sorted(r["id"] for r in tables.read_listings(spark, out).collect()) == [2, 3, 9]
    one = tables.read_listings(spark, out, 2)
    assert [r["id"] for r in one.collect()] == [3]
    assert "PushedFilters: [IsNotNull(company_id), EqualTo(company_id,2)]" in plan_of(one)
    tables.write_dry_run(s, str(tmp_path / "dry"), limit=2)
    assert spark.read.json(str(tmp_path / "dry")).count() == 2
    log = spark.createDataFrame([(1,)], "x int")
    tables.append_run_log(log, str(tmp_path / "log"))
    tables.append_run_log(log, str(tmp_path / "log"))
    assert spark.read.parquet(str(tmp_path / "log")).count() == 2


def test_bucketed_table_is_not_shuffled_again(spark):
    tables.save_bucketed(spark.range(1000).select("id", F.col("id").alias("x")), "bucketed_listings", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("bucketed_listings").join(spark.range(50).withColumnRenamed("id", "i"), F.col("id") == F.col("i"), "left")
        assert plan_of(joined).count("Exchange") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE bucketed_listings")


# --- adapters ---------------------------------------------------------------

def test_icims_card(spark):
    from vacancia.sources import adapters as A

    cards = [
        '<a href="https://i/1" title="7 - Cook" class="x iCIMS_Anchor"><h3> Web <b>Lead</b></h3></a><span>Job Locations</span><span>Tulsa, OK</span>',
        '<a class="iCIMS_Anchor" title="12 - Line Cook" href="https://i/2?a=1"><img></a><dl><dt>Category</dt><dd>Sales</dd></dl>',
        '<a class="iCIMS_Anchor" title="" href="https://i/3"></a>', '<a href="https://i/4">plain</a>', '<a class="iCIMS_Anchor">no target</a>',
    ]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cards)], "i int, html string")
    got = [tuple(r) for r in A.icims(df, carry=["i"]).orderBy("i").collect()]
    assert got == [
        (0, "Web Lead", "https://i/1?in_iframe=1", "Tulsa, OK", None, "Tulsa", "Information Technology"),
        (1, "Line Cook", "https://i/2?a=1&in_iframe=1", None, "Sales", None, "Sales")]


def test_thin_postings_are_split_by_source(spark):
    from vacancia.sources import adapters as A

    df = spark.createDataFrame([("x" * n,) for n in (49, 50, 99, 100, 200)] + [(None,)], "job_description string")
    assert [A.split_thin(df, s)[0].count() for s in ("lever", "workday", "icims")] == [4, 2, 1]
    assert {r["reason"] for r in A.split_thin(df, "icims")[1].collect()} == {"short_content"}


def test_feed_dates_and_urls(spark):
    from vacancia.sources import adapters as A, feeds
    from vacancia import schema as S
    import json

    docs = spark.createDataFrame([(json.dumps({"jobRequisitions": [
        {"requisitionTitle": "Clerk", "postDate": "2024-06-01T00:00:00Z", "customFieldGroup": {"stringFields": [
            {"nameCode": {"codeValue": "Other"}, "stringValue": "z"}, {"nameCode": {"codeValue": "ExternalJobID"}, "stringValue": "77"}]},
         "payGradeRange": {"minimumRate": {"amountValue": 15.5}},
         "requisitionLocations": [{"address": {"cityName": "Dallas"}}, {"nameCode": {"shortName": "Tulsa yard"}}]},
        {"requisitionTitle": "No id"}]}),)], "doc string")
    got = A.adp(feeds.read_adp(feeds.parse_documents(docs, "doc", S.FEED_ADP)), "https://b?x=1").collect()
    assert len(got) == 1
    r = got[0]
    assert (r["external_job_id"], r["posting_url"], r["date_posted"], float(r["minimum_salary"]), r["maximum_salary"], r["city_name"]) == (
        "77", "https://b?x=1&jobId=77", dt.date(2024, 6, 1), 15.5, None, "Tulsa")
    opening = spark.createDataFrame([("Nurse", "p1", "Finance", "1 Main St, Jenks, OK 74104", "OK")], "title string, to_param string, location_name string, location_address string, location_state_code string")
    opening = opening.withColumns({"id": F.lit("9"), "job_type": F.lit("Full Time"), "text": F.lit("Grade: H-5 ($12.37 - $15.69)\nLast Revised Date: June 2025 " + "x" * 80)})
    f = A.fountain(opening, "https://f/opening", "District", NOW, description=F.col("text")).collect()[0]
    assert (f["posting_url"], f["city_name"], f["address1"], f["date_posted"], float(f["maximum_salary"]), f["pay_frequency"], f["job_type"]) == (
        "https://f/opening/p1?brand_id=all", "Jenks", "1 Main St", dt.date(2025, 6, 1), 15.69, "hourly", "Full-time")
    assert f["job_description"].startswith("Grade")
    short = A.fountain(opening.drop("text"), "https://f/opening", "District", NOW).collect()[0]
    assert short["job_description"] == "Nurse — Finance. See full details and apply at https://f/opening/p1?brand_id=all."
    assert short["date_posted"] == dt.date(2024, 6, 15)


# --- session ----------------------------------------------------------------

def test_exchanges_are_sized_by_bytes():
    from vacancia.session import sized_for

    assert sized_for(1 << 40)["spark.sql.shuffle.partitions"] == "8192"
    assert sized_for(1)["spark.sql.shuffle.partitions"] == "200"


def test_saved_results_go_to_the_named_folder(spark, tmp_path):
    from vacancia.session import materialise, shared_folder

    out = materialise(spark.range(5), "five")
    assert out.count() == 5 and out.inputFiles()[0].split(":", 1)[1].replace("//", "").startswith(shared_folder(spark))
