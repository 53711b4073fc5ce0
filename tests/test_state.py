"""The state in place: which files a cycle writes, what moves, and what a dead run leaves."""

import re
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from vacancia.operators import merge as M
from vacancia.plans.cycle import commit_in_place, run_cycle
from vacancia.sources import state as St
from vacancia.sources.tables import current_version, read_appended

COLUMNS = ("id BIGINT, company_id BIGINT, posting_url STRING, job_status STRING, date_closed DATE, "
           "last_scraped TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ")
NOW = "2024-06-15 12:00:00"


def rows(spark, companies, each):
    old = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return spark.range(companies * each).select(
        (F.col("id") + 1).alias("id"), (F.col("id") % companies).alias("company_id"), F.concat(F.lit("http://u"), "id").alias("posting_url"),
        F.lit("active").alias("job_status"), F.lit(None).cast("date").alias("date_closed"),
        *[old.alias(c) for c in ("last_scraped", "created_at", "updated_at")])


def companies(spark, n):
    return spark.range(n).select("id", F.lit("2024-05-01 00:00:00").cast("timestamp_ntz").alias("last_full_scrape_completed"))


def feed_of(spark, company, urls):
    return spark.createDataFrame([(company, f"http://{u}", "board", f"Job {u}") for u in urls], "company_id bigint, posting_url string, source_job_board string, job_title string")


@pytest.fixture
def stored(spark):
    root, layout = tempfile.mkdtemp(prefix="vacancia-state-"), St.Layout(f"state_{uuid.uuid4().hex}", parts=64, buckets=4)
    St.commit_parts(spark, root, layout, rows(spark, 1000, 20))
    return root, layout


def files(spark, root, layout):
    return set(St.read_state(spark, root, layout, COLUMNS).inputFiles())


def test_a_cycle_of_one_company_in_a_thousand_rewrites_few_files(spark, stored):
    root, layout = stored
    before = files(spark, root, layout)
    whole = {r.id: r for r in St.read_state(spark, root, layout, COLUMNS).collect()}
    assert len(before) == 64 * 4 and len(whole) == 20_000
    # company 7 lists one of its postings again, and a new one
    cycle = run_cycle(St.read_state(spark, root, layout, COLUMNS), feed_of(spark, 7, ["u7", "new"]), companies(spark, 1000), NOW, in_place=layout.buckets)
    assert cycle.counts == {"touched": 1, "closed": 19, "inserted": 1}
    commit_in_place(spark, root, layout, cycle)
    after = files(spark, root, layout)
    assert 0 < len(after - before) < 0.05 * len(after) and len(before - after) == len(after - before)
    now = {r.id: r for r in St.read_state(spark, root, layout, COLUMNS).collect()}
    changed = {i for i in whole if now[i] != whole[i]}
    assert changed == {r.id for r in whole.values() if r.company_id == 7} and set(now) - set(whole) == {20_001}
    assert [now[i].job_status for i in sorted(changed)] == ["active"] + ["closed"] * 19
    assert read_appended(spark, root, "content").select("id", "job_title").collect() == [(20_001, "Job new")]


def test_a_cycle_in_place_is_the_cycle(spark, stored):
    root, layout = stored
    state = St.read_state(spark, root, layout, COLUMNS)
    feed = feed_of(spark, 3, ["u3", "u3", "u1003", "x", "y"]).unionByName(feed_of(spark, None, ["z", "u5"]))
    plain = run_cycle(state.drop("part"), feed, companies(spark, 1000), NOW)
    there = run_cycle(state, feed, companies(spark, 1000), NOW, in_place=layout.buckets)
    as_rows = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert as_rows(plain.state) == as_rows(there.state.drop("part"))
    assert as_rows(plain.content) == as_rows(there.content) and plain.counts == there.counts
    assert as_rows(plain.run_log.drop("id")) == as_rows(there.run_log.drop("id"))
    # a posting without a company is inserted with its content
    assert [r.posting_url for r in there.content.where("company_id IS NULL").collect()] == ["http://z"]


def ancestors(plan, node):
    """What stands above the first line of an executed plan that names ``node``."""
    lines = [x for x in plan.splitlines() if re.search(r"[A-Z]", x)]
    depth = lambda x: re.search(r"[A-Z*]", x).start()
    at = next(k for k, x in enumerate(lines) if re.search(node, x))
    above, level = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < level:
            above.append(x)
            level = depth(x)
    return above


def joined_where_it_lies(plan, table):
    """Whether nothing is exchanged between the scan of a table and the join above it."""
    above = ancestors(plan, f"FileScan parquet .*{table}")
    first = next(k for k, x in enumerate(above) if "Join" in x)
    return "SortMergeJoin" in above[first] and not any("Exchange" in x for x in above[:first])


def test_no_stored_row_moves(spark, stored):
    root, layout = stored
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "16KB")  # the companies of a cycle are sent, not the postings
    try:
        state = St.read_state(spark, root, layout, COLUMNS)
        feed = feed_of(spark, 7, [f"u{i}" for i in range(12_000)] + ["new"]).repartition(3)
        cycle = run_cycle(state, feed, companies(spark, 1000), NOW, in_place=layout.buckets)
        plan = cycle.state.where("job_status = 'active'")._jdf.queryExecution().executedPlan().toString()
        assert joined_where_it_lies(plan, layout.table)
        assert not any("Exchange" in x for x in ancestors(plan, f"FileScan parquet .*{layout.table}"))
        match = M.match_snapshot(state, feed, in_place=layout.buckets)._jdf.queryExecution().executedPlan().toString()
        assert joined_where_it_lies(match, layout.table)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_run_that_dies_leaves_the_state_as_it_was(spark, stored, monkeypatch):
    root, layout = stored
    before, version = files(spark, root, layout), current_version(spark, root)

    def dies(*args, **kwargs):
        raise RuntimeError("lost driver")

    changed = rows(spark, 1000, 20).where("id = 8").withColumn("job_status", F.lit("closed"))
    monkeypatch.setattr(St, "commit_tables", dies)
    with pytest.raises(RuntimeError):
        St.commit_parts(spark, root, layout, changed)
    monkeypatch.undo()
    assert files(spark, root, layout) == before and current_version(spark, root) == version
    St.commit_parts(spark, root, layout, changed)
    state = St.read_state(spark, root, layout, COLUMNS)
    assert state.count() == 20_000 and [r.id for r in state.where("job_status = 'closed'").collect()] == [8]


def test_another_session_finds_the_parts(spark, stored):
    root, layout = stored
    other = spark.newSession()
    again = St.Layout(f"state_{uuid.uuid4().hex}", layout.parts, layout.buckets)
    assert St.read_state(other, root, again, COLUMNS).count() == 20_000


def test_a_state_that_never_was_written_is_empty(spark):
    layout = St.Layout(f"state_{uuid.uuid4().hex}")
    assert St.read_state(spark, tempfile.mkdtemp(prefix="vacancia-state-"), layout, COLUMNS).count() == 0
