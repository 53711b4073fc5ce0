"""Streams against the batch form of the same job."""

import datetime as dt

from pyspark.sql import functions as F

from vacancia.operators import merge as M
from vacancia.streaming import jobs


def land(spark, folder, batches, ddl):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("overwrite").parquet(f"{folder}/b{i}")
    return f"{folder}/b*"


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def test_merge_stream_equals_batch_merges(spark, tmp_path):
    ddl = "company_id bigint, posting_url string, cycle int"
    cycles = [[(1, "a", 0), (1, "b", 0)], [(1, "b", 1), (1, "c", 1)], [(1, "c", 2), (2, "z", 2)]]
    state_ddl = "id bigint, company_id bigint, posting_url string, job_status string, date_closed date, last_scraped timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"
    companies = spark.createDataFrame([(1, dt.datetime(2030, 1, 1)), (2, None)], "id bigint, last_full_scrape_completed timestamp_ntz")

    def step(before, batch, n):
        # the completion lies between the cycles, so what a cycle misses is closed by it
        done = companies.withColumn("last_full_scrape_completed", F.when(F.col("id") == 1, F.lit(at(2 + n)).cast("timestamp_ntz")))
        return M.next_table(M.merge_snapshot(before, batch.select("company_id", "posting_url"), done, at(2 + n, 12)))

    path = land(spark, tmp_path / "in", cycles, ddl)
    root = str(tmp_path / "state")

    def apply(batch, batch_id):
        cycle = batch.agg(F.min("cycle")).first()[0]
        before = spark.read.schema(state_ddl).parquet(f"{root}/v{batch_id - 1}") if batch_id else spark.createDataFrame([], state_ddl)
        step(before, batch, cycle).write.mode("overwrite").parquet(f"{root}/v{batch_id}")

    stream = jobs.landed_stream(spark, path, ddl, files_per_batch=1)
    jobs.merge_stream(stream, apply, str(tmp_path / "cp")).awaitTermination()
    got = spark.read.schema(state_ddl).parquet(f"{root}/v2")

    want = spark.createDataFrame([], state_ddl)
    for n, rows in enumerate(cycles):
        want = step(want, spark.createDataFrame(rows, ddl), n)
    columns = ["company_id", "posting_url", "job_status", "date_closed"]
    assert sorted(map(str, got.select(*columns).collect())) == sorted(map(str, want.select(*columns).collect()))
    assert {r["posting_url"]: r["job_status"] for r in got.collect()} == {"a": "closed", "b": "closed", "c": "active", "z": "active"}


STATE = "id bigint, company_id bigint, posting_url string, job_status string, date_closed date, last_scraped timestamp_ntz, created_at timestamp_ntz, updated_at timestamp_ntz"


def test_streamed_state_is_kept_as_changes_and_survives_a_restart(spark, tmp_path):
    ddl = "company_id bigint, posting_url string"
    cycles = [[(1, "a"), (1, "b"), (2, "z")], [(1, "b"), (1, "c")], [(1, "c"), (2, "z")], [(1, "c"), (1, "d")], [(2, "y")]]
    root = str(tmp_path / "state")
    numbers = []

    def step(before, batch, n):
        numbers.append(n)
        done = spark.createDataFrame([(c, at(1 + n)) for c in (1, 2)], "id bigint, last_full_scrape_completed timestamp_ntz")
        return M.merge_snapshot(before, batch, done, at(1 + n, 12))

    def run():
        stream = jobs.landed_stream(spark, str(tmp_path / "in" / "b*"), ddl, files_per_batch=1)
        jobs.merge_snapshots(stream, root, STATE, step, compact_every=2).awaitTermination()
        return jobs.stream_state(spark, root, STATE, compact_every=2)

    (tmp_path / "in" / "b-none").mkdir(parents=True)
    assert run().count() == 0 and not numbers  # nothing landed
    want, got = spark.createDataFrame([], STATE), None
    for n, rows in enumerate(cycles):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(str(tmp_path / "in" / f"b{n}"))
        if n in (1, 2, 4):  # several snapshots land before a run
            got = run()
        done = spark.createDataFrame([(c, at(1 + n)) for c in (1, 2)], "id bigint, last_full_scrape_completed timestamp_ntz")
        want = M.next_table(M.merge_snapshot(want, spark.createDataFrame(rows, ddl), done, at(1 + n, 12)))
    assert numbers == [0, 1, 2, 3, 4]
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
    # the last batch wrote what it changed and not the whole state
    assert spark.read.parquet(f"{root}/changes/batch=4").count() < got.count()


def test_repeated_postings_are_dropped_across_batches(spark, tmp_path):
    ddl = "url string, seen_at timestamp"
    path = land(spark, tmp_path / "in", [[("a", at(1)), ("b", at(1))], [("a", at(2)), ("c", at(2))]], ddl)
    stream = jobs.landed_stream(spark, path, ddl, files_per_batch=1)
    out = jobs.run_to_table(jobs.drop_repeated(stream, ["url"], "seen_at", "30 days"), "test-dedup")
    assert sorted(r["url"] for r in out.collect()) == ["a", "b", "c"]


def test_expiry_closes_what_was_not_seen(spark, tmp_path):
    ddl = "url string, seen_at timestamp"
    batches = [[("a", at(1)), ("b", at(1))], [("a", at(5)), ("b", at(2))], [("a", at(11)), ("c", at(11))], [("c", at(20))]]
    path = land(spark, tmp_path / "in", batches, ddl)
    stream = jobs.landed_stream(spark, path, ddl, files_per_batch=1)
    got = jobs.run_to_table(jobs.expired_postings(stream, "url", "seen_at", days=7), "test-expire")
    rows = sorted((r["url"], r["last_seen"].day, r["expires_at"].day, r["sightings"]) for r in got.collect())
    # a is seen until the 11th and ends on the 18th, b on the 9th; c came back after nine days
    assert rows == [("a", 11, 18, 3), ("b", 2, 9, 2), ("c", 11, 18, 1)]
    batch = jobs.expired_postings(spark.createDataFrame([r for b in batches for r in b], ddl), "url", "seen_at", days=7)
    assert set(rows) < {(r["url"], r["last_seen"].day, r["expires_at"].day, r["sightings"]) for r in batch.collect()}
