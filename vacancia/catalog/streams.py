"""The streaming jobs over the whole ``events`` table, each run to the end of what landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vacancia.catalog.registry import Tables, day_text, query
from vacancia.operators.merge import merge_snapshot
from vacancia.session import scratch_path
from vacancia.streaming import jobs

MICROS = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def landed_events(t: Tables) -> DataFrame:
    # a pattern, because the table may be one file or a folder of files
    return jobs.landed_stream(t.spark, f"{t.folder}/[e]vents.parquet", t("events").schema)


def events_stream(t: Tables) -> DataFrame:
    stream = landed_events(t)
    return stream.withColumn("seen_at", F.col("ts").cast("timestamp"))


STATE = ("id BIGINT, company_id BIGINT, posting_url STRING, job_status STRING, date_closed DATE, "
         "last_scraped TIMESTAMP_NTZ, created_at TIMESTAMP_NTZ, updated_at TIMESTAMP_NTZ")
CYCLES = 4  # snapshots that the events land in; cycle k is on day k + 1


def _land(t: Tables, root: str, k: int) -> str:
    """A cycle's snapshot in a folder of its own: the postings with an event in it, some of them twice."""
    rows = t("events").where(F.col("event_id") % CYCLES == k).select(
        (F.col("user_id") % 7).cast("bigint").alias("company_id"), F.concat(F.lit("https://e.example.com/"), F.col("user_id").cast("string")).alias("posting_url"),
        F.lit(k).alias("cycle"))
    rows.write.parquet(f"{root}/landed/cycle-{k}")
    return f"{root}/landed/cycle-*"


def _merge_cycle(before: DataFrame, batch: DataFrame, batch_id: int) -> DataFrame:
    """M1 over one snapshot: what a company's cycle does not list again is closed."""
    day = f"2002-01-{batch_id + 1:02d}"
    done = batch.select(F.col("company_id").alias("id")).distinct().withColumn(
        "last_full_scrape_completed", F.lit(f"{day} 00:00:00").cast("timestamp_ntz"))
    return merge_snapshot(before, batch.select("company_id", "posting_url"), done, f"{day} 12:00:00")


@query("stream_merge", f"""
    WITH seen AS (SELECT DISTINCT user_id, user_id % 7 AS company_id, event_id % {CYCLES} AS k FROM events),
    held AS (SELECT DISTINCT company_id, k FROM seen),
    born AS (SELECT user_id, company_id, min(k) AS first_k, max(k) AS last_k FROM seen GROUP BY 1, 2),
    missed AS (SELECT user_id, min(h.k) AS closed_k FROM born b JOIN held h ON h.company_id = b.company_id AND h.k > b.first_k
               WHERE NOT EXISTS (SELECT 1 FROM seen s WHERE s.user_id = b.user_id AND s.k = h.k) GROUP BY 1)
    SELECT 'https://e.example.com/' || user_id AS posting_url, CASE WHEN closed_k IS NULL THEN 'active' ELSE 'closed' END AS job_status,
           strftime(DATE '2002-01-01' + CAST(closed_k AS INTEGER), '%Y-%m-%d') AS date_closed,
           strftime(DATE '2002-01-01' + CAST(last_k AS INTEGER), '%Y-%m-%d') AS last_seen
    FROM born LEFT JOIN missed USING (user_id)
""")
def stream_merge(t: Tables) -> DataFrame:
    spark, root = t.spark, scratch_path(t.spark, "stream-merge")
    # the stream runs when a snapshot has landed, and takes all its files as one batch; the last run finds nothing new
    for k in range(CYCLES + 1):
        landed = _land(t, root, k) if k < CYCLES else f"{root}/landed/cycle-*"
        source = jobs.landed_stream(spark, landed, spark.read.parquet(f"{root}/landed/cycle-0").schema)
        jobs.merge_snapshots(source, root, STATE, _merge_cycle, compact_every=3).awaitTermination()
    state = jobs.stream_state(spark, root, STATE, compact_every=3)
    return state.select("posting_url", "job_status", day_text("date_closed").alias("date_closed"), day_text("last_scraped").alias("last_seen"))


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(t: Tables) -> DataFrame:
    postings = events_stream(t).select("user_id", "event_type", "seen_at")
    out = jobs.run_to_table(jobs.drop_repeated(postings, ["user_id", "event_type"], "seen_at", "60 days"), "stream-dedup")
    return out.select("user_id", "event_type")


_SESSIONS = """
    WITH e AS (SELECT user_id || '-' || event_type AS posting, ts, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts) AS prev FROM events),
    s AS (SELECT posting, ts, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 3 DAY THEN 1 ELSE 0 END)
                 OVER (PARTITION BY posting ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM e),
    x AS (SELECT posting, min(ts) AS first_seen, max(ts) AS last_seen, max(ts) + INTERVAL 3 DAY AS expires_at, count(*) AS sightings FROM s GROUP BY posting, g)
    SELECT posting, strftime(first_seen, '%Y-%m-%d %H:%M:%S.%f') AS first_seen, strftime(last_seen, '%Y-%m-%d %H:%M:%S.%f') AS last_seen,
           strftime(expires_at, '%Y-%m-%d %H:%M:%S.%f') AS expires_at, sightings FROM x
"""


def _sessions_text(df: DataFrame) -> DataFrame:
    return df.select("posting", *[F.date_format(c, MICROS).alias(c) for c in ("first_seen", "last_seen", "expires_at")], "sightings")


def _posting() -> F.Column:
    return F.concat(F.col("user_id").cast("string"), F.lit("-"), "event_type").alias("posting")


@query("sighting_spans", _SESSIONS)
def sighting_spans(t: Tables) -> DataFrame:
    sightings = t("events").select(_posting(), F.col("ts").cast("timestamp").alias("seen_at"))
    return _sessions_text(jobs.expired_postings(sightings, "posting", "seen_at", days=3))


@query("stream_expire", _SESSIONS + " WHERE expires_at <= (SELECT max(ts) FROM events)")
def stream_expire(t: Tables) -> DataFrame:
    sightings = events_stream(t).select(_posting(), "seen_at")
    return _sessions_text(jobs.run_to_table(jobs.expired_postings(sightings, "posting", "seen_at", days=3), "stream-expire"))
