"""Change operators on the listings table.

Each is a pure function from the stored rows and the incoming snapshot to the staged
rows, marked with what happened to them; the caller writes the result. Matching reads
only the key columns of the stored table and moves one row per URL.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vacancia.functions.dates import days_before, moment
from vacancia.operators.dedup import first_of_key, keep_first
from vacancia.operators.numbering import with_new_ids
from vacancia.session import materialise

KEPT, TOUCHED, CLOSED, INSERTED = "kept", "touched", "closed", "inserted"


def match_snapshot(current: DataFrame, incoming: DataFrame, active_only: bool = False,
                   feed_order: Sequence[str] = (), in_place: int | None = None) -> DataFrame:
    """One row per posting of the snapshot, with the stored ``id`` it matches and its ``copies``.

    By URL whatever the status, or only among the active rows of the same company. Of
    stored rows with the same key the last one is the match; of repeated postings the
    first one in feed order stays. The keys of both sides are counted in one hash
    aggregation, without any payload; a payload moves once, and only that of first postings.
    ``in_place`` is for stored rows that lie in so many buckets of their URL (``sources.state``):
    their keys are aggregated where they are, and only the snapshot moves.
    """
    has_url = F.coalesce("posting_url", F.lit("")) != ""
    keys = ["company_id", "posting_url"] if active_only else ["posting_url"]
    stored = current.where(has_url)
    if active_only:
        stored = stored.where(F.col("job_status") == "active")
    feed = incoming.where(has_url)
    if "id" in feed.columns:
        feed = feed.drop("id")
    if in_place:
        held = stored.groupBy(*[F.col(k).alias("_" + k) for k in keys]).agg(F.max("id").alias("id"))
        # dealt out as the buckets are, or Spark might deal the stored side out anew
        counted = feed.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).repartition(in_place, "posting_url")
        sizes = counted.join(held, _same(counted, held, keys), "left").select(*[counted[k].alias("_" + k) for k in keys], "id", "copies")
        return _matched(feed, sizes, keys, feed_order)
    landed = F.lit(True).alias("_landed")
    both = stored.select(*keys, F.col("id").alias("_id")).unionByName(feed.select(*keys, landed), allowMissingColumns=True)
    sizes = both.groupBy(*keys).agg(F.max("_id").alias("id"), F.count("_landed").alias("copies"))
    sizes = sizes.where(F.col("copies") > 0).select(*[F.col(k).alias("_" + k) for k in keys], "id", "copies")
    return _matched(feed, sizes, keys, feed_order)


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    """Equal keys, those of ``right`` with an underscore; a company may be NULL on both sides."""
    return reduce(lambda x, y: x & y, [left[k].eqNullSafe(right["_" + k]) if k == "company_id" else left[k] == right["_" + k] for k in keys])


def _matched(feed: DataFrame, sizes: DataFrame, keys: Sequence[str], feed_order: Sequence[str]) -> DataFrame:
    rest = [c for c in feed.columns if c not in keys]
    ties = [c for c, kind in feed.dtypes if c in rest and c not in feed_order and not kind.startswith("map")]
    first = keep_first(feed, keys, [*feed_order, *ties])
    return first.join(sizes, _same(first, sizes, keys)).select(*keys, "id", "copies", *rest)


def complete_companies(landed: DataFrame, announced: DataFrame | None = None, key: Sequence[str] = ("posting_url",),
                       unknown: bool = False, broken: DataFrame | None = None) -> DataFrame:
    """(company_id, complete): whether as many different postings landed as the source announced.

    ``landed`` is what the source sent, before any posting is filtered out; a posting that
    was sent twice counts once. Where totals are given, a company without one is not
    complete, unless ``unknown`` says so; without totals all companies that sent anything
    are. A company without any posting is not in the result, so nothing of it is closed.
    ``broken`` (company_id, ...) has the landed pages that could not be read: their companies are
    not complete, whatever else landed.
    """
    if broken is not None:
        whole = complete_companies(landed, announced, key, unknown)
        bad = broken.select("company_id").distinct().withColumn("_bad", F.lit(True))
        return whole.join(bad, "company_id", "left").select("company_id", (F.col("complete") & F.col("_bad").isNull()).alias("complete"))
    if announced is None:
        return landed.select("company_id").distinct().withColumn("complete", F.lit(True))
    counts = landed.select("company_id", *key).distinct().groupBy("company_id").agg(F.count(F.lit(1)).alias("landed"))
    totals = announced.groupBy("company_id").agg(F.max("total").alias("total"))
    joined = counts.join(totals, "company_id", "left")
    return joined.select("company_id", F.coalesce(F.col("landed") >= F.col("total"), F.lit(unknown)).alias("complete"))


def stale_before_last_cycle() -> Column:
    """Open and not touched since the previous completion; never completed closes nothing."""
    return F.coalesce(F.col("updated_at") < F.col("_cutoff"), F.lit(False))


def stale_after_days(as_of, days: int = 7) -> Column:
    return F.coalesce(F.col("last_scraped") < days_before(as_of, F.lit(days)), F.lit(False))


def stale_since_start(started) -> Column:
    unseen = F.col("last_scraped").isNull() | (F.col("last_scraped") < moment(started))
    return unseen & F.col("date_closed").isNull()


def stale_before_today(as_of) -> Column:
    return F.to_date("updated_at") < F.to_date(moment(as_of))


def closing_companies(companies: DataFrame, gate: DataFrame | None = None) -> DataFrame:
    """(company_id, _cutoff, _closing): the previous completion, and whether closing is allowed."""
    side = companies.select(
        F.col("id").alias("company_id"), F.col("last_full_scrape_completed").alias("_cutoff"))
    if gate is None:
        return side.withColumn("_closing", F.lit(True))
    return side.join(gate.select("company_id", F.col("complete").alias("_closing")), "company_id", "left")


def close_stale(listings: DataFrame, companies: DataFrame, as_of, rule: Column | None = None,
                status: str = "closed", gate: DataFrame | None = None, dated: bool = True,
                active_only: bool = False) -> DataFrame:
    """Close the rows that a rule calls stale; the ``action`` column marks them.

    Every row that is not closed is looked at, or only the active ones.

    ``companies`` gives the previous completion per company, ``gate`` the companies whose
    snapshot is complete; others are left alone.
    """
    out = listings.join(closing_companies(companies, gate), "company_id", "left")
    stale = stale_before_last_cycle() if rule is None else rule
    if gate is not None:
        stale = stale & F.coalesce("_closing", F.lit(False))
    is_open = F.col("job_status") == "active" if active_only else F.col("job_status") != "closed"
    changed = {
        "job_status": F.lit(status),
        "updated_at": moment(as_of),
        **({"date_closed": F.to_date(moment(as_of))} if dated else {}),
    }
    have = F.col("action") if "action" in listings.columns else F.lit(KEPT)
    plain = [c for c in listings.columns if c != "action"]
    marked = out.select(*plain, have.alias("action"), (stale & is_open).alias("_stale"))
    return _change(marked, "_stale", {**changed, "action": F.lit(CLOSED)})


def _change(df: DataFrame, flag: str, values: dict[str, Column]) -> DataFrame:
    """Set columns where a flag is true; the flag goes."""
    return df.select(*[
        F.when(F.col(flag), values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c)
        for c in df.columns if c != flag
    ])


def touch(current: DataFrame, matched: DataFrame, as_of) -> DataFrame:
    """Set both time stamps of the matched rows; a closed row stays closed."""
    seen = matched.where(F.col("id").isNotNull()).select("id", F.lit(True).alias("_seen"))
    out = current.join(seen, "id", "left").select(*current.columns, F.lit(KEPT).alias("action"), "_seen")
    now = moment(as_of)
    return _change(out, "_seen", {"updated_at": now, "last_scraped": now, "action": F.lit(TOUCHED)})


def staged_inserts(current: DataFrame, new: DataFrame, as_of, save: bool = True) -> DataFrame:
    """New postings with keys, defaults and time stamps, in the columns of the stored table."""
    rows = with_new_ids(new, ["company_id", "posting_url"], current, save=save)
    now = moment(as_of)
    fixed = {"created_at": now, "updated_at": now, "last_scraped": now, "approved": F.lit(False)}
    cols = []
    for name, kind in current.dtypes:
        c = F.col(name) if name in rows.columns else F.lit(None)
        if name == "job_status":
            c = F.coalesce(c, F.lit("active"))
        cols.append(fixed.get(name, c).cast(kind).alias(name))
    return rows.select(*cols, F.lit(INSERTED).alias("action"))


def _acts(current: DataFrame, matched: DataFrame, closing: DataFrame, stale: Column) -> DataFrame:
    """Stored rows with an ``action``, worked out on the few columns that decide it and joined by their id."""
    seen = matched.where(F.col("id").isNotNull()).select("id", F.lit(TOUCHED).alias("_act"))
    decisive = [c for c in ("id", "company_id", "job_status", "updated_at", "last_scraped", "date_closed")
                if c in current.columns]
    late = current.select(*decisive).where(F.col("job_status") != "closed").join(closing, "company_id")
    late = late.where(stale).select("id", F.lit(CLOSED).alias("_act"))
    acts = seen.unionByName(late).groupBy("id").agg(F.max("_act").alias("_act"))  # touched wins
    return current.join(acts, "id", "left").select(*current.columns, F.coalesce("_act", F.lit(KEPT)).alias("action"))


def _acts_in_place(current: DataFrame, matched: DataFrame, closing: DataFrame, stale: Column, buckets: int) -> DataFrame:
    """The same over rows that lie in buckets of their URL: what was seen comes to them, they do not move."""
    seen = matched.where(F.col("id").isNotNull()).groupBy(F.col("posting_url").alias("_url")).agg(F.collect_set("id").alias("_ids")).repartition(buckets, "_url")
    joined = current.join(seen, current["posting_url"] == seen["_url"], "left").join(closing, "company_id", "left")
    closes = F.col("_closing") & (F.col("job_status") != "closed") & stale
    act = F.when(F.array_contains("_ids", F.col("id")), TOUCHED).when(F.coalesce(closes, F.lit(False)), CLOSED).otherwise(KEPT)
    return joined.select(*current.columns, act.alias("action"))


def mark_stored(current: DataFrame, matched: DataFrame, closing: DataFrame, as_of,
                rule: Column | None = None, in_place: int | None = None) -> DataFrame:
    """The stored rows behind ``match_snapshot``: touched, closed or kept, as ``action`` says.

    ``closing`` is what ``closing_companies`` gives, of the companies that close. A posting that
    was seen is not closed.
    """
    stale = stale_before_last_cycle() if rule is None else rule
    joined = _acts_in_place(current, matched, closing, stale, in_place) if in_place else _acts(current, matched, closing, stale)
    now, act = moment(as_of), F.col("action")
    values = {
        "job_status": F.when(act == CLOSED, F.lit("closed")),
        "date_closed": F.when(act == CLOSED, F.to_date(now)),
        "last_scraped": F.when(act == TOUCHED, now),
        "updated_at": F.when(act != KEPT, now),
    }
    return joined.select(*[
        F.coalesce(values[c], F.col(c)).alias(c) if c in values else F.col(c) for c in joined.columns
    ])


def merge_matched(current: DataFrame, matched: DataFrame, companies: DataFrame, as_of,
                  gate: DataFrame, rule: Column | None = None, save: bool = True) -> DataFrame:
    """The merge behind ``match_snapshot``: touch, close, insert.

    What happens to a stored row is worked out on the few columns that decide it, and
    meets the whole rows in one join on their key.
    """
    kept = mark_stored(current, matched, closing_companies(companies, gate).where("_closing"), as_of, rule)
    new = matched.where(F.col("id").isNull()).drop("id", "copies")
    inserted = staged_inserts(current, new, as_of, save=save)
    return kept.unionByName(inserted.select(*kept.columns))


def merge_snapshot(current: DataFrame, incoming: DataFrame, companies: DataFrame, as_of,
                   active_only: bool = False, announced: DataFrame | None = None,
                   feed_order: Sequence[str] = (), rule: Column | None = None, save: bool = True,
                   landed: DataFrame | None = None) -> DataFrame:
    """Stored rows and new postings with an ``action``: kept, touched, closed or inserted.

    ``incoming`` is the whole current listing of the companies it names; ``landed`` is the
    same before it was filtered, if it was. ``active_only``
    matches only active rows of the company, so a returning closed posting comes in again;
    the default touches it and leaves it closed. ``save`` writes the matched snapshot to the
    shared folder once; touch, insert and numbering all read it.
    """
    matched = match_snapshot(current, incoming, active_only, feed_order)
    if save:
        matched = materialise(matched, "matched")
    gate = complete_companies(incoming if landed is None else landed, announced)
    # what was just written need not be written again to be numbered
    return merge_matched(current, matched, companies, as_of, gate, rule, save=not save)


def next_table(staged: DataFrame) -> DataFrame:
    return staged.drop("action")


def change_set(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("action") != KEPT).select("id", "company_id", "posting_url", "action")


def change_counts(staged: DataFrame) -> DataFrame:
    return staged.groupBy("action").agg(F.count(F.lit(1)).alias("n"))


def reopen(listings: DataFrame, company_ids: DataFrame, since, as_of) -> DataFrame:
    """Closed on or after a date becomes active again; ``reopened`` marks the rows."""
    side = company_ids.select("company_id").distinct().withColumn("_asked", F.lit(True))
    hit = F.col("_asked") & (F.col("job_status") == "closed") & (F.col("date_closed") >= F.lit(since).cast("date"))
    out = listings.join(side, "company_id", "left").select(
        *listings.columns, F.coalesce(hit, F.lit(False)).alias("reopened"))
    values = {"job_status": F.lit("active"), "date_closed": F.lit(None).cast("date"), "updated_at": moment(as_of)}
    return _change(out.withColumn("_hit", F.col("reopened")), "_hit", values)


def patch_rows(table: DataFrame, patch: DataFrame, as_of, key: str = "id", order: Sequence[str] = ()) -> DataFrame:
    """Fields of the patch replace stored ones; NULL and empty fields are ignored.

    ``updated_at`` is set wherever the patch has a row. A patch without fields changes
    nothing. Of several patches of one key the first in ``order`` counts.
    """
    fields = [c for c in patch.columns if c != key and c not in order]
    if not fields:
        return table
    patch = first_of_key(patch, [key], order)
    kinds = dict(patch.dtypes)
    side = patch.select(
        key, F.lit(True).alias("_hit"),
        *[(F.nullif(F.col(c), F.lit("")) if kinds[c] == "string" else F.col(c)).alias("_" + c) for c in fields],
    )
    out = table.join(side, key, "left").select(*table.columns, "_hit", *["_" + c for c in fields])
    values = {c: F.coalesce("_" + c, c) for c in fields}
    return _change(out, "_hit", {**values, "updated_at": moment(as_of)}).drop(*["_" + c for c in fields])


def overwrite_matched(current: DataFrame, incoming: DataFrame, as_of, fields: Sequence[str],
                      key: str = "posting_url", order: Sequence[str] = ()) -> DataFrame:
    """Rows that the snapshot has take all its fields, absent ones included.

    Of several postings with one key the first in ``order`` counts.
    """
    side = first_of_key(incoming.select(key, *fields, *order), [key], order).select(key, F.lit(True).alias("_hit"), *[F.col(c).alias("_" + c) for c in fields])
    out = current.join(side, key, "left").select(*current.columns, "_hit", *["_" + c for c in fields])
    now = moment(as_of)
    values = {c: F.col("_" + c) for c in fields}
    return _change(out, "_hit", {"updated_at": now, "last_scraped": now, **values}).drop(*["_" + c for c in fields])


def recompute(listings: DataFrame, derived: dict[str, Column], as_of) -> DataFrame:
    """Derived columns of the open rows again, so that a rule fix reaches known postings.

    A NULL result keeps the stored value.
    """
    out = listings.withColumns({
        "_open": F.col("job_status") != "closed", **{"_" + name: value for name, value in derived.items()}
    })
    values = {name: F.coalesce("_" + name, name) for name in derived}
    return _change(out, "_open", {**values, "updated_at": moment(as_of)}).drop(*["_" + n for n in derived])
