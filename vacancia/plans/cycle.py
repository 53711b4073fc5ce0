"""One collection cycle over all employers at once.

    adapted feed -> quality split -> known / new -> pages of the new ones
      -> merge of the state table -> stale close -> company stamp -> run log

State (key, status, time stamps) and content (texts and derived fields) are two tables.
A cycle rewrites the state and appends the content of new postings; descriptions that
are already stored are neither read nor moved.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vacancia import schema as S
from vacancia.functions.dates import moment
from vacancia.functions.text import is_long_enough
from vacancia.operators import merge as M
from vacancia.operators.dedup import defer_new_rows, first_of_key
from vacancia.operators.dims import stamp_completion
from vacancia.operators.quality import listing_rules, split_by_quality
from vacancia.plans.views import run_stats, with_duration
from vacancia.session import materialise, materialise_counted
from vacancia.sources.adapters import DETAIL_FIELDS, with_detail, workday_detail
from vacancia.sources.state import Layout, commit_parts
from vacancia.sources.tables import commit_tables, to_canonical, with_defaults


@dataclass
class Cycle:
    state: DataFrame       # next state table
    content: DataFrame     # content rows to append
    companies: DataFrame   # companies with the completion stamp
    changes: DataFrame     # what happened to which posting
    rejected: DataFrame    # postings not taken, with reasons
    run_log: DataFrame     # one row per board and company
    delta: DataFrame       # the state rows that changed or are new, with what happened to them
    counts: dict[str, int] | None = None  # changes by action, taken while they were written; None if nothing was saved


Enrich = Callable[[DataFrame], DataFrame]


def run_cycle(state: DataFrame, feed: DataFrame, companies: DataFrame, as_of, enrich: Enrich | None = None,
              announced: DataFrame | None = None, feed_order: Sequence[str] = (), active_only: bool = False,
              started=None, save: bool = True, landed: DataFrame | None = None, served: Column | None = None,
              fetch_limit: int | None = None, minimum_text: int | None = None, in_place: int | None = None,
              broken: DataFrame | None = None) -> Cycle:
    """Plan a cycle; ``feed`` holds canonical columns with company_id and source_job_board.

    ``announced`` has the totals of the sources and ``landed`` (company_id, posting_url) what
    they sent, before adapters dropped any. Only a company whose postings all landed has
    rows closed, is stamped and is logged as completed; the others are logged as failed.
    ``broken`` (company_id) are the landed pages in quarantine (``sources.feeds.split_documents``).

    ``served`` is a condition on the feed: other postings are rejected before the match, as
    if the source had not listed them. ``fetch_limit`` takes that many new postings of a
    company, in URL order, and leaves the others for the next cycle. ``minimum_text`` rejects
    new postings with a shorter description. All of them are in ``rejected``, with a reason.
    ``enrich`` adds detail-page fields and runs on new postings only. ``save`` writes the
    match, the parsed postings and the changed rows of the state to the shared folder once
    each, because several results read them; rows that are kept are not written before they are
    committed. ``in_place`` is for a state that lies in so many buckets of its URLs
    (``sources.state.read_state``): no stored row moves, and ``delta`` is all that
    ``commit_in_place`` needs.
    """

    def refused(df: DataFrame, reason: str) -> DataFrame:
        return df.withColumn("violations", F.array(F.lit(reason)))

    landed = feed if landed is None else landed
    has_url = F.coalesce(F.col("posting_url") != "", F.lit(False))
    left_out = [refused(feed.where(~has_url), "posting_url_missing")]
    if served is not None:
        inside = F.coalesce(served, F.lit(False))
        left_out.append(refused(feed.where(has_url & ~inside), "not_served"))
        feed = feed.where(inside)
    matched = M.match_snapshot(state, feed, active_only, feed_order, in_place)
    if save:
        matched = materialise(matched, "matched")

    # detail pages are parsed for the new postings only, and once
    new = matched.where(F.col("id").isNull()).drop("id", "copies")
    if fetch_limit is not None:
        new = defer_new_rows(new, F.lit(False), ["company_id"], ["posting_url"], fetch_limit)
        left_out.append(refused(new.where("deferred").drop("deferred"), "deferred"))
        new = new.where("not deferred").drop("deferred")
    new = with_defaults(new if enrich is None else enrich(new))
    if save and enrich is not None:
        new = materialise(new, "new-postings")
    good, bad = split_by_quality(new, listing_rules(new.columns))
    if minimum_text is not None:
        long_enough = is_long_enough("job_description", minimum_text)
        left_out.append(refused(good.where(~long_enough), "short_content"))
        good = good.where(long_enough)
    rejected = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [bad, *left_out])

    known = matched.where(F.col("id").isNotNull()).select("company_id", "posting_url", "id")
    wanted = [c for c in state.columns if c in good.columns and c not in ("id", "company_id", "posting_url")]
    fresh = good.select("company_id", "posting_url", *wanted)
    merged = known.unionByName(fresh, allowMissingColumns=True)
    gate = M.complete_companies(landed, announced, broken=broken)
    if save:
        gate = materialise(gate, "complete-companies")
    closing = M.closing_companies(companies, gate).where("_closing")
    if save and in_place:
        closing = materialise(closing, "closing")  # its size is known then, and it goes to the stored rows
    marked = M.mark_stored(state, merged, closing, as_of, in_place=in_place)
    # the new rows are saved already if they were parsed, and need not be written again to be numbered
    inserts = M.staged_inserts(state, merged.where(F.col("id").isNull()).drop("id"), as_of, save=save and enrich is None)
    delta, counts = marked.where(F.col("action") != M.KEPT).unionByName(inserts.select(*marked.columns)), None
    if save:
        by_action = {act: F.count_if(F.col("action") == act) for act in (M.TOUCHED, M.CLOSED, M.INSERTED)}
        delta, counts = materialise_counted(delta, "changed-state", **by_action)
    staged = marked.where(F.col("action") == M.KEPT).unionByName(delta)
    inserted = delta.where(F.col("action") == M.INSERTED).select("id", F.col("company_id").alias("_company"), F.col("posting_url").alias("_url"))
    same = good["company_id"].eqNullSafe(inserted["_company"]) & (good["posting_url"] == inserted["_url"])
    content = good.join(inserted, same).drop("_company", "_url")

    def outcome(df: DataFrame, name: str, n: Column | None = None, reason: Column | None = None) -> DataFrame:
        return df.select(
            F.col("source_job_board").alias("job_board"), "company_id", F.lit(name).alias("outcome"),
            (F.lit(None) if reason is None else reason).cast("string").alias("reason"),
            (F.lit(1) if n is None else n).cast("bigint").alias("n"))

    # a repeated posting counts as an update of its first copy
    seen_again = F.col("copies") - F.when(F.col("id").isNull(), 1).otherwise(0)
    outcomes = (
        outcome(good, "added")
        .unionByName(outcome(matched, "updated", seen_again))
        .unionByName(outcome(rejected, "skipped", reason=F.get("violations", 0)))
    )
    begin = moment(as_of if started is None else started)
    finished = gate.where("complete").select("company_id")
    log = run_stats(outcomes, weight="n").join(finished.withColumn("_done", F.lit(True)), "company_id", "left").withColumns({
        "status": F.when(F.col("_done"), "completed").otherwise("failed"), "started_at": begin, "completed_at": moment(as_of)}).drop("_done")
    stamped = stamp_completion(companies, finished, as_of)
    return Cycle(M.next_table(staged), content, stamped, M.change_set(delta), rejected, to_canonical(with_duration(log), S.RUN_LOG), delta, counts)


Adapter = Callable[..., DataFrame]


def from_detail_pages(pages: DataFrame, order: Sequence[str] = (), adapter: Adapter | Mapping[str, Adapter] = workday_detail) -> Enrich:
    """An ``enrich`` for ``run_cycle``: new postings with the fields of their landed pages.

    ``pages`` has (posting_url, html); only pages of new postings are parsed, and of several
    pages with one URL the first in ``order``. ``adapter`` reads a family of pages (see
    ``sources.adapters``); given several by name, each reads the pages whose ``family`` it is
    called by, and a page of another family adds nothing.
    """
    families = adapter if isinstance(adapter, Mapping) else {None: adapter}
    kind = ["family"] if isinstance(adapter, Mapping) else []

    def enrich(new: DataFrame) -> DataFrame:
        own = pages.select("posting_url", "html", *kind, *order).join(new.select("posting_url"), "posting_url", "left_semi")
        own = first_of_key(own, ["posting_url"], order)
        parts = [read(own if name is None else own.where(F.col("family") == name), carry=["posting_url"]) for name, read in families.items()]
        found = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return with_detail(new, found, "posting_url", [c for c in DETAIL_FIELDS if c in found.columns])

    return enrich


def commit_cycle(spark: SparkSession, root: str, cycle: Cycle) -> int:
    """Write a cycle as the next version of its tables; see ``sources.tables.commit_tables``."""
    return commit_tables(
        spark, root, {"state": cycle.state, "companies": cycle.companies},
        {"content": cycle.content, "changes": cycle.changes, "rejected": cycle.rejected, "run_log": cycle.run_log},
    )


def commit_in_place(spark: SparkSession, root: str, layout: Layout, cycle: Cycle) -> int:
    """Write a cycle whose state lies in place: only the parts that it changed, see ``sources.state``."""
    return commit_parts(
        spark, root, layout, cycle.delta.drop("action"), {"companies": cycle.companies},
        {"content": cycle.content, "changes": cycle.changes, "rejected": cycle.rejected, "run_log": cycle.run_log},
    )


def state_of(listings: DataFrame) -> DataFrame:
    return listings.select(*[c for c in S.STATE_COLUMNS if c in listings.columns])
