"""Wall time of the headline queries; prints one JSON line.

Each query is planned and run to the end twice, and the second time counts: the first one
compiles code and touches memory. Results go to the no-op sink, so nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from vacancia import catalog  # noqa: E402
from vacancia.session import build_session  # noqa: E402

HEADLINE = [
    "company_profile", "skill_demand", "skill_demand_active", "pending_queue", "public_listings",
    "job_type_normalise", "keyword_classify", "salary_text", "salary_annualised", "relative_dates",
    "multi_format_dates", "normalised_dates", "recency", "dictionary_match", "url_facets",
    "content_hash_dups", "page_content", "page_structure", "page_links", "feed_workday", "feed_adp",
    "feed_taleo", "disjunctive_match", "snapshot_merge", "stale_close", "reopen", "capped_new_rows",
    "unique_slugs", "surrogate_keys", "quality_report", "quality_orphans", "run_stats", "name_audit",
    "full_cycle", "stream_expire",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    conf = {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g",
        "spark.log.level": "ERROR", "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="vacancia-bench-"),
    }
    spark = build_session("vacancia-bench", master=f"local[{cpus}]", **conf)
    queries = catalog.queries()
    times: dict[str, float] = {}
    for name in HEADLINE:
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total wall time of the headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
