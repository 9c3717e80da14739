"""Times the headline queries, the second run of each, and prints one JSON line.

The first run of a query pays for class loading, compiled code and Python workers.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tracewell.contracts import MAX_SPOOL_ITEMS  # noqa: E402
from tracewell.plans import registry  # noqa: E402
from tracewell.session import local_session, tables_of_a_run  # noqa: E402

HEADLINE = (
    "flush_events",
    "event_items",
    "daily_visitors",
    "error_items",
    "log_items",
    "js_report_flow",
    "report_funnel",
    "cart_events",
    "sale_events",
    "redact_docs",
    "redaction_counts",
    "item_budgets",
    "source_previews",
    "contract_violations",
    "keep_newest",
    "packed_batches",
    "batch_sizes",
    "idle_expiry",
    "overflow_cycles",
    "session_dedupe",
    "error_trails",
    "delivery_summary",
    "next_spool",
    "paused_runs",
    "stream_dedupe",
    "stream_delivery",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), os.environ.get("BENCH_MEMORY", "12g"), "bench")
    registry.load_all()
    timings, first = {}, {}
    for name in HEADLINE:
        for seen in (first, timings):
            started = time.perf_counter()
            with tables_of_a_run(spark):
                registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            seen[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {timings[name]} (first {first[name]})", file=sys.stderr, flush=True)
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "first_runs_total": round(sum(first.values()), 3),
                "items_per_minute_spooled": round(events / timings["flush_events"] * 60),
                "items_per_minute_flushed": round(min(events, MAX_SPOOL_ITEMS) / timings["flush_events"] * 60),
                "sf": os.path.basename(folder.rstrip("/")),
            }
        ),
        flush=True,
    )


if __name__ == "__main__":
    main()
