"""Headline queries at one scale; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores. Every query is run once to
warm up and then timed, except the last ones, which write whole tables and are run once;
the value is the sum of the timed runs. Results go to a sink that reads every row and
keeps none.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)
# Python workers import the package too.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [HERE, os.environ.get("PYTHONPATH")]))

from tidemark import catalog
from tidemark.session import local_session

HEADLINE = [
    "parse_envelopes",
    "validate_headers",
    "fan_out",
    "normalize_attestations",
    "event_ids",
    "routes",
    "split_payloads",
    "rehydrate_payloads",
    "dedup_latest",
    "duplicate_volume",
    "append_unseen",
    "void_resolution",
    "table_counts",
    "throttle_first",
    "subject_order_check",
    "decode_signals",
    "prune_signals",
    "merge_coordinates",
    "decode_packed",
    "latest_signals",
    "expire_cutoff",
    "unconsumed_expiring",
    "registration_batches",
    "plan_compaction",
    "health_report",
    "counter_increase",
    "heartbeat_gaps",
    "sustained_condition",
    "write_and_read_table",
    "backfill_bundles",
]


RUN_ONCE = {"write_and_read_table", "backfill_bundles"}


def main() -> None:
    directory = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench")
    queries = catalog.queries()
    names = sys.argv[1:] or HEADLINE
    timings: dict[str, float] = {}
    events = spark.read.parquet(f"{directory}/events.parquet").count()
    for name in names:
        for _ in range(1 if name in RUN_ONCE else 2):
            started = time.perf_counter()
            queries[name](spark, directory).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - started, 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)
    rates = {n: round(events / timings[n]) for n in ("dedup_latest", "decode_packed", "write_and_read_table") if n in timings}
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": os.path.basename(directory.rstrip("/")).removeprefix("sf"),
                "events_per_second": rates,
                "cores": int(cores),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
