"""Benchmark: wall seconds per headline query at ``$BENCH_SF_DIR``.

Each query is executed in full with the ``noop`` sink (every row is
produced, nothing is collected to the driver).  After one untimed warm-up
pass, ``BENCH_RUNS`` timed passes run and each query reports its best wall
time (building the plan on the driver plus executing it).  Prints ONE JSON
line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=4 python bench.py
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from visitflow.plans import registry  # noqa: E402
from visitflow.session import local_session  # noqa: E402

HEADLINE = [
    "report_visits_tomorrow", "report_cancelled", "report_court_candidates", "report_to_schedule",
    "report_to_publish", "report_to_publish_clientphotos", "report_to_publish_nophotos",
    "report_published_links", "lookup_links", "lookup_reasons", "lookup_sheet_published",
    "report_status_current", "outbox_visit_reminder", "outbox_cancelled_digest",
    "report_backlog_team", "report_backlog_agent", "outbox_team_lead", "outbox_agent_digest",
    "outbox_confirmation_summary", "outbox_cancellation_notice",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    parts = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus))
    spark = local_session(cpus, shuffle_partitions=parts, app="visitflow-bench")
    # warm the JVM and the parquet footer cache once
    spark.read.parquet(f"{sf_dir}/nation.parquet").write.format("noop").mode("overwrite").save()
    # one untimed pass so JIT / codegen warm-up is not charged to the first query
    cold = time.perf_counter()
    for key in HEADLINE:
        registry.QUERIES[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
    cold = round(time.perf_counter() - cold, 3)
    # timed passes: per query the best of RUNS (wall time = plan building + execution)
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    times: dict[str, float] = {}
    build: dict[str, float] = {}
    for _ in range(runs):
        for key in HEADLINE:
            t0 = time.perf_counter()
            df = registry.QUERIES[key](spark, sf_dir)
            t1 = time.perf_counter()
            df.write.format("noop").mode("overwrite").save()
            t2 = time.perf_counter()
            if key not in times or t2 - t0 < times[key]:
                times[key], build[key] = round(t2 - t0, 3), round(t1 - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_wall_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": sf, "cpus": cpus, "runs": runs,
                      "plan_build_seconds": round(sum(build.values()), 3),
                      "execute_seconds": round(sum(times.values()) - sum(build.values()), 3),
                      "cold_pass_seconds": cold}))


if __name__ == "__main__":
    main()
