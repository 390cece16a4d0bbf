"""Wall time of the registered queries and of the full report set; prints one JSON line.

``queries`` holds warm times (second run), ``cold`` those of the first run in the session, which
include planning and code generation, and ``jobs`` the Spark jobs of one run.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.compare import session
from checks.queries import QUERIES
from checks.tables import FLOW, FLOW_ORDER, flows
from flowlens.operators.report import analyze

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def run(df) -> None:
    """Compute every row and column, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def report_set(spark, sf_dir: str) -> None:
    reports = analyze(flows(spark, sf_dir), FLOW, order=FLOW_ORDER, rel_error=0)
    for report in reports.values():
        run(report)
    reports.release()


def is_other_plan(name: str) -> bool:
    """Queries that repeat another one by another plan, or read it from the report set."""
    ends = ("_shuffled", "_joined", "_in_pieces", "_of_hot_sources")
    return name.startswith("report_") or name.endswith(ends)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    names = sys.argv[1:] or [*(n for n in QUERIES if not is_other_plan(n)), "report_set"]
    spark = session(CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    run(flows(spark, SF_DIR))  # start-up and class loading are not a query

    def execute(name: str) -> None:
        if name == "report_set":
            report_set(spark, SF_DIR)
        else:
            run(QUERIES[name](spark, SF_DIR))

    warm, cold, jobs = {}, {}, {}
    context = spark.sparkContext
    for name in names:
        context.setJobGroup(name, name)
        cold[name] = timed(lambda: execute(name))
        jobs[name] = len(context.statusTracker().getJobIdsForGroup(name))
        warm[name] = timed(lambda: execute(name))
    print(
        json.dumps(
            {
                "metric": "total wall time of all queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "jobs": jobs,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
