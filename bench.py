"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf"}.
The star build (clean -> stage -> dimensions -> fact, written to the
checkpoint folder) is timed as ``etl_build``; the OLAP queries then read
the written tables, as they would in a deployed warehouse. Each query is
forced to full evaluation with a ``noop`` write; fast queries report the
median of 3 warm runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_basic", "clean_standard", "jobs_by_industry", "jobs_by_location", "top_companies",
    "salary_trend_monthly", "postings_by_week", "jobs_by_agency", "industry_analysis", "job_summary",
    "run_summary", "quality_report", "dedup_exact", "dedup_fuzzy", "dedup_documents", "rollup_time",
    "trend_mom", "fact_upsert", "star_bench_by_nation", "star_bench_top_suppliers", "star_bench_monthly",
    "star_bench_weekly", "star_bench_by_segment",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from postwise.plans.catalog import QUERIES
    from postwise.plans.warehouse import warehouse
    from postwise.session import get_spark

    spark = get_spark(cpus)
    # JVM warm-up (class loading, first code generation), not timed.
    spark.range(200_000).selectExpr("id % 97 AS k", "regexp_replace(cast(id AS string), '1', 'x') AS s") \
        .groupBy("k").count().collect()
    times: dict[str, float] = {}
    t0 = time.perf_counter()
    warehouse(spark, sf_dir)
    times["etl_build"] = round(time.perf_counter() - t0, 3)

    def run(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for name in HEADLINE:
        first = run(name)
        if first < 5.0:
            times[name] = round(statistics.median([run(name) for _ in range(3)]), 3)
        else:
            times[name] = round(first, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
