"""Benchmark of the headline queries; prints one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query, the fastest counts (default 2)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from condoflow import registry  # noqa: E402
from condoflow.session import local_session  # noqa: E402

HEADLINE = (
    "r1_weekly_flow", "r2_dept_month_pivot", "r3_income_by_source", "r4_top_months", "r5_top_debtors",
    "r6_payment_gaps", "r6_payment_gaps_xml", "statement_header", "statement_detail", "late_interest",
    "statement_batch", "apply_payments", "ingest_pagos", "ingest_gastos", "ingest_personas", "enrich_suppliers",
    "ingest_uf_titular", "ingest_uf_consorcio", "upsert_consorcio", "annex_parking", "assign_surrogate_id",
    "drop_all_duplicates", "dq_violations", "notification_payload",
)


def seconds(query, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    queries = registry.queries()
    wanted = sys.argv[1:] or HEADLINE
    times = {
        name: round(min(seconds(queries[name], spark, sf_dir) for _ in range(runs)), 3) for name in wanted
    }
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
