"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8)
choose data and cores. Every query is planned and run in full twice, writing to
Spark's no-op sink; the better time counts.
"""

from __future__ import annotations

import json
import os
import time

from checks.compare import local_session
from checks.queries import registered

HEADLINE = (
    "trx_clean",
    "dedup_trx",
    "trx_clean_dedup",
    "match_email",
    "all_matches",
    "best_match",
    "reconcile",
    "match_stats",
    "latest_transaction",
    "txn_aggregate",
    "quality_report_crm",
    "quality_report_trx",
    "master_record",
    "analytics_subset",
)
RUNS = 2


def seconds(run, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    runs = registered()
    times = {
        name: round(min(seconds(runs[name], spark, sf_dir) for _ in range(RUNS)), 3)
        for name in HEADLINE
    }
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
