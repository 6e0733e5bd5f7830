"""Benchmark: run the headline queries and print ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (optional comma list to override the headline set).
Each query is fully executed (all result rows fetched); time is wall-clock per
query after one untimed warm-up of the JVM on the smallest query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wardline.plans.catalog import load_all  # noqa: E402
from wardline.session import build_session  # noqa: E402


# one or two queries per family: typing + checks + gate, history, facts, marts,
# indicators, linkage, loading
HEADLINE = [
    "mrt2_lead_time_by_priority",
    "dq8e_load_report",
    "jn3_version_in_force",
    "fct5_invoices",
    "mrt1_daily_activity",
    "mrt5_recovery_by_debtor",
    "mrt7_completeness",
    "in42_cumulative_lead_curves",
    "dim2_date",
    "lkd2_candidate_pairs",
    "lk11_scored_pairs",
    "snk1_batch_load_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        master=f"local[{cpus}]",
        app_name="wardline-bench",
        shuffle_partitions=cpus * 2,
        extra={
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry = load_all()
    chosen = os.environ.get("BENCH_QUERIES")
    names = [n for n in chosen.split(",") if n] if chosen else HEADLINE
    # warm-up (JIT, class loading) on a tiny query, not timed
    registry["dim_codes_labelled"].build(spark, sf_dir).collect()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        registry[name].build(spark, sf_dir).collect()
        timings[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total_wall",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
