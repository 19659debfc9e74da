"""Timings of the headline queries at one scale; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3) and BENCH_QUERIES (comma
separated, default the list below) set the run. Each query is run once to warm up and the median of the runs is kept.
Results go to the noop sink: all rows and columns are computed, nothing is collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from bankflow.checks.queries import QUERIES  # noqa: E402
from bankflow.plans.session import local_session  # noqa: E402

HEADLINE = [
    "ledger_flattened", "potential_fraud_accounts", "payment_reconciliation", "activity_heatmap", "portfolio_risk",
    "fee_leakage", "customer_profitability", "cross_sell_opportunities", "clearing_system_efficiency",
    "merchant_payment_summary", "customer_segment_transactions", "monthly_failed_transactions", "overdraft_usage",
    "high_value_foreign_payments", "excessive_fee_payments", "join_left_or_keys", "join_left_chain", "load_full",
    "load_incremental", "scd1_customer", "scd2_loans", "country_risk_category", "currency_details",
    "largest_country_per_region", "rank_in_partition",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session("bench", cpus)
    spark.sparkContext.setLogLevel("ERROR")

    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total median query time", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
