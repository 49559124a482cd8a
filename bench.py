"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is run to completion with the ``noop`` sink (every row computed,
nothing sent to the driver).  One warm-up pass over all queries, then
``BENCH_RUNS`` timed passes (default 3); the reported time is the median.  The
whole schedules (``SCHEDULES``) run once, after the others.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "Q05_dm_bytes_received",
    "Q08_payment_stage",
    "Q10_hub_user",
    "Q11_hub_account",
    "Q12_hub_billing_period",
    "Q13_hub_pay_doc",
    "Q15_link_user_account_billing_pay",
    "Q17_sat_user_details",
    "Q18_sat_pay_details",
    "Q21_payment_report",
    "Q27_report_fact",
]
# the reference's yearly schedules over all years: E2 + E3, and E4
SCHEDULES = ["Q28_backfill", "Q29_combined_run_second_vault"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE + SCHEDULES)).split(",")

    from vaultmart.session import get_or_create_session
    from vaultmart.plans.registry import QUERIES

    spark = get_or_create_session(f"local[{cpus}]", shuffle_partitions=int(cpus))

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    often, once = [n for n in names if n not in SCHEDULES], [n for n in names if n in SCHEDULES]
    for name in often:  # warm-up
        run(name)
    times = {name: [] for name in names}
    for _ in range(runs):
        for name in often:
            times[name].append(run(name))
    for name in once:
        times[name].append(run(name))
    med = {name: round(statistics.median(ts), 3) for name, ts in times.items()}
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_median", "value": round(sum(med.values()), 3),
                      "unit": "sec", "queries": med, "sf": sf, "runs": runs, "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
