"""Time the headline results and print one JSON line.

BENCH_SF_DIR names the input folder, BENCH_CPUS the local cores.  ``bind_model``
is the time to derive and write the finance model once; every query then reads it.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from tallywright.functions.numeric import present
from tallywright.plans.catalog import RESULTS
from tallywright.session import local_session
from tallywright.sources.binding import bind

HEADLINES = (
    "ar_aging", "aging_summary", "dso_overall", "dso_by_merchant", "dso_monthly",
    "billing_merchant_month", "billing_errors_by_segment", "realization_month",
    "realization_overall", "recon_payments", "recon_invoices", "recon_summary",
    "leakage_by_type", "leakage_table", "collection_rate", "promise_to_pay",
    "payment_behavior", "collection_queue", "dq_findings", "clean_transactions",
    "cleaning_stats", "asof_contract_rate", "sql_05", "sql_15", "sql_19", "sql_20", "sql_24",
    "sql_28", "fact_invoices", "m_realization",
)
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")

    started = time.perf_counter()
    model = bind(spark, folder)
    for name in model:
        model[name]
    timings = {"bind_model": time.perf_counter() - started}

    for name in HEADLINES:
        seconds = []
        for _ in range(RUNS):
            started = time.perf_counter()
            present(RESULTS[name](model)).write.format("noop").mode("overwrite").save()
            seconds.append(time.perf_counter() - started)
        timings[name] = statistics.median(seconds)

    timings = {name: round(seconds, 3) for name, seconds in timings.items()}
    print(json.dumps({
        "metric": "headline results, wall time (median of 3 runs each, model bound once)",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": cpus,
    }))


if __name__ == "__main__":
    main()
