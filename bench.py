"""Time the headline queries on $BENCH_SF_DIR and print one JSON line.

Each query is run to completion through the ``noop`` sink (every row is
produced, none is brought to the driver), ``$BENCH_RUNS`` times (default 3);
its time is the median run.  ``value`` is the sum of the per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rollcall import build_session  # noqa: E402
from rollcall.plans.bindings import QUERIES  # noqa: E402

HEADLINE = (
    "participant_report",
    "participants_extract",
    "forms_extract",
    "address_fallback",
    "fallback_counters",
    "provider_counters",
    "report_join",
    "provider_parse_brasilapi",
    "postal_profile",
    "batch_numbering_ties",
    "cancel_reason_null",
    "trade_correlation",
    "option_shirts",
    "edition_catalogue",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or list(HEADLINE)
    conf = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
            # Small-data sizing: AQE's default 1 MB minimum would fold the CPU-heavy
            # per-code lookup stage into one task at this scale.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k"}
    spark = build_session(f"local[{cpus}]", app="rollcall-bench", shuffle_partitions=int(cpus) * 2, conf=conf)
    # JVM warm-up (class loading, JIT, codegen) on the smallest data set, not timed.
    warm = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    QUERIES["participant_report"](spark, warm if os.path.isdir(warm) else sf_dir) \
        .write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    times = {}
    for name in names:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total_wall", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
