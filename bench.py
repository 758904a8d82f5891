"""Benchmark the headline queries; prints one JSON line.

Protocol: ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on ``local[$BENCH_CPUS]``,
one warm-up run, then the median of three runs, each writing the full result to the
``noop`` sink (every row is produced, nothing is collected).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tickweave.plans import catalog  # noqa: E402
from tickweave.session import get_spark  # noqa: E402

HEADLINE = [
    "trade_features",        # PIP-2 trades: AGG-1 + WIN-1/2 per instrument and day (flagship)
    "book_features",         # PIP-2 books
    "gaps",                  # GAP-1
    "asof_join",             # JON-4
    "impact_by_category",    # PIP-7 (JON-4 -> FLT-6 -> FEA-11/12 -> AGG-4)
    "book_factors",          # FEA-6 + WIN-3/4
    "ma_price",              # WIN-2 (size-checked layout: plain window at this size)
    "evaluate",              # AGG-6 + AGG-8
    "audit",                 # JON-2
    "gap_fill",              # JON-6
    "stream_gaps",           # STR-3
    # the scale-out layout on the same inputs (range-partitioned index, halo blocks)
    "trade_features_blocked",
    "ma_price_blocked",
    "book_factors_blocked",
    "asof_join_blocked",
]


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = sys.argv[1:] or HEADLINE
    spark = get_spark(f"local[{cpus}]", shuffle_partitions=cpus, app="tickweave-bench")
    fns = catalog.QUERIES
    rows_in = spark.read.parquet(f"{sf}/events.parquet").count()
    out = {}
    for name in names:
        fn = fns[name]
        times = []
        for i in range(4):
            t0 = time.perf_counter()
            fn(spark, sf).write.format("noop").mode("overwrite").save()
            if i:
                times.append(time.perf_counter() - t0)
        out[name] = round(statistics.median(times), 3)
    print(json.dumps({"metric": "headline_total_median_sec", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": os.path.basename(sf.rstrip("/")).replace("sf", ""),
                      "rows_in_events": rows_in, "cpus": cpus}))


if __name__ == "__main__":
    main()
