"""Measure task balance of the window stage under a hot instrument, from Spark's event log.

usage: python tools/skew_probe.py [sf_dir] [event_log_dir]
The sf0.1 trades are relabelled so that one instrument holds ~90 % of the rows; WIN-2 then
runs on the plain per-instrument layout and on the blocked layout. For every stage the
report gives the largest and the median number of shuffle records one task read.
"""

from __future__ import annotations

import glob
import json
import os
import statistics
import sys
import tempfile

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tickweave import fixtures as fx  # noqa: E402
from tickweave.operators import windows as win  # noqa: E402
from tickweave.session import ensure_checkpoint_dir  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.sql.shuffle.partitions", "16").config("spark.ui.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.eventLog.compress", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    t = fx.local_trades(spark, sf)
    # ids stay unique: id * 8 + the row's original instrument number
    code = F.lit(0)
    for i, s in enumerate(fx.SYMBOLS):
        code = F.when(F.col("symbol") == s, F.lit(2 * i)).otherwise(code)
    code = code + F.when(F.col("exchange_id") == "okx", F.lit(1)).otherwise(F.lit(0))
    to_hot = (F.col("trade_id") % 10 != 0)
    hot = (t.withColumn("trade_id", F.col("trade_id") * 8 + code)
           .withColumn("symbol", F.when(to_hot, F.lit("BTC/USDT")).otherwise(F.col("symbol")))
           .withColumn("exchange_id", F.when(to_hot, F.lit("binance")).otherwise(F.col("exchange_id"))))
    n_hot = hot.where("symbol = 'BTC/USDT' AND exchange_id = 'binance'").count()
    n_all = hot.count()
    for layout in ("key", "blocked"):
        spark.sparkContext.setJobGroup(layout, layout)
        win.with_ma_price(hot, layout=layout, block_rows=1024).write.format("noop").mode("overwrite").save()
    app = spark.sparkContext.applicationId
    spark.stop()
    files = []
    for p in glob.glob(os.path.join(log_dir, "*" + app + "*")):
        files += sorted(glob.glob(os.path.join(p, "*"))) if os.path.isdir(p) else [p]
    stage_group, per_stage = {}, {}
    for path in files:
        fh = open(path)
        for line in fh:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = grp
            elif kind == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                rd = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                per_stage.setdefault(ev["Stage ID"], []).append(rd)
        fh.close()
    print(f"rows {n_all}, hot instrument {n_hot} ({n_hot / n_all:.0%})")
    for grp in ("key", "blocked"):
        worst = [(max(v), statistics.median(v), len(v), sid) for sid, v in per_stage.items()
                 if stage_group.get(sid) == grp and max(v) > 0]
        top = max(worst) if worst else None
        if top:
            print(f"{grp:8s} largest shuffle-reading stage {top[3]}: max records per task {top[0]}, "
                  f"median {top[1]:.0f}, tasks {top[2]}")


if __name__ == "__main__":
    main()
