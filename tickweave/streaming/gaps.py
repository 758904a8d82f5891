"""Online gap detection with job de-duplication (STR-3, STR-4).

State per (exchange, symbol): the greatest id seen. Within a micro-batch the ids of a key
are sorted; a jump ``id > last + 1`` emits the gap ``[last + 1, id - 1]``; ids at or below
``last`` (late or repeated) never lower it, so one detector can't emit a gap twice. Other
detectors can have: jobs of ``active`` that are not older than ``ttl_ms`` are left out. The
first state of a key can come from ``initial`` (AGG-2 ``last_ids`` of the table). Both are
joined to the stream as static sides, which every micro-batch reads again: give stored tables,
not frames that are worked out from much more. Late ids cannot retract an emitted gap; the batch
GAP-1 over the table reconciles.

One instrument's ids of one micro-batch are one array of longs in one task; the source's
rate limit (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) bounds it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickweave.functions import keys as fk

GAP_SCHEMA = "exchange_id string, symbol string, start_id long, end_id long, seen_ms long"
STATE_SCHEMA = "last_id long"
TTL_MS = 3_600_000


def _gaps(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    parts, now, init = [], 0, None
    for pdf in pdfs:
        parts.append(pdf["trade_id"].to_numpy(dtype=np.int64))
        now = max(now, int(pdf["local_timestamp"].max()))
        init = pdf["init_last"].dropna().iloc[0] if init is None and pdf["init_last"].notna().any() else init
    ids = np.sort(np.concatenate(parts))
    last = state.get[0] if state.exists else int(ids[0] if init is None else init)
    prev = np.maximum.accumulate(np.concatenate(([last], ids[:-1])))
    jump = ids > prev + 1
    state.update((max(int(last), int(ids[-1])),))
    yield pd.DataFrame({"exchange_id": key[0], "symbol": key[1], "start_id": prev[jump] + 1, "end_id": ids[jump] - 1, "seen_ms": now})


def stream_gaps(trades: DataFrame, initial: DataFrame | None = None, active: DataFrame | None = None,
                ttl_ms: int = TTL_MS) -> DataFrame:
    """STR-3/4: gap jobs (exchange_id, symbol, start_id, end_id, job_id) of a streaming trade
    frame; ``initial`` has exchange_id, symbol, last_id; ``active`` has job_id, dispatched_ms."""
    t = trades.select("exchange_id", "symbol", "trade_id", "local_timestamp")
    if initial is not None:
        t = t.join(initial.select("exchange_id", "symbol", F.col("last_id").alias("init_last")),
                   ["exchange_id", "symbol"], "left")
    else:
        t = t.withColumn("init_last", F.lit(None).cast("long"))
    found = t.groupBy("exchange_id", "symbol").applyInPandasWithState(
        _gaps, GAP_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout).withColumn("job_id", fk.gap_job_id())
    if active is not None:
        # merged, as a broadcast would go through the driver in every micro-batch
        held = active.select(F.col("job_id").alias("_job"), F.col("dispatched_ms").alias("_sent")).hint("merge")
        found = found.join(held, (F.col("job_id") == F.col("_job")) & (F.col("seen_ms") - F.col("_sent") < F.lit(ttl_ms)), "left_anti")
    return found.select("exchange_id", "symbol", "start_id", "end_id", "job_id")


def start_gap_watch(trades_stream: DataFrame, jobs_path: str, checkpoint: str, initial: DataFrame | None = None,
                    active: DataFrame | None = None, trigger: dict | None = None):
    """Run STR-3/4 continuously, appending new gap jobs to ``jobs_path`` (Parquet)."""
    q = (stream_gaps(trades_stream, initial, active).writeStream.format("parquet")
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(**(trigger or {"processingTime": "60 seconds"})))
    return q.start(jobs_path)
