"""The job lock that all gap detectors share, as keyed state (STR-4).

Detectors (the live one, the periodic one, operators) ask for jobs; a job that was dispatched
within the last ``ttl_ms`` of event time is not dispatched again. The times of dispatch are
map state (job_id -> dispatched_ms) of a fixed number of keyed slots, so the jobs of a hot
instrument spread over the cluster and a slot's state round trips are shared by its jobs.
Event-time timers remove an entry once the watermark has passed the end of its lock; any
request still to come would be dispatched then anyway. The state lives in the state store of
the query's checkpoint and is there again after a restart or a lost executor.

Requests of one micro-batch are settled by ``seen_ms``, whatever order they come in. One that
is older than the last dispatch of its job counts as a repeat; one that is more than ``late``
behind the newest is beyond the watermark and left to the next run of its detector. Requests
with a null job_id or time are left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from tickweave.streaming.gaps import TTL_MS

#: Keyed slots of the lock. Part of the state's layout: a checkpoint keeps its number.
SLOTS = 256
#: Timers of a slot fall on multiples of this.
TIMER_MS = 60_000
REQUEST = ["exchange_id", "symbol", "start_id", "end_id", "job_id", "seen_ms"]
DISPATCHED = "exchange_id string, symbol string, start_id long, end_id long, job_id string, dispatched_ms long"

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class JobLock(StatefulProcessor):
    def __init__(self, ttl_ms: int):
        self.ttl_ms = ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sent = handle.getMapState("sent", "job_id string", "dispatched_ms long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        asked = pd.concat(list(rows)).sort_values(["seen_ms", "start_id"], kind="stable")
        known: dict[str, int] = {}
        for job in asked["job_id"].unique():
            if self.sent.containsKey((job,)):
                known[job] = self.sent.getValue((job,))[0]
        held, keep = dict(known), []
        for job, seen in zip(asked["job_id"], asked["seen_ms"], strict=True):
            keep.append(job not in held or seen - held[job] >= self.ttl_ms)
            if keep[-1]:
                held[job] = int(seen)
        new = {job: at for job, at in held.items() if known.get(job) != at}
        for job, at in new.items():
            self.sent.updateValue((job,), (at,))
        for end in {-(-(at + self.ttl_ms) // TIMER_MS) * TIMER_MS for at in new.values()}:
            self.handle.registerTimer(end)
        yield asked[keep].rename(columns={"seen_ms": "dispatched_ms"})[[f.split()[0] for f in DISPATCHED.split(", ")]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        for job in [job for job, at in self.sent.iterator() if at[0] + self.ttl_ms <= now]:
            self.sent.removeKey(job)
        return iter(())

    def close(self) -> None:
        pass


def lock_jobs(requests: DataFrame, ttl_ms: int = TTL_MS, late: str = "1 day") -> DataFrame:
    """The requests (``REQUEST`` columns, a stream) to dispatch, with ``dispatched_ms``. The
    query that runs this needs ``state_store``."""
    slot = F.pmod(F.xxhash64("job_id"), F.lit(SLOTS)).cast("int")
    asked = requests.where("job_id is not null and seen_ms is not null").select(*REQUEST, slot.alias("slot"), F.timestamp_millis("seen_ms").alias("seen"))
    return asked.withWatermark("seen", late).groupBy("slot").transformWithStateInPandas(JobLock(ttl_ms), DISPATCHED, "append", "EventTime")


@contextmanager
def state_store(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, which map state needs; other
    queries of the session are left as they are."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def start_job_lock(requests: DataFrame, jobs_path: str, checkpoint: str, ttl_ms: int = TTL_MS, late: str = "1 day",
                   trigger: dict | None = None) -> StreamingQuery:
    """Run STR-4 continuously: dispatched jobs are appended to ``jobs_path`` (Parquet, exactly
    once through its commit log)."""
    with state_store(requests.sparkSession):
        return (lock_jobs(requests, ttl_ms, late).writeStream.format("parquet").option("checkpointLocation", checkpoint)
                .outputMode("append").trigger(**(trigger or {"processingTime": "10 seconds"})).start(jobs_path))
