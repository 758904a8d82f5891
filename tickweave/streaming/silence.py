"""Feed silence (STR-5), re-aimed from wall-clock time-outs to event time.

Batch: a silence is the gap between consecutive messages of a feed; over ``soft_ms``
(strictly) it is a reconnect, over ``dead_ms`` a dead feed. Stream: ``silence_alarms`` keeps
the last message time of each feed and raises both alarms without waiting for the feed's
next message, by event-time time-outs; session windows with a ``soft_ms`` gap give the
activity sessions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickweave.operators import windows as win

SOFT_MS = 20_000
DEAD_MS = 60_000


def silence_events(df: DataFrame, by: Sequence[str] = ("exchange_id", "symbol"), ts: str = "local_timestamp",
                   tie: Sequence[str] = (), soft_ms: int = SOFT_MS, dead_ms: int = DEAD_MS,
                   layout: str | None = None) -> DataFrame:
    """Silences longer than ``soft_ms``: by + ``silence_start``, ``silence_ms``, ``kind``."""
    by = list(by)
    x = win.with_prev(df.select(*by, ts, *tie), ts, by, [ts, *tie], out="_prev", layout=layout)
    gap = F.col(ts) - F.col("_prev")
    return (x.where(gap > F.lit(soft_ms))
            .select(*by, F.col("_prev").alias("silence_start"), gap.alias("silence_ms"),
                    F.when(gap > F.lit(dead_ms), F.lit("dead")).otherwise(F.lit("reconnect")).alias("kind")))


def reconnect_counts(events: DataFrame, by: Sequence[str] = ("exchange_id", "symbol")) -> DataFrame:
    """Reconnects (every silence over the soft limit) and dead feeds per instrument."""
    return events.groupBy(*by).agg(F.count(F.lit(1)).alias("n_reconnects"),
                                   F.count(F.when(F.col("kind") == "dead", F.lit(1))).alias("n_dead"))


def activity_sessions(stream: DataFrame, by: Sequence[str] = ("exchange_id", "symbol"),
                      ts: str = "local_timestamp", soft: str = "20 seconds", watermark: str = "1 minute") -> DataFrame:
    """Streaming form: session windows per feed; each session after the first of a feed
    follows a silence longer than ``soft`` (a gap of exactly ``soft`` stays in one session)."""
    t = stream.withColumn("_evt", F.timestamp_millis(F.col(ts)))
    return (t.withWatermark("_evt", watermark)
            .groupBy(F.session_window("_evt", soft).alias("session"), *by)
            .agg(F.count(F.lit(1)).alias("n_messages"), F.min(ts).alias("first_ms"), F.max(ts).alias("last_ms")))


def silence_alarms(stream: DataFrame, by: Sequence[str] = ("exchange_id", "symbol", "data_type"),
                   ts: str = "local_timestamp", soft_ms: int = SOFT_MS, dead_ms: int = DEAD_MS,
                   watermark: str = "1 minute") -> DataFrame:
    """STR-5 streaming: by + ``silence_start``, ``kind``: one 'reconnect' row once a feed has
    been silent for more than ``soft_ms``, one 'dead' row once for more than ``dead_ms``,
    whether its next message ended the silence or the watermark has passed the limit."""
    by = list(by)

    def rows(key, starts: np.ndarray, kinds: list[str]) -> pd.DataFrame:
        out = pd.DataFrame({b: [k] * len(kinds) for b, k in zip(by, key)})
        out["silence_start"], out["kind"] = np.asarray(starts, dtype=np.int64), kinds
        return out

    def watch(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, told = state.get if state.exists else (None, 0)
        if state.hasTimedOut:
            silent = state.getCurrentWatermarkMs() - last
            due = [k for i, (k, limit) in enumerate((("reconnect", soft_ms), ("dead", dead_ms))) if told <= i and silent > limit]
            told += len(due)
            state.update((last, told))
            if told < 2:
                state.setTimeoutTimestamp(max(last + dead_ms, state.getCurrentWatermarkMs() + 1))
            yield rows(key, [last] * len(due), due)
            return
        times = np.sort(np.concatenate([p[ts].to_numpy(dtype=np.int64) for p in pdfs]))
        prev = np.maximum.accumulate(np.concatenate(([times[0] if last is None else last], times[:-1])))
        starts, kinds = [], []
        for i, (kind, limit) in enumerate((("reconnect", soft_ms), ("dead", dead_ms))):
            over = times - prev > limit
            over[0] &= told <= i  # what a time-out has told already
            starts += prev[over].tolist()
            kinds += [kind] * int(over.sum())
        last = int(max(times[-1], prev[-1]))
        state.update((last, 0))
        state.setTimeoutTimestamp(max(last + soft_ms, state.getCurrentWatermarkMs() + 1))
        yield rows(key, starts, kinds)

    t = stream.select(*by, ts, F.timestamp_millis(F.col(ts)).alias("_evt")).withWatermark("_evt", watermark)
    return t.groupBy(*by).applyInPandasWithState(
        watch, ", ".join(f"{b} string" for b in by) + ", silence_start long, kind string", "last_ms long, told int", "append",
        GroupStateTimeout.EventTimeTimeout)
