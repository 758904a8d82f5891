"""Filters, data-quality checks, versions and reconciliation (FLT-*, AGG-1..3, AGG-9..12, JON-1..3).

All set-level: one job covers every instrument of the day; nothing loops per symbol.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.schemas import INSTRUMENT, VENUE_SYMBOL

DAY_MS = 86_400_000
TRADE_KEY = ["exchange_id", "symbol", "mkt_type", "timestamp", "trade_id"]
BOOK_KEY = ["exchange_id", "symbol", "mkt_type", "timestamp", "nonce"]


def day_start_ms(date: str | _dt.date) -> int:
    d = _dt.date.fromisoformat(date) if isinstance(date, str) else date
    return int(_dt.datetime(d.year, d.month, d.day, tzinfo=_dt.timezone.utc).timestamp() * 1000)


# ---------------------------------------------------------------- FLT-*

def on_day(df: DataFrame, date: str | _dt.date, ts: str = "timestamp", partition_col: str = "date",
           max_latency_days: int | None = None) -> DataFrame:
    """FLT-1: rows whose epoch-ms ``ts`` falls in the UTC day ``[day, day + 1)``.

    Compares the bare column to literals so the predicate reaches the Parquet scan.
    Tables are partitioned by the day of ``local_timestamp`` (ingest time), which is at
    or after ``timestamp``; with ``max_latency_days`` the partition column is also limited
    to ``[day, day + max_latency_days]`` so partition pruning applies. Only set it when
    ingest delay is bounded: rows patched from an archive carry their load time.
    """
    start = day_start_ms(date)
    cond = (F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(start + DAY_MS))
    if max_latency_days is not None and partition_col in df.columns:
        d = _dt.date.fromisoformat(date) if isinstance(date, str) else date
        hi = d + _dt.timedelta(days=max_latency_days)
        cond = cond & F.col(partition_col).between(F.lit(d), F.lit(hi))
    return df.where(cond)


# fixed values: days back of the automated daily run per exchange (archives publish later for okx)
DAYS_BACK = {"okx": 2}
DEFAULT_DAYS_BACK = 1


def on_automated_day(df: DataFrame, now_ms: int, ts: str = "timestamp", days_back: dict | None = None,
                     default_days_back: int = DEFAULT_DAYS_BACK) -> DataFrame:
    """FLT-1 for the scheduled run without a date: per exchange the UTC day ``days_back``
    before ``now`` (yesterday; two days back for okx). An OR of plain ranges, so it still
    reaches the scan."""
    days_back = DAYS_BACK if days_back is None else days_back
    today = _dt.datetime.fromtimestamp(now_ms / 1000, tz=_dt.timezone.utc).date()

    def day_range(n: int) -> Column:
        start = day_start_ms(today - _dt.timedelta(days=n))
        return (F.col(ts) >= F.lit(start)) & (F.col(ts) < F.lit(start + DAY_MS))

    special = list(days_back)
    cond = ~F.col("exchange_id").isin(special) & day_range(default_days_back) if special \
        else day_range(default_days_back)
    for ex, n in days_back.items():
        cond = cond | ((F.col("exchange_id") == F.lit(ex)) & day_range(n))
    return df.where(cond)


def for_instrument(df: DataFrame, exchange_id: str | None = None, symbol: str | None = None,
                   mkt_type: str | None = None) -> DataFrame:
    """FLT-2: equality filters on the instrument columns that are given."""
    cond = F.lit(True)
    for col, val in (("exchange_id", exchange_id), ("symbol", symbol), ("mkt_type", mkt_type)):
        if val is not None:
            cond = cond & (F.col(col) == F.lit(val))
    return df.where(cond)


def id_between(df: DataFrame, lo: int, hi: int, col: str = "trade_id") -> DataFrame:
    """FLT-3: ``col BETWEEN lo AND hi`` (inclusive)."""
    return df.where(F.col(col).between(lo, hi))


def validate_trades(df: DataFrame, by: Sequence[str] = INSTRUMENT, max_range: float = 0.1,
                    strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """FLT-4: (rows with a non-null price <= 0, report per group).

    The report holds row and error counts, min/max of the good prices (> 0), the range ratio
    ``(max - min) / min`` and ``warn`` when it is strictly above ``max_range``.
    ``strict=True`` runs one small action and raises when any price is bad.
    """
    bad = df.where(F.col("price") <= F.lit(0.0))
    p = F.col("price")
    report = (df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(p <= F.lit(0.0), F.lit(1))).alias("n_bad_price"),
        F.min(F.when(p > F.lit(0.0), p)).alias("min_price"),
        F.max(F.when(p > F.lit(0.0), p)).alias("max_price"))
        .withColumn("range_ratio", (F.col("max_price") - F.col("min_price")) / F.col("min_price"))
        .withColumn("warn", F.coalesce(F.col("range_ratio") > F.lit(max_range), F.lit(False))))
    if strict and not bad.isEmpty():
        raise ValueError("abnormal price data detected (price <= 0)")
    return bad, report


def apply_retention(df: DataFrame, now_ms: int, days: int = 7, col: str = "local_timestamp") -> DataFrame:
    """FLT-5: keep rows younger than ``days`` by ``col`` (expired once ``col + days <= now``)."""
    return df.where(F.col(col) > F.lit(now_ms - days * DAY_MS))


def fresh_quotes(df: DataFrame, max_lag_ms: int = 100, col: str = "data_lag_ms") -> DataFrame:
    """FLT-6: as-of matches whose quote is at most ``max_lag_ms`` old (absolute)."""
    return df.where(F.abs(F.col(col)) <= F.lit(max_lag_ms))


def drop_nulls(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """FLT-7: drop rows with a NULL in any of ``cols`` (default: all). NaN is kept."""
    cond: Column = F.lit(True)
    for c in (cols or df.columns):
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


# ---------------------------------------------------------------- AGG-1..3

def latest_by_key(df: DataFrame, key: Sequence[str] = TRADE_KEY, version: str = "local_timestamp",
                  tie: Sequence[str] = (), pre_partition: bool | Sequence[str] = False) -> DataFrame:
    """AGG-1: one row per ``key``, the one with the greatest ``version`` (then ``tie``).

    ``max_by`` aggregates partially on the map side, so duplicate versions collapse
    before the shuffle; its struct buffer plans as a spillable SortAggregate.
    ``pre_partition`` hash-partitions by the key (or by the given subset of it) first: when
    versions are rare the map side has nothing to collapse, and this way the rows are sorted
    once (after the shuffle) instead of once on each side of it. A subset of the key still
    satisfies the aggregate's clustering, and leaves out columns the optimizer may fold to
    constants.
    """
    key = list(key)
    if pre_partition:
        df = df.repartition(*(key if pre_partition is True else list(pre_partition)))
    rest = [c for c in df.columns if c not in key]
    agg = df.groupBy(*key).agg(F.max_by(F.struct(*rest), F.struct(version, *tie)).alias("_r"))
    return agg.select(*key, *[F.col("_r." + c).alias(c) for c in rest]).select(*df.columns)


def last_ids(df: DataFrame, by: Sequence[str] = VENUE_SYMBOL, id_col: str = "trade_id",
             out: str = "last_id") -> DataFrame:
    """AGG-2: greatest id per group (state recovery for the online gap detector)."""
    return df.groupBy(*by).agg(F.max(id_col).alias(out))


def day_coverage(df: DataFrame, expected: DataFrame, date: str, by: Sequence[str] = VENUE_SYMBOL,
                 ts: str = "timestamp") -> DataFrame:
    """AGG-3: rows per expected instrument on ``date``; none -> action 'full', else 'partial'."""
    counts = on_day(df, date, ts).groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"))
    out = expected.select(*by).distinct().join(counts, list(by), "left")
    n = F.coalesce(F.col("n_rows"), F.lit(0)).cast("long")
    return (out.withColumn("n_rows", n)
            .withColumn("action", F.when(n == 0, F.lit("full")).otherwise(F.lit("partial"))))


# ---------------------------------------------------------------- JON-1..3

def missing_trades(official: DataFrame, local: DataFrame, by: Sequence[str] = VENUE_SYMBOL,
                   id_col: str = "trade_id") -> DataFrame:
    """JON-1: archive rows whose id is absent locally (left anti join on instrument + id)."""
    keys = [*by, id_col]
    return official.join(local.select(*keys), keys, "left_anti")


def _within_archive(official: DataFrame, local: DataFrame, by: Sequence[str], id_col: str) -> DataFrame:
    """Local rows inside the archive's id range of their instrument."""
    rng = official.groupBy(*by).agg(F.min(id_col).alias("_lo"), F.max(id_col).alias("_hi"))
    return (local.join(rng, list(by), "inner")
            .where(F.col(id_col).between(F.col("_lo"), F.col("_hi"))).select(*local.columns))


def audit(official: DataFrame, local: DataFrame, by: Sequence[str] = VENUE_SYMBOL,
          id_col: str = "trade_id", key: Sequence[str] = TRADE_KEY) -> DataFrame:
    """JON-2: per instrument: archive rows, deduplicated local rows inside the archive's
    id range, archive ids missing locally, and ``passed`` (nothing missing, equal counts).

    Ids of both sides meet in one aggregate on (instrument, id), counts in a second."""
    by = list(by)
    ids = [*by, id_col]
    have = _within_archive(official, local.select(*dict.fromkeys([*ids, *key])), by, id_col).distinct()
    met = (official.select(*ids, F.lit(1).alias("_o"), F.lit(0).alias("_l"))
           .unionAll(have.select(*ids, F.lit(0).alias("_o"), F.lit(1).alias("_l")))
           .groupBy(*ids).agg(F.sum("_o").alias("_o"), F.sum("_l").alias("_l")))
    out = met.groupBy(*by).agg(
        F.sum("_o").alias("n_official"), F.sum("_l").alias("n_local"),
        F.coalesce(F.sum(F.when(F.col("_l") == 0, F.col("_o"))), F.lit(0)).alias("n_missing"))
    return out.withColumn("passed", (F.col("n_missing") == 0) & (F.col("n_official") == F.col("n_local")))


AUDIT_ATTRS = ("price", "amount", "timestamp", "side", "is_taker_buyer")


def audit_attributes(official: DataFrame, local: DataFrame, by: Sequence[str] = VENUE_SYMBOL,
                     id_col: str = "trade_id", key: Sequence[str] = TRADE_KEY,
                     attrs: Sequence[str] = AUDIT_ATTRS, digits: int = 8) -> DataFrame:
    """JON-3: ids present on both sides whose attributes differ (price and amount rounded to
    ``digits`` places, NULL-safe comparison); both values are returned."""
    by = list(by)
    rounded = {"price", "amount"}

    def norm(df: DataFrame, suffix: str) -> DataFrame:
        cols = [F.round(F.col(a), digits).alias(a + suffix) if a in rounded else F.col(a).alias(a + suffix)
                for a in attrs]
        return df.select(*by, id_col, *cols)

    # the id is part of the version key, so the range filter commutes with the dedup
    loc = latest_by_key(_within_archive(official, local, by, id_col), key)
    j = norm(official, "_official").join(norm(loc, "_local"), by + [id_col], "inner")
    differs = F.lit(False)
    for a in attrs:
        differs = differs | ~F.col(a + "_official").eqNullSafe(F.col(a + "_local"))
    return j.where(differs)


# ---------------------------------------------------------------- AGG-9..12

def feed_health(trades: DataFrame, audit_df: DataFrame, now_ms: int,
                by: Sequence[str] = VENUE_SYMBOL) -> DataFrame:
    """AGG-9: per instrument: last trade time, delay ``max(0, now - last)``, heartbeat (now)
    and integrity score 100 when the audit passed, else 0."""
    by = list(by)
    last = trades.groupBy(*by).agg(F.max("timestamp").alias("last_ts"))
    out = last.join(audit_df.select(*by, "passed"), by, "left")
    return (out.withColumn("delay_ms", F.greatest(F.lit(0), F.lit(now_ms) - F.col("last_ts")))
            .withColumn("heartbeat_ms", F.lit(now_ms))
            .withColumn("integrity_score",
                        F.when(F.coalesce("passed", F.lit(False)), F.lit(100)).otherwise(F.lit(0)))
            .drop("passed"))


def batch_metrics(df: DataFrame, name: str = "batch") -> DataFrame:
    """AGG-10: attach row-count / max-lag observations to a batch; read them from
    ``Observation.get`` or a streaming query's ``lastProgress['observedMetrics']``."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"),
                      F.max(F.col("local_timestamp") - F.col("timestamp")).alias("max_receive_latency_ms"))


def error_counts(quarantine: DataFrame, by: Sequence[str] = VENUE_SYMBOL) -> DataFrame:
    """AGG-11: undecodable / invalid messages per exchange and symbol."""
    return quarantine.groupBy(*by).agg(F.count(F.lit(1)).alias("n_errors"))


def stream_backlog(messages: DataFrame, read_positions: DataFrame | None = None,
                   by: Sequence[str] = ("exchange_id", "mkt_type", "symbol", "data_type"),
                   pos: str = "msg_id") -> DataFrame:
    """AGG-12: messages waiting per stream past its read position, plus an 'all' total per type.

    One ``GROUPING SETS ((stream), (type))`` aggregate; missing positions count everything.
    """
    by = list(by)
    m = messages
    if read_positions is not None:
        m = (m.join(read_positions.select(*by, F.col(pos).alias("_read")), by, "left")
             .where(F.col("_read").isNull() | (F.col(pos) > F.col("_read"))))
    gs = m.groupingSets([by, ["data_type"]], *by).agg(F.count(F.lit(1)).alias("n_waiting"))
    return gs.select(*[F.coalesce(F.col(c), F.lit("all")).alias(c) for c in by], "n_waiting")
