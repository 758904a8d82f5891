"""Registered queries (one per operator of SURVEY §2) and their DuckDB oracles.

Every query reads the ``events`` table of the given scale-factor folder and derives
trades and books from it (``tickweave.fixtures``), so its work grows with the table.
Column names are aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave import fixtures as fx
from tickweave.functions import book as fb
from tickweave.functions import signal as fs
from tickweave.operators import gaps as gp
from tickweave.operators import joins as jn
from tickweave.operators import normalize as nm
from tickweave.operators import quality as q
from tickweave.operators import research as rs
from tickweave.operators import windows as win
from tickweave.plans import workflows as pl
from tickweave.plans.oracle import BOOK_FACTORS, GAPS, with_ctes
from tickweave.schemas import INSTRUMENT

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

NOW_MS = 1706745600000          # 2024-02-01 00:00:00 UTC, the fixed "now" of the checks
DAY = "2024-01-15"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c):
    return F.round(c, 6)


def _factors(spark, sf, lags=()):
    b = fx.books(spark, sf)
    f = win.with_book_factors(b, lags=lags)
    return f.drop("bid_prices", "bid_volumes", "ask_prices", "ask_volumes", "local_timestamp")


# ================================================================ PIP-2 (flagship)

@register("trade_features", with_ctes() + """
, d AS (
  SELECT *, CAST(epoch_ms(timestamp) AS DATE) AS date
  FROM (SELECT * FROM versioned
        QUALIFY row_number() OVER (PARTITION BY exchange_id, symbol, mkt_type, timestamp, trade_id
                                   ORDER BY local_timestamp DESC) = 1))
SELECT trade_id, trade_id_raw, symbol, mkt_type, exchange_id, epoch_ms(timestamp) AS dt, price, amount,
       price * amount AS turnover, side, is_taker_buyer,
       row_number() OVER (PARTITION BY exchange_id, mkt_type, symbol, date ORDER BY trade_id) AS sub_ms_seq,
       avg(price) OVER (PARTITION BY exchange_id, mkt_type, symbol, date ORDER BY trade_id
                        ROWS BETWEEN 100 PRECEDING AND CURRENT ROW) AS ma_price_100,
       CASE WHEN price * amount > 50000 THEN 1 ELSE 0 END AS is_high_impact,
       timestamp, date
FROM d
""")
def trade_features(spark, sf):
    """PIP-2 trades over every day: AGG-1 + FEA-8/9/10 + WIN-1/2 per instrument and day."""
    return pl.consolidate_trades(fx.versioned_trades(spark, sf))


@register("book_features", with_ctes() + """
SELECT nonce, symbol, mkt_type, exchange_id, epoch_ms(timestamp) AS dt,
       (bid_prices[1] * ask_volumes[1] + ask_prices[1] * bid_volumes[1]) / nullif(bid_volumes[1] + ask_volumes[1], 0) AS micro_price,
       (bid_volumes[1] - ask_volumes[1]) / nullif(bid_volumes[1] + ask_volumes[1], 0) AS imbalance,
       ask_prices[1] - bid_prices[1] AS spread,
       bid_prices[1:20] AS bid_prices, bid_volumes[1:20] AS bid_volumes,
       ask_prices[1:20] AS ask_prices, ask_volumes[1:20] AS ask_volumes,
       timestamp, CAST(epoch_ms(timestamp) AS DATE) AS date
FROM books
""")
def book_features(spark, sf):
    """PIP-2 books: AGG-1 + FEA-1..4 + FEA-10."""
    return pl.consolidate_books(fx.books(spark, sf))


@register("trade_features_day", with_ctes() + f"""
, d AS (
  SELECT * FROM versioned
  WHERE timestamp >= epoch_ms(TIMESTAMP '{DAY}') AND timestamp < epoch_ms(TIMESTAMP '{DAY}') + 86400000
  QUALIFY row_number() OVER (PARTITION BY exchange_id, symbol, mkt_type, timestamp, trade_id
                             ORDER BY local_timestamp DESC) = 1)
SELECT trade_id, symbol, exchange_id,
       row_number() OVER (PARTITION BY exchange_id, mkt_type, symbol ORDER BY trade_id) AS sub_ms_seq,
       avg(price) OVER (PARTITION BY exchange_id, mkt_type, symbol ORDER BY trade_id
                        ROWS BETWEEN 100 PRECEDING AND CURRENT ROW) AS ma_price_100
FROM d
""")
def trade_features_day(spark, sf):
    """PIP-2 for one date (FLT-1 pushed to the scan)."""
    return pl.consolidate_trades(fx.versioned_trades(spark, sf), DAY).select(
        "trade_id", "symbol", "exchange_id", "sub_ms_seq", "ma_price_100")


# ================================================================ WIN-*

@register("ma_price", with_ctes() + """
SELECT exchange_id, symbol, trade_id,
       avg(price) OVER (PARTITION BY exchange_id, mkt_type, symbol ORDER BY trade_id
                        ROWS BETWEEN 100 PRECEDING AND CURRENT ROW) AS ma_price_100
FROM local_t
""")
def ma_price(spark, sf):
    """WIN-2 over each whole instrument (1250 rows per instrument at sf0.01)."""
    t = win.with_ma_price(fx.local_trades(spark, sf))
    return t.select("exchange_id", "symbol", "trade_id", "ma_price_100")


@register("trade_seq", with_ctes() + """
SELECT exchange_id, symbol, trade_id,
       row_number() OVER (PARTITION BY exchange_id, mkt_type, symbol ORDER BY trade_id) AS sub_ms_seq
FROM local_t
""")
def trade_seq(spark, sf):
    """WIN-1 over each whole instrument (dense index, no row-level window)."""
    t = win.with_trade_seq(fx.local_trades(spark, sf))
    return t.select("exchange_id", "symbol", "trade_id", "sub_ms_seq")


@register("book_factors", with_ctes(BOOK_FACTORS) + """
SELECT exchange_id, mkt_type, symbol, nonce, timestamp, mid_price, vamp, vamp_bias_bp, ofi_step, factor_ofi_smooth
FROM bf
""")
def book_factors(spark, sf):
    """FEA-5..7 + WIN-3/4 (VAMP depth 5, OFI step and its 20-step mean)."""
    b = fx.books(spark, sf).withColumn("mid_price", fb.mid_price()).withColumn("vamp", fb.vamp(5)) \
        .withColumn("vamp_bias_bp", fb.vamp_bias_bp())
    f = win.with_ofi(b, 20, keep_step=True)
    return f.select("exchange_id", "mkt_type", "symbol", "nonce", "timestamp", "mid_price", "vamp",
                    "vamp_bias_bp", "ofi_step", "factor_ofi_smooth")


@register("targets", with_ctes(BOOK_FACTORS) + """
SELECT exchange_id, symbol, nonce, target_5_tick, target_10_tick, target_20_tick, target_50_tick, target_100_tick
FROM bf
""")
def targets(spark, sf):
    """WIN-5: forward mid-price returns at 5, 10, 20, 50, 100 books."""
    b = fx.books(spark, sf).withColumn("mid_price", fb.mid_price())
    return win.with_targets(b).select("exchange_id", "symbol", "nonce", *[f"target_{x}_tick" for x in win.DEFAULT_LAGS])


# ================================================================ GAP-*, JON-6, SET-2

@register("gaps", with_ctes(GAPS) + "SELECT exchange_id, symbol, start_id, end_id FROM gaps")
def gaps(spark, sf):
    """GAP-1 on the local trade table (holes where trades were lost)."""
    return gp.detect_gaps(fx.local_trades(spark, sf))


def _active_jobs(g: DataFrame) -> DataFrame:
    # jobs of gaps starting at a multiple of 3 were dispatched 100 s ago (still active),
    # those at 3k+1 two hours ago (expired); the rest were never dispatched
    j = gp.gap_jobs(g)
    return j.where(F.col("start_id") % 3 != 2).select(
        "job_id", F.when(F.col("start_id") % 3 == 0, F.lit(NOW_MS - 100_000))
        .otherwise(F.lit(NOW_MS - 7_200_000)).alias("dispatched_ms"))


@register("gap_jobs", with_ctes(GAPS) + """
SELECT exchange_id, symbol, start_id, end_id,
       md5(exchange_id || ':' || symbol || ':' || start_id || ':' || end_id) AS job_id
FROM gaps WHERE start_id % 3 <> 0
""")
def gap_jobs(spark, sf):
    """GAP-2 + FEA-15: new jobs minus those dispatched within the last hour."""
    g = gp.detect_gaps(fx.local_trades(spark, sf))
    return gp.gap_jobs(g, _active_jobs(g), NOW_MS)


@register("gap_pages", with_ctes(GAPS) + """
, wide AS (SELECT exchange_id, symbol, (start_id - 1) * 700 + 1 AS start_id, (end_id + 1) * 700 - 1 AS end_id FROM gaps)
SELECT exchange_id, symbol, start_id, end_id, p AS page_start, least(p + 999, end_id) AS page_end
FROM wide, LATERAL (SELECT unnest(range(start_id, end_id + 1, 1000)) AS p)
""")
def gap_pages(spark, sf):
    """GAP-3: pages of 1000 ids per gap; the gaps of the local table, 700 times as wide."""
    g = gp.detect_gaps(fx.local_trades(spark, sf))
    wide = g.withColumn("start_id", (F.col("start_id") - 1) * 700 + 1).withColumn("end_id", (F.col("end_id") + 1) * 700 - 1)
    return gp.gap_pages(wide)


@register("close_jobs", with_ctes(GAPS) + """
SELECT md5(exchange_id || ':' || symbol || ':' || start_id || ':' || end_id) AS job_id,
       CASE WHEN start_id % 3 = 0 THEN 1706745500000 ELSE 1706738400000 END AS dispatched_ms
FROM gaps WHERE start_id % 3 <> 2 AND end_id % 2 = 0
""")
def close_jobs(spark, sf):
    """GAP-4: active jobs minus finished ones (gaps ending on an odd id count as done)."""
    g = gp.detect_gaps(fx.local_trades(spark, sf))
    done = gp.gap_jobs(g.where(F.col("end_id") % 2 == 1))
    return gp.close_jobs(_active_jobs(g), done)


BACKFILL_SQL = "backfill AS (SELECT * FROM archive WHERE trade_id % 7 <> 0)"


def _backfill(spark, sf):
    return fx.archive_trades(spark, sf).where(F.col("trade_id") % 7 != 0)


@register("gap_fill", with_ctes(GAPS, BACKFILL_SQL) + """
SELECT * FROM backfill b
WHERE EXISTS (SELECT 1 FROM gaps g WHERE g.exchange_id = b.exchange_id AND g.symbol = b.symbol
              AND b.trade_id BETWEEN g.start_id AND g.end_id)
""")
def gap_fill(spark, sf):
    """JON-6: backfill rows that fall inside a gap (bucketed range join)."""
    g = gp.detect_gaps(fx.local_trades(spark, sf))
    return gp.fill_gaps(g, _backfill(spark, sf))[0]


@register("gap_fill_report", with_ctes(GAPS, BACKFILL_SQL) + """
SELECT g.exchange_id, g.symbol, g.start_id, g.end_id,
       g.end_id - g.start_id + 1 AS n_expected,
       count(DISTINCT b.trade_id) AS n_recovered,
       g.end_id - g.start_id + 1 - count(DISTINCT b.trade_id) AS n_missing
FROM gaps g LEFT JOIN backfill b
  ON g.exchange_id = b.exchange_id AND g.symbol = b.symbol AND b.trade_id BETWEEN g.start_id AND g.end_id
GROUP BY g.exchange_id, g.symbol, g.start_id, g.end_id
""")
def gap_fill_report(spark, sf):
    """JON-6: per gap, ids expected, recovered and still missing."""
    g = gp.detect_gaps(fx.local_trades(spark, sf))
    return gp.fill_gaps(g, _backfill(spark, sf))[1]


@register("merge_recovered", with_ctes(GAPS, BACKFILL_SQL) + """
, rec AS (SELECT * FROM backfill b
          WHERE EXISTS (SELECT 1 FROM gaps g WHERE g.exchange_id = b.exchange_id AND g.symbol = b.symbol
                        AND b.trade_id BETWEEN g.start_id AND g.end_id))
SELECT * FROM (SELECT * FROM local_t UNION ALL SELECT * FROM rec)
QUALIFY row_number() OVER (PARTITION BY exchange_id, symbol, mkt_type, timestamp, trade_id
                           ORDER BY local_timestamp DESC) = 1
""")
def merge_recovered(spark, sf):
    """SET-2: recovered rows merged back into the table (PIP-4 end to end)."""
    local = fx.local_trades(spark, sf)
    out = pl.heal(local, _backfill(spark, sf), None, NOW_MS)
    return out["merged"]


# ================================================================ JON-1..5, JON-7

@register("missing_trades", with_ctes() + """
SELECT * FROM archive a WHERE NOT EXISTS (
  SELECT 1 FROM local_t l WHERE l.exchange_id = a.exchange_id AND l.symbol = a.symbol AND l.trade_id = a.trade_id)
""")
def missing_trades(spark, sf):
    """JON-1: archive rows missing from the local table."""
    return q.missing_trades(fx.archive_trades(spark, sf), fx.local_trades(spark, sf))


AUDIT_LOCAL = """
audited AS (SELECT * FROM versioned UNION ALL SELECT * EXCLUDE (is_lost) FROM trades WHERE is_lost AND symbol = 'BTC/USDT'),
dedup AS (SELECT * FROM audited
          QUALIFY row_number() OVER (PARTITION BY exchange_id, symbol, mkt_type, timestamp, trade_id
                                     ORDER BY local_timestamp DESC) = 1),
rng AS (SELECT exchange_id, symbol, min(trade_id) AS lo, max(trade_id) AS hi, count(*) AS n_official
        FROM archive GROUP BY ALL),
loc AS (SELECT d.* FROM dedup d JOIN rng r USING (exchange_id, symbol) WHERE d.trade_id BETWEEN r.lo AND r.hi)
"""


@register("audit", with_ctes(AUDIT_LOCAL) + """
, miss AS (SELECT exchange_id, symbol, count(*) AS n_missing FROM archive a WHERE NOT EXISTS (
             SELECT 1 FROM audited l WHERE l.exchange_id = a.exchange_id AND l.symbol = a.symbol
             AND l.trade_id = a.trade_id) GROUP BY ALL),
nl AS (SELECT exchange_id, symbol, count(*) AS n_local FROM loc GROUP BY ALL)
SELECT r.exchange_id, r.symbol, r.n_official, coalesce(nl.n_local, 0) AS n_local,
       coalesce(miss.n_missing, 0) AS n_missing,
       coalesce(miss.n_missing, 0) = 0 AND r.n_official = coalesce(nl.n_local, 0) AS passed
FROM rng r LEFT JOIN nl USING (exchange_id, symbol) LEFT JOIN miss USING (exchange_id, symbol)
""")
def audit(spark, sf):
    """JON-2: archive vs deduplicated local table per instrument."""
    return q.audit(fx.archive_trades(spark, sf), fx.audited_trades(spark, sf))


@register("audit_attributes", with_ctes(AUDIT_LOCAL) + """
SELECT a.exchange_id, a.symbol, a.trade_id,
       round(a.price, 8) AS price_official, round(a.amount, 8) AS amount_official,
       a.timestamp AS timestamp_official, a.side AS side_official, a.is_taker_buyer AS is_taker_buyer_official,
       round(l.price, 8) AS price_local, round(l.amount, 8) AS amount_local,
       l.timestamp AS timestamp_local, l.side AS side_local, l.is_taker_buyer AS is_taker_buyer_local
FROM archive a JOIN loc l USING (exchange_id, symbol, trade_id)
WHERE round(a.price, 8) IS DISTINCT FROM round(l.price, 8) OR round(a.amount, 8) IS DISTINCT FROM round(l.amount, 8)
   OR a.timestamp IS DISTINCT FROM l.timestamp OR a.side IS DISTINCT FROM l.side
   OR a.is_taker_buyer IS DISTINCT FROM l.is_taker_buyer
""")
def audit_attributes(spark, sf):
    """JON-3: rows whose attributes differ between archive and the latest local version."""
    return q.audit_attributes(fx.archive_trades(spark, sf), fx.audited_trades(spark, sf))


ASOF_SQL = """
t AS (SELECT exchange_id, symbol, timestamp, trade_id, price AS trade_price, amount FROM archive),
qq AS (SELECT exchange_id, symbol, timestamp AS q_ts, nonce,
              (bid_prices[1] * ask_volumes[1] + ask_prices[1] * bid_volumes[1]) / nullif(bid_volumes[1] + ask_volumes[1], 0) AS prev_micro_price,
              (bid_volumes[1] - ask_volumes[1]) / nullif(bid_volumes[1] + ask_volumes[1], 0) AS imbalance,
              bid_prices[1] AS best_bid, ask_prices[1] AS best_ask
       FROM quotes),
j AS (SELECT t.*, qq.prev_micro_price, qq.imbalance, qq.best_bid, qq.best_ask, t.timestamp - qq.q_ts AS data_lag_ms
      FROM t ASOF LEFT JOIN qq ON t.exchange_id = qq.exchange_id AND t.symbol = qq.symbol AND t.timestamp >= qq.q_ts)
"""


@register("asof_join", with_ctes(ASOF_SQL) + "SELECT * FROM j")
def asof_join(spark, sf):
    """JON-4: every trade with the latest earlier-or-equal quote of its instrument."""
    per_trade, _ = _tca_parts(spark, sf, fresh=False)
    return per_trade


def _tca_parts(spark, sf, fresh=True):
    if fresh:
        return pl.tca(fx.archive_trades(spark, sf), fx.quotes(spark, sf))
    t = fx.archive_trades(spark, sf).select("exchange_id", "symbol", "timestamp", "trade_id",
                                             F.col("price").alias("trade_price"), "amount")
    b = fx.quotes(spark, sf).select("exchange_id", "symbol", "timestamp", "nonce",
                                    fb.micro_price().alias("prev_micro_price"), fb.imbalance().alias("imbalance"),
                                    fb.best_bid().alias("best_bid"), fb.best_ask().alias("best_ask"))
    j = jn.asof_join(t, b, right_cols=["prev_micro_price", "imbalance", "best_bid", "best_ask"], prefix="",
                     left_tie=["trade_id"])
    return j, None


TCA_SQL = ASOF_SQL + """,
f AS (SELECT *, (best_ask - trade_price) / nullif(best_ask, 0) * 1000 AS slippage_bps_buy,
             (trade_price - best_bid) / nullif(best_bid, 0) * 1000 AS slippage_bps_sell,
             trade_price * amount AS notional_usdt
      FROM j WHERE abs(data_lag_ms) <= 100),
c AS (SELECT *, CASE WHEN notional_usdt < 1000 THEN 'Retail (<1k)' WHEN notional_usdt < 10000 THEN 'Pro (1k-10k)'
                     ELSE 'Whale (>10k)' END AS trader_category FROM f)
"""


@register("tca_trades", with_ctes(TCA_SQL) + """
SELECT exchange_id, symbol, trade_id, data_lag_ms, round(slippage_bps_buy, 6) AS slippage_bps_buy,
       round(slippage_bps_sell, 6) AS slippage_bps_sell, notional_usdt, trader_category FROM c
""")
def tca_trades(spark, sf):
    """PIP-7 per trade: JON-4 -> FLT-6 -> FEA-11/12."""
    per_trade, _ = _tca_parts(spark, sf)
    return per_trade.select("exchange_id", "symbol", "trade_id", "data_lag_ms",
                            r6(F.col("slippage_bps_buy")).alias("slippage_bps_buy"),
                            r6(F.col("slippage_bps_sell")).alias("slippage_bps_sell"),
                            "notional_usdt", "trader_category")


@register("impact_by_category", with_ctes(TCA_SQL) + """
SELECT trader_category, round(avg(slippage_bps_buy), 6) AS avg_impact_cost_buy,
       round(avg(slippage_bps_sell), 6) AS avg_impact_cost_sell, count(*) AS trade_count
FROM c GROUP BY trader_category
""")
def impact_by_category(spark, sf):
    """AGG-4 (end of PIP-7): mean slippage and count per trader size."""
    _, rep = _tca_parts(spark, sf)
    return rep.select("trader_category", r6(F.col("avg_impact_cost_buy")).alias("avg_impact_cost_buy"),
                      r6(F.col("avg_impact_cost_sell")).alias("avg_impact_cost_sell"), "trade_count")


@register("incremental_rows", with_ctes() + """
, top AS (SELECT exchange_id, symbol, max(trade_id) AS top FROM archive GROUP BY ALL),
loc AS (SELECT a.* FROM archive a JOIN top USING (exchange_id, symbol) WHERE a.trade_id * 2 <= top AND symbol <> 'PEPE/USDT'),
hwm AS (SELECT exchange_id, mkt_type, symbol, max(trade_id) AS hwm FROM loc GROUP BY ALL)
SELECT a.* FROM archive a JOIN hwm h USING (exchange_id, mkt_type, symbol) WHERE a.trade_id > h.hwm
""")
def incremental_rows(spark, sf):
    """JON-5 / PIP-5: remote rows above the local high-water mark per instrument."""
    remote, local = fx.replication_pair(spark, sf)
    return pl.replicate(remote, local)["trades"]


@register("expected_work", with_ctes() + """
SELECT DISTINCT exchange_id, mkt_type, symbol, data_type
FROM archive, (SELECT unnest(['orderbook', 'trades']) AS data_type)
""")
def expected_work(spark, sf):
    """JON-7: instruments found in the data x data types."""
    return jn.expected_work(fx.archive_trades(spark, sf))


# ================================================================ AGG-1..3, AGG-9, AGG-11, AGG-12

@register("latest_by_key", with_ctes() + """
SELECT * FROM versioned
QUALIFY row_number() OVER (PARTITION BY exchange_id, symbol, mkt_type, timestamp, trade_id
                           ORDER BY local_timestamp DESC) = 1
""")
def latest_by_key(spark, sf):
    """AGG-1: newest version of every trade key."""
    return q.latest_by_key(fx.versioned_trades(spark, sf))


@register("compacted_table", ORACLE["latest_by_key"])
def compacted_table(spark, sf):
    """AGG-1 on a versioned table: two batches compacted by day, a third still loose, and one
    delivered again; rows are dealt to batches by hash, so versions of a key meet from all."""
    from tickweave.sources.versions import VersionedTable
    t = fx.versioned_trades(spark, sf)
    batch = F.pmod(F.xxhash64("trade_id", "local_timestamp"), F.lit(3))
    table = VersionedTable(spark, _scratch(spark, "versions"))
    for n in (0, 1):
        table.append(t.where(batch == n), "live", n)
    table.compact()
    table.append(t.where(batch == 2), "live", 2)
    table.append(t.where(batch == 1), "live", 1)
    return table.read_latest()


@register("last_ids", with_ctes() + "SELECT exchange_id, symbol, max(trade_id) AS last_id FROM local_t GROUP BY ALL")
def last_ids(spark, sf):
    """AGG-2."""
    return q.last_ids(fx.local_trades(spark, sf))


@register("day_coverage", with_ctes() + f"""
, cnt AS (SELECT exchange_id, symbol, count(*) AS n FROM local_t
          WHERE timestamp >= epoch_ms(TIMESTAMP '{DAY}') AND timestamp < epoch_ms(TIMESTAMP '{DAY}') + 86400000
            AND NOT (exchange_id = 'okx' AND symbol = 'SOL/USDT')
          GROUP BY ALL)
SELECT e.exchange_id, e.symbol, coalesce(cnt.n, 0) AS n_rows,
       CASE WHEN coalesce(cnt.n, 0) = 0 THEN 'full' ELSE 'partial' END AS action
FROM (SELECT DISTINCT exchange_id, symbol FROM archive) e LEFT JOIN cnt USING (exchange_id, symbol)
""")
def day_coverage(spark, sf):
    """AGG-3: rows per expected instrument on a day (one instrument's local feed is absent)."""
    local = fx.local_trades(spark, sf).where(~((F.col("exchange_id") == "okx") & (F.col("symbol") == "SOL/USDT")))
    return q.day_coverage(local, fx.archive_trades(spark, sf), DAY)


@register("feed_health", with_ctes(AUDIT_LOCAL) + f"""
, miss AS (SELECT exchange_id, symbol, count(*) AS n_missing FROM archive a WHERE NOT EXISTS (
             SELECT 1 FROM audited l WHERE l.exchange_id = a.exchange_id AND l.symbol = a.symbol
             AND l.trade_id = a.trade_id) GROUP BY ALL),
nl AS (SELECT exchange_id, symbol, count(*) AS n_local FROM loc GROUP BY ALL),
aud AS (SELECT r.exchange_id, r.symbol,
               coalesce(miss.n_missing, 0) = 0 AND r.n_official = coalesce(nl.n_local, 0) AS passed
        FROM rng r LEFT JOIN nl USING (exchange_id, symbol) LEFT JOIN miss USING (exchange_id, symbol)),
last AS (SELECT exchange_id, symbol, max(timestamp) AS last_ts FROM audited GROUP BY ALL)
SELECT l.exchange_id, l.symbol, l.last_ts, greatest(0, {NOW_MS} - l.last_ts) AS delay_ms,
       {NOW_MS} AS heartbeat_ms, CASE WHEN coalesce(a.passed, false) THEN 100 ELSE 0 END AS integrity_score
FROM last l LEFT JOIN aud a USING (exchange_id, symbol)
""")
def feed_health(spark, sf):
    """AGG-9: delay, heartbeat and integrity score per instrument."""
    v = fx.audited_trades(spark, sf)
    return q.feed_health(v, q.audit(fx.archive_trades(spark, sf), v), NOW_MS)


@register("stream_backlog", with_ctes() + """
, msgs AS (SELECT exchange_id, mkt_type, symbol, 'trades' AS data_type, trade_id AS msg_id FROM local_t
           UNION ALL SELECT exchange_id, mkt_type, symbol, 'orderbook', nonce FROM books),
pos AS (SELECT exchange_id, mkt_type, symbol, data_type, max(msg_id) // 2 AS msg_id FROM msgs GROUP BY ALL),
w AS (SELECT m.* FROM msgs m JOIN pos p USING (exchange_id, mkt_type, symbol, data_type) WHERE m.msg_id > p.msg_id)
SELECT coalesce(exchange_id, 'all') AS exchange_id, coalesce(mkt_type, 'all') AS mkt_type,
       coalesce(symbol, 'all') AS symbol, coalesce(data_type, 'all') AS data_type, count(*) AS n_waiting
FROM w GROUP BY GROUPING SETS ((exchange_id, mkt_type, symbol, data_type), (data_type))
""")
def stream_backlog(spark, sf):
    """AGG-12: waiting messages per stream past half its newest id, plus per-type totals."""
    keys = ["exchange_id", "mkt_type", "symbol", "data_type"]
    t = fx.local_trades(spark, sf).select(*INSTRUMENT, F.lit("trades").alias("data_type"),
                                          F.col("trade_id").alias("msg_id"))
    b = fx.books(spark, sf).select(*INSTRUMENT, F.lit("orderbook").alias("data_type"),
                                   F.col("nonce").alias("msg_id"))
    m = t.unionByName(b)
    pos = m.groupBy(*keys).agg(F.expr("max(msg_id) DIV 2").alias("msg_id"))
    return q.stream_backlog(m, pos)


# ================================================================ AGG-5..8, FEA-13/14/16

KEY = "exchange_id, mkt_type, symbol"
IDX_SQL = f"""
ix AS (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY timestamp, nonce) - 1 AS i,
              count(*) OVER (PARTITION BY {KEY}) AS cnt FROM bf),
base AS (SELECT *, floor(cnt * 0.7::DOUBLE) AS split FROM ix
         WHERE vamp_bias_bp IS NOT NULL AND factor_ofi_smooth IS NOT NULL AND vamp IS NOT NULL
           AND mid_price IS NOT NULL)
"""
LAGS = (5, 10, 20, 50, 100)


def _corr_sql(x: str, y: str) -> str:
    return f"covar_pop({x}, {y}) / nullif(sqrt(var_pop({x}) * var_pop({y})), 0)"


def _best_lag_sql() -> str:
    parts = []
    for L in LAGS:
        later = "".join(f" AND target_{m}_tick IS NOT NULL" for m in LAGS if m > L)
        c = f" FILTER (WHERE i + {L} < split AND target_{L}_tick IS NOT NULL{later})"
        x, y = "vamp_bias_bp", f"target_{L}_tick"
        corr = f"covar_pop({x}, {y}){c} / nullif(sqrt(var_pop({x}){c} * var_pop({y}){c}), 0)"
        parts.append(f"SELECT {KEY}, {L} AS lag, abs({corr}) AS ic FROM base GROUP BY ALL")
    return ("lagic AS (" + " UNION ALL ".join(parts) + "),\n"
            f"bl AS (SELECT *, ic IS NOT NULL AND row_number() OVER (PARTITION BY {KEY} "
            "ORDER BY ic IS NULL, ic DESC, lag) = 1 AS is_best FROM lagic)")


def _factor_frame(spark, sf, keep_index=False):
    if not keep_index:
        return _factors(spark, sf, lags=LAGS)
    f = win.with_book_factors(fx.books(spark, sf), lags=LAGS, keep_index=("_i", "_cnt"))
    return f.drop("bid_prices", "bid_volumes", "ask_prices", "ask_volumes", "local_timestamp")


@register("ic", with_ctes(BOOK_FACTORS) + f"""
SELECT {KEY}, round({_corr_sql('vamp_bias_bp', 'target_20_tick')}, 6) AS ic, count(*) AS n
FROM bf WHERE vamp_bias_bp IS NOT NULL AND target_20_tick IS NOT NULL GROUP BY ALL
""")
def ic(spark, sf):
    """AGG-5: IC of the VAMP bias against the 20-book forward return per instrument."""
    r = rs.ic(_factor_frame(spark, sf), "vamp_bias_bp", "target_20_tick", by=INSTRUMENT)
    return r.select(*INSTRUMENT, r6(F.col("ic")).alias("ic"), "n")


@register("best_lag", with_ctes(BOOK_FACTORS, IDX_SQL, _best_lag_sql()) + f"""
SELECT {KEY}, lag, round(ic, 6) AS ic, is_best FROM bl
""")
def best_lag(spark, sf):
    """AGG-6: |IC| per horizon on the first 70 % with in-slice labels, and the best horizon."""
    r = rs.best_lag(_factor_frame(spark, sf, keep_index=True))
    return r.select(*INSTRUMENT, "lag", r6(F.col("ic")).alias("ic"), "is_best")


def _moments_sql(tag: str, cond: str) -> str:
    f = f" FILTER (WHERE {cond})"
    return ", ".join([
        f"count(*){f} AS n_{tag}", f"avg(x1){f} AS m1_{tag}", f"avg(x2){f} AS m2_{tag}", f"avg(y){f} AS my_{tag}",
        f"var_pop(x1){f} AS v1_{tag}", f"var_pop(x2){f} AS v2_{tag}", f"var_pop(y){f} AS vy_{tag}",
        f"covar_pop(x1, x2){f} AS c12_{tag}", f"covar_pop(x1, y){f} AS c1y_{tag}",
        f"covar_pop(x2, y){f} AS c2y_{tag}"])


def _ols_sql(t: str) -> tuple[str, str, str]:
    det = f"nullif(v1_{t} * v2_{t} - c12_{t} * c12_{t}, 0)"
    b1 = f"((v2_{t} * c1y_{t} - c12_{t} * c2y_{t}) / {det})"
    b2 = f"((v1_{t} * c2y_{t} - c12_{t} * c1y_{t}) / {det})"
    a = f"(my_{t} - {b1} * m1_{t} - {b2} * m2_{t})"
    return b1, b2, a


def _pred_ic_sql(b1: str, b2: str, t: str) -> str:
    cov = f"({b1} * c1y_{t} + {b2} * c2y_{t})"
    vp = f"({b1} * {b1} * v1_{t} + 2 * {b1} * {b2} * c12_{t} + {b2} * {b2} * v2_{t})"
    return f"({cov} / nullif(sqrt({vp} * vy_{t}), 0))"


@register("fit_ols", with_ctes(BOOK_FACTORS) + f"""
, m AS (SELECT {KEY}, {_moments_sql('all', 'true')}
        FROM (SELECT *, vamp_bias_bp AS x1, factor_ofi_smooth AS x2, target_20_tick AS y FROM bf
              WHERE vamp_bias_bp IS NOT NULL AND factor_ofi_smooth IS NOT NULL AND target_20_tick IS NOT NULL)
        GROUP BY ALL)
SELECT {KEY}, round({_ols_sql('all')[0]}, 6) AS w_vamp, round({_ols_sql('all')[1]}, 6) AS w_ofi,
       round({_ols_sql('all')[2]}, 6) AS intercept, n_all AS n FROM m
""")
def fit_ols(spark, sf):
    """AGG-7: two-factor OLS (VAMP bias, smoothed OFI) on the 20-book return per instrument."""
    r = rs.fit_ols(_factor_frame(spark, sf), "target_20_tick", by=INSTRUMENT)
    return r.select(*INSTRUMENT, *[r6(F.col(c)).alias(c) for c in ("w_vamp", "w_ofi", "intercept")], "n")


@register("refit_moments", ORACLE["fit_ols"])
def refit_moments(spark, sf):
    """AGG-7 from the stored daily moments (PIP-6): the same weights, from records alone."""
    from tickweave.operators import moments as mo
    path = _scratch(spark, "moments")
    mo.store_moments(mo.daily_moments(_factor_frame(spark, sf), LAGS), path)
    r = mo.fit_moments(mo.merge_moments(mo.load_moments(spark, path).where("lag = 20")))
    return r.select(*INSTRUMENT, *[r6(F.col(c)).alias(c) for c in ("w_vamp", "w_ofi", "intercept")], "n")


def _evaluate_sql() -> str:
    ycase = "CASE bl.lag " + " ".join(f"WHEN {L} THEN target_{L}_tick" for L in LAGS) + " END"
    all_t = " AND ".join(f"target_{L}_tick IS NOT NULL" for L in LAGS)
    tr, al = _ols_sql("tr"), _ols_sql("all")
    return with_ctes(BOOK_FACTORS, IDX_SQL, _best_lag_sql()) + f"""
, d AS (SELECT bf.*, bl.lag AS best_lag, vamp_bias_bp AS x1, factor_ofi_smooth AS x2, {ycase} AS y
        FROM bf JOIN (SELECT * FROM bl WHERE is_best) bl USING ({KEY})),
u AS (SELECT *, row_number() OVER (PARTITION BY {KEY} ORDER BY timestamp, nonce) - 1 AS j,
             count(*) OVER (PARTITION BY {KEY}) AS mm
      FROM d WHERE x1 IS NOT NULL AND x2 IS NOT NULL AND y IS NOT NULL),
s AS (SELECT *, j < floor(mm * 0.7::DOUBLE) AS tr, x1 IS NOT NULL AND x2 IS NOT NULL AND {all_t} AS fin FROM u),
g AS (SELECT {KEY}, first(best_lag) AS best_lag, {_moments_sql('tr', 'tr')}, {_moments_sql('va', 'NOT tr')},
             {_moments_sql('all', 'true')}, {_moments_sql('fin', 'fin')} FROM s GROUP BY ALL),
h AS (SELECT *, {_pred_ic_sql(tr[0], tr[1], 'tr')} AS train_ic, {_pred_ic_sql(tr[0], tr[1], 'va')} AS valid_ic FROM g),
k AS (SELECT *, coalesce(valid_ic > 0.02, false) AS passed FROM h),
ev AS (SELECT {KEY}, best_lag, n_tr AS n_train, n_va AS n_valid, train_ic, valid_ic,
              (train_ic - valid_ic) / nullif(train_ic, 0) AS decay, passed,
              CASE WHEN passed THEN {al[0]} ELSE 0 END AS w_vamp,
              CASE WHEN passed THEN {al[1]} ELSE 0 END AS w_ofi,
              CASE WHEN passed THEN {al[2]} ELSE 0 END AS intercept,
              CASE WHEN passed THEN {_pred_ic_sql(al[0], al[1], 'fin')} END AS final_ic
       FROM k)
"""


def _evaluate_final_sql() -> str:
    return _evaluate_sql() + f"""
SELECT {KEY}, best_lag, n_train, n_valid, round(train_ic, 6) AS train_ic, round(valid_ic, 6) AS valid_ic,
       round(decay, 6) AS decay, passed, round(w_vamp, 6) AS w_vamp, round(w_ofi, 6) AS w_ofi,
       round(intercept, 6) AS intercept, round(final_ic, 6) AS final_ic
FROM ev
"""


@register("evaluate", _evaluate_final_sql())
def evaluate(spark, sf):
    """AGG-8: honest 70/30 evaluation at the best horizon, gate, refit and final IC."""
    from tickweave.operators.series import materialize
    f = materialize(_factor_frame(spark, sf, keep_index=True))
    r = rs.evaluate(f, best=rs.best_lag(f))
    rounded = ["train_ic", "valid_ic", "decay", "w_vamp", "w_ofi", "intercept", "final_ic"]
    return r.select(*[r6(F.col(c)).alias(c) if c in rounded else F.col(c) for c in r.columns])


@register("blend_weights", with_ctes(BOOK_FACTORS) + f"""
, m AS (SELECT {KEY}, {_moments_sql('all', 'true')}
        FROM (SELECT *, vamp_bias_bp AS x1, factor_ofi_smooth AS x2, target_100_tick AS y FROM bf
              WHERE vamp_bias_bp IS NOT NULL AND factor_ofi_smooth IS NOT NULL AND target_100_tick IS NOT NULL)
        GROUP BY ALL),
n AS (SELECT *, exchange_id <> 'okx' OR symbol <> 'PEPE/USDT' AS known, {_ols_sql('all')[0]} AS nv, {_ols_sql('all')[1]} AS no, {_ols_sql('all')[2]} AS ni FROM m)
SELECT {KEY}, round(CASE WHEN known AND nv IS NOT NULL THEN {fx.W_VAMP!r} * 0.8 + nv * 0.2 ELSE nv END, 6) AS w_vamp,
       round(CASE WHEN known AND no IS NOT NULL THEN {fx.W_OFI!r} * 0.8 + no * 0.2 ELSE no END, 6) AS w_ofi,
       round(ni, 6) AS intercept, 100 AS best_lag
FROM n
""")
def blend_weights(spark, sf):
    """FEA-16: stored weights blended 80/20 with a fresh fit per instrument at 100 books."""
    new = rs.fit_ols(_factor_frame(spark, sf), "target_100_tick", by=INSTRUMENT).withColumn("best_lag", F.lit(100))
    b = rs.blend_weights(fx.weights(spark, sf), new.drop("n"))
    return b.select(*INSTRUMENT, *[r6(F.col(c)).alias(c) for c in ("w_vamp", "w_ofi", "intercept")], "best_lag")


@register("combined_alpha", with_ctes(BOOK_FACTORS) + f"""
, s AS (SELECT {KEY}, nonce, CASE WHEN exchange_id <> 'okx' OR symbol <> 'PEPE/USDT' THEN vamp_bias_bp * {fx.W_VAMP!r} + factor_ofi_smooth * {fx.W_OFI!r} + {fx.INTERCEPT!r} END AS a FROM bf)
SELECT {KEY}, nonce, round(a, 6) AS combined_alpha,
       CASE WHEN a > 0.05 THEN 'buy' WHEN a < -0.05 THEN 'sell' WHEN a IS NOT NULL THEN 'none' END AS signal
FROM s
""")
def combined_alpha(spark, sf):
    """FEA-13/14: weighted signal with stored weights, and its buy/sell call (NULL without a record)."""
    f = _factors(spark, sf).join(fx.weights(spark, sf), INSTRUMENT, "left")
    f = f.withColumn("combined_alpha", fs.combined_alpha()).withColumn("signal", fs.trade_signal())
    return f.select(*INSTRUMENT, "nonce", r6(F.col("combined_alpha")).alias("combined_alpha"), "signal")


# ================================================================ RNK-*, STR-6 batch

@register("first_n", with_ctes() + """
SELECT exchange_id, symbol, nonce, timestamp FROM books ORDER BY timestamp, nonce LIMIT 500
""")
def first_n(spark, sf):
    """RNK-1: the oldest 500 books by (timestamp, nonce)."""
    return win.first_n(fx.books(spark, sf), ["timestamp", "nonce"], 500).select(
        "exchange_id", "symbol", "nonce", "timestamp")


@register("latest_n", with_ctes() + f"""
SELECT {KEY}, nonce, timestamp FROM books
QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY timestamp DESC, nonce DESC) <= 300
""")
def latest_n(spark, sf):
    """RNK-2: newest 300 books per instrument."""
    return win.latest_n(fx.books(spark, sf), INSTRUMENT, ["timestamp", "nonce"], 300).select(
        *INSTRUMENT, "nonce", "timestamp")


@register("cap_stream", with_ctes() + """
SELECT 'md:' || exchange_id || ':' || mkt_type || ':' || replace(symbol, '/', '-') || ':tick' AS stream_key, nonce
FROM books
QUALIFY row_number() OVER (PARTITION BY stream_key ORDER BY timestamp DESC, nonce DESC) <= 50
""")
def cap_stream(spark, sf):
    """RNK-3: each stream capped to its newest 50 messages."""
    b = nm.with_stream_key(fx.books(spark, sf), "orderbook")
    return win.cap_stream(b, 50).select("stream_key", "nonce")


@register("positional_split", with_ctes() + f"""
SELECT {KEY}, nonce,
       row_number() OVER w - 1 < floor(count(*) OVER (PARTITION BY {KEY}) * 0.7::DOUBLE) AS is_train
FROM books WINDOW w AS (PARTITION BY {KEY} ORDER BY timestamp, nonce)
""")
def positional_split(spark, sf):
    """RNK-5: first 70 % of each instrument's books (in time order) are train."""
    return win.positional_split(fx.books(spark, sf), INSTRUMENT, ["timestamp", "nonce"]).select(
        *INSTRUMENT, "nonce", "is_train")


@register("score_latest", with_ctes(BOOK_FACTORS) + f"""
, last AS (SELECT * FROM bf QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY timestamp DESC, nonce DESC) = 1),
s AS (SELECT *, CASE WHEN exchange_id <> 'okx' OR symbol <> 'PEPE/USDT' THEN vamp_bias_bp * {fx.W_VAMP!r} + factor_ofi_smooth * {fx.W_OFI!r} + {fx.INTERCEPT!r} END AS a FROM last)
SELECT {KEY}, nonce, timestamp, mid_price, round(a, 6) AS combined_alpha,
       CASE WHEN a > 0.05 THEN 'buy' WHEN a < -0.05 THEN 'sell' WHEN a IS NOT NULL THEN 'none' END AS signal
FROM s
""")
def score_latest(spark, sf):
    """STR-6 batch + RNK-4: newest 300 books per instrument -> factors -> signal -> latest."""
    from tickweave.streaming.scoring import score_latest as run
    r = run(fx.books(spark, sf), fx.weights(spark, sf), n=300)
    return r.select(*INSTRUMENT, "nonce", "timestamp", "mid_price",
                    r6(F.col("combined_alpha")).alias("combined_alpha"), "signal")


# ================================================================ FLT-*

@register("on_day", with_ctes() + f"""
SELECT * FROM archive
WHERE timestamp >= epoch_ms(TIMESTAMP '{DAY}') AND timestamp < epoch_ms(TIMESTAMP '{DAY}') + 86400000
""")
def on_day(spark, sf):
    """FLT-1: one UTC day of trades (range predicate pushed to the scan)."""
    return q.on_day(fx.archive_trades(spark, sf), DAY)


@register("for_instrument", with_ctes() + """
SELECT * FROM archive WHERE exchange_id = 'binance' AND symbol = 'BTC/USDT' AND mkt_type = 'spot'
""")
def for_instrument(spark, sf):
    """FLT-2."""
    return q.for_instrument(fx.archive_trades(spark, sf), "binance", "BTC/USDT", "spot")


@register("id_between", with_ctes() + "SELECT * FROM local_t WHERE trade_id BETWEEN 100 AND 200")
def id_between(spark, sf):
    """FLT-3."""
    return q.id_between(fx.local_trades(spark, sf), 100, 200)


@register("validate_report", with_ctes() + f"""
, t AS (SELECT * REPLACE (CASE WHEN trade_id % 500 = 0 THEN -price WHEN symbol = 'ETH/USDT' THEN 1000 + (price - 1000) / 16 ELSE price END AS price)
        FROM archive),
r AS (SELECT {KEY}, count(*) AS n_rows, count(*) FILTER (WHERE price <= 0) AS n_bad_price,
             min(price) FILTER (WHERE price > 0) AS min_price, max(price) FILTER (WHERE price > 0) AS max_price
      FROM t GROUP BY ALL)
SELECT *, round((max_price - min_price) / min_price, 6) AS range_ratio, coalesce((max_price - min_price) / min_price > 0.1, false) AS warn FROM r
""")
def validate_report(spark, sf):
    """FLT-4: price sanity per instrument (every 500th id carries a negated price, ETH/USDT
    moves little)."""
    p = F.col("price")
    t = fx.archive_trades(spark, sf).withColumn("price", F.when(F.col("trade_id") % 500 == 0, -p).when(
        F.col("symbol") == "ETH/USDT", F.lit(1000.0) + (p - F.lit(1000.0)) / F.lit(16.0)).otherwise(p))
    return q.validate_trades(t)[1].withColumn("range_ratio", r6(F.col("range_ratio")))


@register("validate_bad_rows", with_ctes() + """
SELECT * REPLACE (-price AS price) FROM archive WHERE trade_id % 500 = 0
""")
def validate_bad_rows(spark, sf):
    """FLT-4: the offending rows."""
    t = fx.archive_trades(spark, sf).withColumn(
        "price", F.when(F.col("trade_id") % 500 == 0, -F.col("price")).otherwise(F.col("price")))
    return q.validate_trades(t)[0]


@register("retention", with_ctes() + f"SELECT * FROM local_t WHERE local_timestamp > {NOW_MS} - 7 * 86400000")
def retention(spark, sf):
    """FLT-5: rows younger than 7 days at the fixed now."""
    return q.apply_retention(fx.local_trades(spark, sf), NOW_MS)


@register("retention_partitions", ORACLE["retention"])
def retention_partitions(spark, sf):
    """FLT-5 on the table: expired day partitions dropped, the boundary day written anew."""
    from tickweave.sources.retention import expire_partitions, read_retained
    from tickweave.sources.sinks import write_table
    path, t = _scratch(spark, "retained"), fx.local_trades(spark, sf)
    write_table(t, path, ("exchange_id", "symbol", "trade_id"))
    expire_partitions(spark, path, NOW_MS)
    return read_retained(spark, path, NOW_MS).select(*t.columns)


@register("drop_nulls", with_ctes(BOOK_FACTORS) + f"""
SELECT {KEY}, nonce FROM bf
WHERE factor_ofi_smooth IS NOT NULL AND target_100_tick IS NOT NULL AND vamp_bias_bp IS NOT NULL
""")
def drop_nulls(spark, sf):
    """FLT-7: factor rows without NULL in the model columns."""
    f = q.drop_nulls(_factor_frame(spark, sf), ["factor_ofi_smooth", "target_100_tick", "vamp_bias_bp"])
    return f.select(*INSTRUMENT, "nonce")


# ================================================================ NRM-*, SRC-4/5/9, STR-5

def _raw_live_trades(spark, sf):
    t = fx.archive_trades(spark, sf)
    m = F.when(F.col("is_taker_buyer"), F.lit("false")).otherwise(F.lit("true"))
    ibm = F.when(F.col("is_taker_buyer"), F.lit("False")).otherwise(F.lit("True"))
    info = (F.when(F.col("trade_id") % 3 == 0, F.create_map(F.lit("m"), m))
            .when(F.col("trade_id") % 3 == 1, F.create_map(F.lit("isBuyerMaker"), ibm))
            .otherwise(F.create_map().cast("map<string,string>")))
    return t.select(
        "symbol",
        F.when((F.col("side") == "sell") & (F.col("trade_id") % 50 == 0), F.concat(F.lit("x"), F.col("trade_id_raw")))
        .otherwise(F.col("trade_id_raw")).alias("id"),
        F.when(F.col("trade_id") % 40 == 0, F.lit(0).cast("long")).otherwise(F.col("timestamp")).alias("timestamp"),
        "side", "price", "amount", info.alias("info"),
        F.when(F.col("trade_id") % 97 == 0, F.lit("kraken")).otherwise(F.col("exchange_id")).alias("exchange_id"),
        "mkt_type")


RAW_LIVE_SQL = """
raw AS (SELECT symbol, trade_id, trade_id_raw, side, price, amount, mkt_type, is_taker_buyer,
               CASE WHEN side = 'sell' AND trade_id % 50 = 0 THEN 'x' || trade_id_raw ELSE trade_id_raw END AS id,
               CASE WHEN trade_id % 40 = 0 THEN 0 ELSE timestamp END AS ts,
               CASE WHEN trade_id % 97 = 0 THEN 'kraken' ELSE exchange_id END AS exchange_id
        FROM archive),
norm AS (SELECT TRY_CAST(id AS BIGINT) AS trade_id, id AS trade_id_raw, symbol, exchange_id, mkt_type, price, amount,
                side, CASE WHEN exchange_id = 'binance' AND trade_id % 3 = 2 THEN true
                           WHEN exchange_id IN ('binance', 'okx') THEN is_taker_buyer END AS is_taker_buyer,
                CASE WHEN ts = 0 THEN 1706745600000 ELSE ts END AS timestamp, 1706745600000 AS local_timestamp
         FROM raw)
"""


@register("normalize_trades", with_ctes(RAW_LIVE_SQL) + """
SELECT * FROM norm WHERE is_taker_buyer IS NOT NULL AND trade_id IS NOT NULL
""")
def normalize_trades(spark, sf):
    """NRM-1..3: live trade messages of both venues -> unified trades."""
    return nm.normalize_trades(_raw_live_trades(spark, sf), NOW_MS)[0]


@register("error_counts", with_ctes(RAW_LIVE_SQL) + """
SELECT exchange_id, symbol, count(*) AS n_errors FROM norm
WHERE is_taker_buyer IS NULL OR trade_id IS NULL GROUP BY ALL
""")
def error_counts(spark, sf):
    """AGG-11: quarantined messages per exchange and symbol."""
    return q.error_counts(nm.normalize_trades(_raw_live_trades(spark, sf), NOW_MS)[1])


@register("normalize_books", with_ctes() + f"""
SELECT nonce, symbol, exchange_id, mkt_type, bid_volumes[1] AS bid_volume, bid_prices[1] AS bid_price,
       ask_volumes[1] AS ask_volume, ask_prices[1] AS ask_price,
       bid_prices[1:20] AS bid_prices, bid_volumes[1:20] AS bid_volumes,
       ask_prices[1:20] AS ask_prices, ask_volumes[1:20] AS ask_volumes,
       CASE WHEN nonce % 9 = 0 THEN {NOW_MS} ELSE timestamp END AS timestamp, {NOW_MS} AS local_timestamp
FROM books
""")
def normalize_books(spark, sf):
    """NRM-4: raw [price, volume] books (25 levels, some without time) -> top-20 snapshots."""
    b = fx.books(spark, sf)
    pair = lambda p, v: F.zip_with(p, v, lambda x, y: F.array(x, y))
    raw = b.select("symbol", "exchange_id", "mkt_type",
                   pair(F.col("bid_prices"), F.col("bid_volumes")).alias("bids"),
                   pair(F.col("ask_prices"), F.col("ask_volumes")).alias("asks"), "nonce",
                   F.when(F.col("nonce") % 9 == 0, F.lit(None)).otherwise(F.col("timestamp")).alias("timestamp"))
    return nm.normalize_books(raw, NOW_MS)


@register("normalize_backfill", with_ctes() + f"""
SELECT trade_id, trade_id_raw, symbol, exchange_id, mkt_type, price, amount, side, is_taker_buyer,
       timestamp, {NOW_MS} AS local_timestamp FROM archive
""")
def normalize_backfill(spark, sf):
    """NRM-5: REST history rows of both venues -> unified trades (all archive trades)."""
    a = fx.archive_trades(spark, sf)
    bn = a.where(F.col("exchange_id") == "binance").select(
        F.col("trade_id").alias("id"), F.col("timestamp").alias("time"), "price", F.col("amount").alias("qty"),
        (F.col("price") * F.col("amount")).alias("quoteQty"), (~F.col("is_taker_buyer")).alias("isBuyerMaker"),
        "symbol", "exchange_id", "mkt_type")
    ok = a.where(F.col("exchange_id") == "okx").select(
        F.col("trade_id").alias("id"), "timestamp", "price", "amount", "side", "symbol", "exchange_id", "mkt_type")
    return nm.normalize_backfill(bn, NOW_MS).unionByName(nm.normalize_backfill(ok, NOW_MS))


@register("receive_latency", with_ctes() + """
SELECT exchange_id, symbol, trade_id, local_timestamp - timestamp AS receive_latency FROM local_t
""")
def receive_latency(spark, sf):
    """NRM-6: read-time latency column (created_at is the write time, not compared)."""
    t = nm.with_trade_derived(fx.local_trades(spark, sf))
    return t.select("exchange_id", "symbol", "trade_id", "receive_latency")


@register("symbol_forms", with_ctes() + """
SELECT DISTINCT exchange_id, mkt_type, symbol, replace(symbol, '/', '-') AS path_symbol,
       replace(symbol, '/', '') AS archive_symbol, lower(replace(symbol, '/', '_')) AS weight_symbol,
       'md:' || exchange_id || ':' || mkt_type || ':' || replace(symbol, '/', '-') || ':trades' AS stream_key,
       exchange_id AS key_exchange_id, mkt_type AS key_mkt_type, symbol AS key_symbol, 'trades' AS key_data_type
FROM archive
""")
def symbol_forms(spark, sf):
    """NRM-7/8: symbol spellings and stream keys, built and parsed back."""
    inst = fx.archive_trades(spark, sf).select(*INSTRUMENT).distinct()
    return nm.parse_stream_key(nm.with_stream_key(nm.symbol_forms(inst), "trades"))


@register("stream_registry", with_ctes() + """
SELECT DISTINCT 'md:' || exchange_id || ':' || mkt_type || ':' || replace(symbol, '/', '-') || ':' || t AS stream_key
FROM archive, (SELECT unnest(['tick', 'trades']) AS t)
""")
def stream_registry(spark, sf):
    """NRM-8: registry of distinct stream keys across both message types."""
    t = nm.with_stream_key(fx.archive_trades(spark, sf), "trades")
    b = nm.with_stream_key(fx.books(spark, sf), "orderbook")
    return nm.stream_registry(t.select("stream_key").unionByName(b.select("stream_key")))


PATH_SQL = """
p AS (SELECT trade_id, exchange_id, symbol,
             'data/raw/' || exchange_id || '/' || mkt_type || '/' || replace(symbol, '/', '-') || '/trades/'
             || strftime(epoch_ms(timestamp), '%Y/%m/%d') || '/trades_' || strftime(epoch_ms(timestamp), '%Y%m%d_%H')
             || '.parquet' AS file_path FROM archive)
"""


@register("trade_path_cols", with_ctes(PATH_SQL) + """
SELECT trade_id, string_split(file_path, '/')[-8] AS exchange, string_split(file_path, '/')[-7] AS mkt_type,
       string_split(file_path, '/')[-6] AS pair,
       strptime(substring(string_split(file_path, '/')[-1], 8, 8), '%Y%m%d')::DATE AS trade_date,
       substring(string_split(file_path, '/')[-1], 17, 2) AS hour
FROM p
""")
def trade_path_cols(spark, sf):
    """SRC-4: path-derived columns of the raw trade lake (paths built from each trade)."""
    from tickweave.sources.lake import lake_path, with_trade_path_cols
    t = fx.archive_trades(spark, sf)
    t = t.withColumn("file_path", lake_path("trades"))
    return with_trade_path_cols(t, "file_path").select("trade_id", "exchange", "mkt_type", "pair", "trade_date",
                                                       "hour")


@register("book_path_cols", with_ctes() + """
, p AS (SELECT nonce, exchange_id, symbol,
             'data/raw/' || exchange_id || '/' || mkt_type || '/' || replace(symbol, '/', '-') || '/orderbook/'
             || strftime(epoch_ms(timestamp), '%Y/%m/%d') || '/orderbook_' || strftime(epoch_ms(timestamp), '%Y%m%d_%H')
             || '.parquet' AS file_path FROM books)
SELECT nonce, exchange_id, symbol, string_split(file_path, '/')[-8] AS exchange, string_split(file_path, '/')[-7] AS mkt_type,
       string_split(file_path, '/')[-6] AS pair,
       strptime(substring(string_split(file_path, '/')[-1], length(string_split(file_path, '/')[-1]) - 18, 8), '%Y%m%d')::DATE AS orderbook_date,
       substring(string_split(file_path, '/')[-1], length(string_split(file_path, '/')[-1]) - 9, 2) AS hour
FROM p
""")
def book_path_cols(spark, sf):
    """SRC-5: path-derived columns of the raw book lake (date and hour counted from the end)."""
    from tickweave.sources.lake import lake_path, with_book_path_cols
    b = fx.books(spark, sf).withColumn("file_path", lake_path("orderbook"))
    return with_book_path_cols(b, "file_path").select("nonce", "exchange_id", "symbol", "exchange", "mkt_type",
                                                      "pair", "orderbook_date", "hour")


RAW_LAKE_SQL = """
SELECT {id}, exchange_id AS exchange, mkt_type, replace(symbol, '/', '-') AS pair, symbol, timestamp, {cols},
       CAST(epoch_ms(timestamp) AS DATE) AS {date}, strftime(epoch_ms(timestamp), '%H') AS hour
FROM {table}
"""


def _raw_trades(spark, sf):
    """The archive as it stands in a raw lake: ids are text, some of them unreadable."""
    return fx.archive_trades(spark, sf).withColumn("trade_id", F.when(F.col("trade_id") % 17 == 0, F.concat(F.lit("x"), "trade_id"))
                                                   .otherwise(F.col("trade_id").cast("string")))


@register("raw_trade_lake", with_ctes() + RAW_LAKE_SQL.format(id="trade_id", cols="price, amount, side", date="trade_date", table="archive")
          + "WHERE trade_id % 17 <> 0")
def raw_trade_lake(spark, sf):
    """SRC-1: all trades written into hour files of the raw lake and read again."""
    from tickweave.sources.lake import read_raw_trades, write_raw
    path = _scratch(spark, "raw-trades")
    write_raw(_raw_trades(spark, sf), path, "trades")
    return read_raw_trades(spark, path)[0].select("trade_id", "exchange", "mkt_type", "pair", "symbol", "timestamp", "price", "amount", "side",
                                                  "trade_date", "hour")


@register("raw_book_lake", with_ctes() + RAW_LAKE_SQL.format(id="nonce", cols="""
       round((bid_prices[1] * ask_volumes[1] + ask_prices[1] * bid_volumes[1]) / nullif(bid_volumes[1] + ask_volumes[1], 0), 6) AS micro_price,
       round(ask_prices[1] - bid_prices[1], 6) AS spread""", date="orderbook_date", table="books"))
def raw_book_lake(spark, sf):
    """SRC-2: all books written into hour files of the raw lake and read again."""
    from tickweave.sources.lake import read_raw_books, write_raw
    path = _scratch(spark, "raw-books")
    top = {f"{side}_{what}": F.get(f"{side}_{what}s", F.lit(0)) for side in ("bid", "ask") for what in ("price", "volume")}
    write_raw(fx.books(spark, sf).withColumns(top), path, "orderbook")
    return read_raw_books(spark, path).select("nonce", "exchange", "mkt_type", "pair", "symbol", "timestamp", r6(F.col("micro_price")).alias("micro_price"),
                                              r6(F.col("spread")).alias("spread"), "orderbook_date", "hour")


MESSAGES_SQL = """
WITH m AS (SELECT event_id, CASE event_id % 50 WHEN 0 THEN '{"k": ' WHEN 1 THEN '{"other": 1}' WHEN 2 THEN NULL ELSE props END AS data FROM events),
d AS (SELECT *, TRY_CAST(CASE WHEN json_valid(data) THEN json_extract_string(data, '$.k') END AS INTEGER) AS k FROM m)
"""


def _messages(spark, sf):
    kind = F.col("event_id") % 50
    return fx.events(spark, sf).select("event_id", F.when(kind == 0, '{"k": ').when(kind == 1, '{"other": 1}').when(kind == 2, F.lit(None))
                                       .otherwise(F.col("props")).alias("data"))


@register("decode_messages", MESSAGES_SQL + "SELECT event_id, k FROM d WHERE k IS NOT NULL")
def decode_messages(spark, sf):
    """SRC-9: JSON payload -> typed columns (events.props; some texts are cut short, lack the
    field or are missing)."""
    from tickweave.sources.messages import decode_messages as dec
    return dec(_messages(spark, sf), "data", "k INT", keep=["event_id"])[0].select("event_id", "k")


@register("decode_quarantine", MESSAGES_SQL + "SELECT event_id, data FROM d WHERE k IS NULL")
def decode_quarantine(spark, sf):
    """SRC-9: the messages that don't decode."""
    from tickweave.sources.messages import decode_messages as dec
    return dec(_messages(spark, sf), "data", "k INT", keep=["event_id"])[1].select("event_id", "data")


@register("silence_events", with_ctes("fast AS (SELECT * REPLACE (local_timestamp // 60 AS local_timestamp) FROM local_t)") + """
, g AS (SELECT exchange_id, symbol,
               local_timestamp - lag(local_timestamp) OVER (PARTITION BY exchange_id, symbol
                                                            ORDER BY local_timestamp, trade_id) AS gap_ms
        FROM fast)
SELECT exchange_id, symbol, CASE WHEN gap_ms > 60000 THEN 'dead' ELSE 'reconnect' END AS kind, count(*) AS n
FROM g WHERE gap_ms > 20000 GROUP BY ALL
""")
def silence_events(spark, sf):
    """STR-5 batch: silences over 20 s (reconnect) and over 60 s (dead feed) per instrument;
    time runs sixty times as fast."""
    from tickweave.streaming.silence import silence_events as se
    fast = fx.local_trades(spark, sf).withColumn("local_timestamp", F.expr("local_timestamp DIV 60"))
    ev = se(fast, by=["exchange_id", "symbol"], tie=["trade_id"])
    return ev.groupBy("exchange_id", "symbol", "kind").agg(F.count(F.lit(1)).alias("n"))


# ================================================================ STR-1, STR-3/4, STR-6 (end to end)

#: Events of one micro-batch at most, and micro-batches at least, so that carried state is used.
EVENTS_PER_TRIGGER, LEAST_TRIGGERS = 200_000, 4
#: Files of one micro-batch, each read by a task of its own.
FILES_PER_TRIGGER = 8


def _events_stream(spark, sf, *by: str):
    """The ``events`` table as a file stream in the order of the expressions ``by``: a range of
    at most EVENTS_PER_TRIGGER events in each micro-batch, in FILES_PER_TRIGGER files.

    The file source goes by modification times, so they are set to the order of the ranges."""
    import re
    import time

    ev = fx.events(spark, sf)
    n = max(LEAST_TRIGGERS, -(-ev.count() // EVENTS_PER_TRIGGER))
    d = _scratch(spark, "events")
    order = [F.expr(x) for x in by]
    ev.repartitionByRange(n * FILES_PER_TRIGGER, *order).sortWithinPartitions(*order) \
        .write.option("maxRecordsPerFile", EVENTS_PER_TRIGGER // FILES_PER_TRIGGER).parquet(d)
    folder = spark._jvm.org.apache.hadoop.fs.Path(d)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = [(tuple(map(int, m.groups())), f.getPath()) for f in fs.listStatus(folder) if (m := re.match(r"part-(\d+)-.*-c(\d+)", f.getPath().getName()))]
    start = (int(time.time()) - len(found)) * 1000
    for i, (_, path) in enumerate(sorted(found, key=lambda x: x[0])):
        fs.setTimes(path, start + 1000 * i, -1)
        if fs.getFileStatus(path).getModificationTime() != start + 1000 * i:
            raise RuntimeError(f"{d} doesn't keep modification times, which give the stream its order")
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", FILES_PER_TRIGGER).parquet(d)


#: Orders of the derived streams, over ``events``.
BY_TRADE, BY_ARRIVAL, BY_BOOK = ("event_id",), (f"{fx.EPOCH_MS} + user_id % 250", "event_id"), (f"{fx.EPOCH_MS} - user_id % 200", "event_id")


def _run_available_now(df_stream: DataFrame, name: str, fmt: str = "parquet") -> DataFrame:
    import uuid

    from tickweave.session import scratch_dir, stream_shuffles
    spark = df_stream.sparkSession
    d = scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")
    with stream_shuffles(spark):
        q_ = (df_stream.writeStream.format(fmt).option("checkpointLocation", d + "/_checkpoint")
              .outputMode("append").trigger(availableNow=True).start(d + "/out"))
    q_.awaitTermination()
    return spark.read.parquet(d + "/out")


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table written once: every micro-batch reads the static side of its join, and
    would work it out from all events again."""
    path = _scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@register("stream_gaps", with_ctes(GAPS) + "SELECT exchange_id, symbol, start_id, end_id FROM gaps")
def stream_gaps(spark, sf):
    """STR-3/4: keyed-state gap detector over the trade stream (equals GAP-1 on in-order input)."""
    from tickweave.streaming.gaps import stream_gaps as sg
    t = fx.trades_from_events(_events_stream(spark, sf, *BY_TRADE)).where(~F.col("is_lost")).drop("is_lost")
    return _run_available_now(sg(t), "stream-gaps").select("exchange_id", "symbol", "start_id", "end_id")


@register("stream_sync", with_ctes() + "SELECT * FROM local_t")
def stream_sync(spark, sf):
    """STR-1/2 + SNK-4 + SRC-9: trades encoded as keyed JSON messages, streamed into the
    daily-partitioned table, read back with versions resolved."""
    import uuid

    from tickweave.session import scratch_dir
    from tickweave.sources.messages import encode_messages
    from tickweave.streaming.sync import start_sync
    d = scratch_dir(spark, f"stream-sync-{uuid.uuid4().hex}")
    local = fx.local_trades(spark, sf)
    encode_messages(local, "trades").write.json(d + "/messages")
    qry = start_sync(spark, d + "/messages", "trades", d + "/table", d + "/_checkpoint",
                     quarantine_path=d + "/quarantine", trigger={"availableNow": True})
    qry.awaitTermination()
    table = spark.read.parquet(d + "/table").drop("date")
    return q.latest_by_key(table).select(*local.columns)


@register("stream_flush", with_ctes() + "SELECT * FROM local_t")
def stream_flush(spark, sf):
    """STR-1 by rows: keyed JSON messages appended to a message log, a position for each stream,
    and micro-batches into the table, of many flushes of FLUSH_ROWS messages behind the backlog
    and of one at its end; versions resolved."""
    from tickweave.session import stream_shuffles
    from tickweave.sources.log import CATCH_UP_ROWS, append_log, drain_query, read_log
    from tickweave.sources.messages import encode_messages
    from tickweave.streaming.sync import MESSAGE_SCHEMA, start_sync
    d, local = _scratch(spark, "stream-flush"), fx.local_trades(spark, sf)
    append_log(encode_messages(local, "trades"), d + "/log", "stream_key", [F.get_json_object("data", "$.trade_id").cast("long")])
    messages = read_log(spark, d + "/log", MESSAGE_SCHEMA, catch_up_rows=CATCH_UP_ROWS)
    with stream_shuffles(spark):
        query = start_sync(spark, messages, "trades", d + "/table", d + "/_checkpoint",
                           quarantine_path=d + "/quarantine", trigger={"processingTime": "0 seconds"})
    drain_query(query)
    return q.latest_by_key(spark.read.parquet(d + "/table").drop("date", "batch_id")).select(*local.columns)


@register("stream_scores", with_ctes(BOOK_FACTORS) + f"""
, s AS (SELECT *, CASE WHEN exchange_id <> 'okx' OR symbol <> 'PEPE/USDT' THEN vamp_bias_bp * {fx.W_VAMP!r} + factor_ofi_smooth * {fx.W_OFI!r} + {fx.INTERCEPT!r} END AS a FROM bf)
SELECT {KEY}, nonce, timestamp, mid_price, round(vamp_bias_bp, 6) AS vamp_bias_bp, factor_ofi_smooth, round(a, 6) AS combined_alpha,
       CASE WHEN a > 0.05 THEN 'buy' WHEN a < -0.05 THEN 'sell' WHEN a IS NOT NULL THEN 'none' END AS signal
FROM s
""")
def stream_scores(spark, sf):
    """STR-6 streaming: every book scored in order with the OFI state kept per instrument."""
    from tickweave.streaming.scoring import score_stream
    b = fx.books_from_events(_events_stream(spark, sf, *BY_BOOK))
    out = _run_available_now(score_stream(b, _stored(fx.weights(spark, sf), "weights")), "stream-scores")
    return out.select(*INSTRUMENT, "nonce", "timestamp", "mid_price", r6(F.col("vamp_bias_bp")).alias("vamp_bias_bp"),
                      "factor_ofi_smooth", r6(F.col("combined_alpha")).alias("combined_alpha"), "signal")


# ================================================================ blocked layout, checked explicitly
# The default layout is size-checked ('auto'): at these test sizes it runs the plain
# per-instrument window. These variants force the scale-out layout (range-partitioned dense
# index, 500-row blocks with halo rows) on the same inputs, against the same oracles.

BLOCK = 500


@register("ma_price_blocked", ORACLE["ma_price"])
def ma_price_blocked(spark, sf):
    """WIN-2 on the blocked layout."""
    t = win.with_ma_price(fx.local_trades(spark, sf), layout="blocked", block_rows=BLOCK)
    return t.select("exchange_id", "symbol", "trade_id", "ma_price_100")


@register("trade_seq_blocked", ORACLE["trade_seq"])
def trade_seq_blocked(spark, sf):
    """WIN-1 from the range-partitioned dense index."""
    t = win.with_trade_seq(fx.local_trades(spark, sf), layout="blocked")
    return t.select("exchange_id", "symbol", "trade_id", "sub_ms_seq")


@register("book_factors_blocked", ORACLE["book_factors"])
def book_factors_blocked(spark, sf):
    """FEA-5..7 + WIN-3/4 on the blocked layout (narrow window input, joined back)."""
    b = fx.books(spark, sf).withColumn("mid_price", fb.mid_price()).withColumn("vamp", fb.vamp(5)) \
        .withColumn("vamp_bias_bp", fb.vamp_bias_bp())
    f = win.with_ofi(b, 20, keep_step=True, layout="blocked", block_rows=BLOCK)
    return f.select("exchange_id", "mkt_type", "symbol", "nonce", "timestamp", "mid_price", "vamp",
                    "vamp_bias_bp", "ofi_step", "factor_ofi_smooth")


@register("targets_blocked", ORACLE["targets"])
def targets_blocked(spark, sf):
    """WIN-5 on the blocked layout (forward halo)."""
    b = fx.books(spark, sf).withColumn("mid_price", fb.mid_price())
    t = win.with_targets(b, layout="blocked", block_rows=BLOCK)
    return t.select("exchange_id", "symbol", "nonce", *[f"target_{x}_tick" for x in win.DEFAULT_LAGS])


@register("gaps_blocked", ORACLE["gaps"])
def gaps_blocked(spark, sf):
    """GAP-1 on the blocked layout."""
    return gp.detect_gaps(fx.local_trades(spark, sf), layout="blocked", block_rows=BLOCK)


@register("asof_join_blocked", ORACLE["asof_join"])
def asof_join_blocked(spark, sf):
    """JON-4 on ranges with the carried quote of earlier ranges."""
    t = fx.archive_trades(spark, sf).select("exchange_id", "symbol", "timestamp", "trade_id",
                                             F.col("price").alias("trade_price"), "amount")
    b = fx.quotes(spark, sf).select("exchange_id", "symbol", "timestamp", "nonce",
                                    fb.micro_price().alias("prev_micro_price"), fb.imbalance().alias("imbalance"),
                                    fb.best_bid().alias("best_bid"), fb.best_ask().alias("best_ask"))
    return jn.asof_join(t, b, right_cols=["prev_micro_price", "imbalance", "best_bid", "best_ask"], prefix="",
                        left_tie=["trade_id"], layout="blocked")


@register("positional_split_blocked", ORACLE["positional_split"])
def positional_split_blocked(spark, sf):
    """RNK-5 from the range-partitioned dense index."""
    return win.positional_split(fx.books(spark, sf), INSTRUMENT, ["timestamp", "nonce"], layout="blocked").select(
        *INSTRUMENT, "nonce", "is_train")


@register("evaluate_blocked", ORACLE["evaluate"])
def evaluate_blocked(spark, sf):
    """AGG-6/8 with factors on the blocked layout and the subset index for the split."""
    from tickweave.operators.series import materialize
    f = win.with_book_factors(fx.books(spark, sf), lags=LAGS, keep_index=("_i", "_cnt"), layout="blocked",
                              block_rows=BLOCK)
    f = materialize(f.drop("bid_prices", "bid_volumes", "ask_prices", "ask_volumes", "local_timestamp"))
    r = rs.evaluate(f, best=rs.best_lag(f))
    rounded = ["train_ic", "valid_ic", "decay", "w_vamp", "w_ofi", "intercept", "final_ic"]
    return r.select(*[r6(F.col(c)).alias(c) if c in rounded else F.col(c) for c in r.columns])



# ================================================================ SET-1, PIP-1, PIP-6

@register("concat_history", with_ctes() + f"""
SELECT {KEY}, nonce, timestamp FROM books WHERE timestamp < epoch_ms(TIMESTAMP '{DAY}')
UNION ALL
SELECT {KEY}, nonce, timestamp FROM books WHERE timestamp >= epoch_ms(TIMESTAMP '{DAY}')
""")
def concat_history(spark, sf):
    """SET-1: history (before the day) and today's books as one frame."""
    b = fx.books(spark, sf).select(*INSTRUMENT, "nonce", "timestamp")
    start = q.day_start_ms(DAY)
    return rs.concat_history(b.where(F.col("timestamp") < start), b.where(F.col("timestamp") >= start))


PATCH_SQL = f"""
poff AS (SELECT * REPLACE (CASE WHEN trade_id % 500 = 0 THEN -price ELSE price END AS price) FROM archive
         WHERE timestamp >= epoch_ms(TIMESTAMP '{DAY}') AND timestamp < epoch_ms(TIMESTAMP '{DAY}') + 86400000),
phave AS (SELECT * FROM versioned UNION ALL
          SELECT * EXCLUDE (is_lost) REPLACE (timestamp - 86400000 AS timestamp) FROM trades WHERE is_lost AND trade_id % 3 = 0),
pins AS (SELECT * FROM poff o WHERE price > 0 AND NOT EXISTS (
           SELECT 1 FROM phave h WHERE h.exchange_id = o.exchange_id AND h.symbol = o.symbol AND h.trade_id = o.trade_id)),
ploc AS (SELECT * FROM (SELECT * FROM phave UNION ALL SELECT * FROM pins)
         QUALIFY row_number() OVER (PARTITION BY exchange_id, symbol, mkt_type, timestamp, trade_id ORDER BY local_timestamp DESC) = 1),
prng AS (SELECT exchange_id, symbol, min(trade_id) AS lo, max(trade_id) AS hi, count(*) AS n_official FROM poff GROUP BY ALL),
pin AS (SELECT l.* FROM ploc l JOIN prng r USING (exchange_id, symbol) WHERE l.trade_id BETWEEN r.lo AND r.hi),
paud AS (SELECT r.exchange_id, r.symbol, r.n_official,
                (SELECT count(*) FROM pin l WHERE l.exchange_id = r.exchange_id AND l.symbol = r.symbol) AS n_local,
                (SELECT count(*) FROM poff o WHERE o.exchange_id = r.exchange_id AND o.symbol = r.symbol AND NOT EXISTS (
                   SELECT 1 FROM pin l WHERE l.exchange_id = o.exchange_id AND l.symbol = o.symbol AND l.trade_id = o.trade_id)) AS n_missing
         FROM prng r)
"""


def _patch(spark, sf, part):
    off, loc = fx.patch_pair(spark, sf)
    return pl.patch_day(off, loc, jn.expected_work(off), DAY, NOW_MS)[part]


@register("patch_day", with_ctes(PATCH_SQL) + "SELECT *, n_missing = 0 AND n_official = n_local AS passed FROM paud")
def patch_day(spark, sf):
    """PIP-1: the audit after the day's patch; rows with a bad archive price stay missing."""
    return _patch(spark, sf, "audit")


@register("daily_pipeline", with_ctes(PATCH_SQL.replace("CASE WHEN trade_id % 500 = 0 THEN -price ELSE price END", "price")) + f"""
, d AS (SELECT * FROM ploc
        WHERE timestamp >= epoch_ms(TIMESTAMP '{DAY}') AND timestamp < epoch_ms(TIMESTAMP '{DAY}') + 86400000)
SELECT trade_id, symbol, exchange_id, price,
       row_number() OVER (PARTITION BY exchange_id, mkt_type, symbol ORDER BY trade_id) AS sub_ms_seq,
       avg(price) OVER (PARTITION BY exchange_id, mkt_type, symbol ORDER BY trade_id
                        ROWS BETWEEN 100 PRECEDING AND CURRENT ROW) AS ma_price_100
FROM d
""")
def daily_pipeline(spark, sf):
    """PIP-3: the day is patched from a valid archive, consolidated and exported; the trades read
    back from the lake."""
    from tickweave.sources.lake import read_processed
    root, off = _scratch(spark, "daily"), fx.archive_trades(spark, sf)
    pl.daily_pipeline(off, fx.patch_pair(spark, sf)[1], fx.books(spark, sf), jn.expected_work(off), DAY, NOW_MS, root)
    return read_processed(spark, root, "trades").select("trade_id", "symbol", "exchange_id", "price", "sub_ms_seq", "ma_price_100")


@register("patch_inserts", with_ctes(PATCH_SQL) + "SELECT * FROM pins")
def patch_inserts(spark, sf):
    """PIP-1: archive rows of the day to insert: no bad price, and no id that the local table
    holds under any day."""
    return _patch(spark, sf, "to_insert")


@register("patch_attributes", with_ctes(PATCH_SQL) + """
SELECT a.exchange_id, a.symbol, a.trade_id,
       round(a.price, 8) AS price_official, round(a.amount, 8) AS amount_official,
       a.timestamp AS timestamp_official, a.side AS side_official, a.is_taker_buyer AS is_taker_buyer_official,
       round(l.price, 8) AS price_local, round(l.amount, 8) AS amount_local,
       l.timestamp AS timestamp_local, l.side AS side_local, l.is_taker_buyer AS is_taker_buyer_local
FROM poff a JOIN pin l USING (exchange_id, symbol, trade_id)
WHERE round(a.price, 8) IS DISTINCT FROM round(l.price, 8) OR round(a.amount, 8) IS DISTINCT FROM round(l.amount, 8)
   OR a.timestamp IS DISTINCT FROM l.timestamp OR a.side IS DISTINCT FROM l.side
   OR a.is_taker_buyer IS DISTINCT FROM l.is_taker_buyer
""")
def patch_attributes(spark, sf):
    """PIP-1: attributes that differ after the patch."""
    return _patch(spark, sf, "attributes")


@register("patch_health", with_ctes(PATCH_SQL) + f"""
, last AS (SELECT exchange_id, symbol, max(timestamp) AS last_ts FROM ploc GROUP BY ALL)
SELECT l.exchange_id, l.symbol, l.last_ts, greatest(0, {NOW_MS} - l.last_ts) AS delay_ms, {NOW_MS} AS heartbeat_ms,
       CASE WHEN coalesce(a.n_missing = 0 AND a.n_official = a.n_local, false) THEN 100 ELSE 0 END AS integrity_score
FROM last l LEFT JOIN paud a USING (exchange_id, symbol)
""")
def patch_health(spark, sf):
    """PIP-1: feed health over the patched table."""
    return _patch(spark, sf, "health")


@register("train_alpha", _evaluate_sql() + f"""
, n AS (SELECT *, exchange_id <> 'okx' OR symbol <> 'PEPE/USDT' AS known FROM ev)
SELECT {KEY}, round(CASE WHEN known THEN {fx.W_VAMP!r} * 0.8 + w_vamp * 0.2 ELSE w_vamp END, 6) AS w_vamp,
       round(CASE WHEN known THEN {fx.W_OFI!r} * 0.8 + w_ofi * 0.2 ELSE w_ofi END, 6) AS w_ofi, round(intercept, 6) AS intercept, best_lag
FROM n
""")
def train_alpha(spark, sf):
    """PIP-6: factors -> best horizon -> honest evaluation -> weights blended 80/20 with the
    stored record, for every instrument of both venues (a failed gate blends zero weights)."""
    w = pl.train_alpha(fx.books(spark, sf), fx.weights(spark, sf))["weights"]
    return w.select(*INSTRUMENT, *[r6(F.col(c)).alias(c) for c in ("w_vamp", "w_ofi", "intercept")], "best_lag")


@register("first_n_blocked", ORACLE["first_n"])
def first_n_blocked(spark, sf):
    """RNK-1 from the global dense index (no single-task merge of per-partition top-n)."""
    return win.first_n(fx.books(spark, sf), ["timestamp", "nonce"], 500, layout="blocked").select(
        "exchange_id", "symbol", "nonce", "timestamp")


@register("latest_n_blocked", ORACLE["latest_n"])
def latest_n_blocked(spark, sf):
    """RNK-2 from the per-instrument dense index in descending time."""
    return win.latest_n(fx.books(spark, sf), INSTRUMENT, ["timestamp", "nonce"], 300, layout="blocked").select(
        *INSTRUMENT, "nonce", "timestamp")


@register("cap_stream_blocked", ORACLE["cap_stream"])
def cap_stream_blocked(spark, sf):
    """RNK-3 on the blocked layout."""
    b = nm.with_stream_key(fx.books(spark, sf), "orderbook")
    return win.cap_stream(b, 50, layout="blocked").select("stream_key", "nonce")


@register("silence_alarms", with_ctes("""
fast AS (SELECT *, 'trades' AS data_type, local_timestamp // 60 AS ms FROM local_t),
g AS (SELECT exchange_id, symbol, data_type, ms, lag(ms) OVER (PARTITION BY exchange_id, symbol, data_type ORDER BY ms) AS prev FROM fast),
o AS (SELECT exchange_id, symbol, data_type, max(ms) AS prev, (SELECT max(ms) FROM fast) - 60000 AS ms FROM fast GROUP BY ALL),
s AS (SELECT exchange_id, symbol, data_type, prev, ms FROM g UNION ALL SELECT exchange_id, symbol, data_type, prev, ms FROM o)
""") + """
SELECT exchange_id, symbol, data_type, prev AS silence_start, 'reconnect' AS kind FROM s WHERE ms - prev > 20000
UNION ALL SELECT exchange_id, symbol, data_type, prev, 'dead' FROM s WHERE ms - prev > 60000
""")
def silence_alarms(spark, sf):
    """STR-5 streaming: alarms at 20 s and 60 s of silence per feed, also of feeds that fall
    silent at the end; time runs sixty times as fast."""
    from tickweave.streaming.silence import silence_alarms as alarms
    t = fx.trades_from_events(_events_stream(spark, sf, *BY_ARRIVAL)).where(~F.col("is_lost")).drop("is_lost") \
        .withColumn("local_timestamp", F.expr("local_timestamp DIV 60")).withColumn("data_type", F.lit("trades"))
    return _run_available_now(alarms(t), "alarms").select("exchange_id", "symbol", "data_type", "silence_start", "kind")


@register("stream_gap_jobs", with_ctes(GAPS) + """
SELECT exchange_id, symbol, start_id, end_id, md5(exchange_id || ':' || symbol || ':' || start_id || ':' || end_id) AS job_id
FROM gaps WHERE start_id % 3 <> 0
""")
def stream_gap_jobs(spark, sf):
    """STR-4: the detector leaves out jobs that another one has dispatched within the hour."""
    from tickweave.streaming.gaps import stream_gaps as sg
    done = gp.gap_jobs(gp.detect_gaps(fx.local_trades(spark, sf)).where(F.col("start_id") % 3 == 0)) \
        .select("job_id", F.lit(1 << 60).alias("dispatched_ms"))
    t = fx.trades_from_events(_events_stream(spark, sf, *BY_TRADE)).where(~F.col("is_lost")).drop("is_lost")
    return _run_available_now(sg(t, active=_stored(done, "dispatched")), "stream-gap-jobs").select("exchange_id", "symbol", "start_id", "end_id", "job_id")


@register("stream_job_lock", with_ctes(GAPS) + f"""
SELECT exchange_id, symbol, start_id, end_id, md5(exchange_id || ':' || symbol || ':' || start_id || ':' || end_id) AS job_id,
       {NOW_MS} + start_id % 1000 + asked.ms AS dispatched_ms
FROM gaps, (VALUES (0), (4200000)) asked(ms)
""")
def stream_job_lock(spark, sf):
    """STR-4: four detectors ask for every gap, 10, 70 and 75 minutes after the first; the lock
    holds for an hour. The query is stopped and started again between the second and third."""
    from tickweave.streaming.locks import REQUEST, start_job_lock
    d = _scratch(spark, "job-lock")
    jobs = gp.gap_jobs(gp.detect_gaps(fx.local_trades(spark, sf))).withColumn("seen_ms", F.lit(NOW_MS) + F.col("start_id") % 1000)
    for minutes in ((0, 10), (70, 75)):
        asked = jobs.withColumn("minutes", F.explode(F.array(*map(F.lit, minutes)))).withColumn("seen_ms", F.col("seen_ms") + F.col("minutes") * 60_000)
        asked.select(*REQUEST).write.mode("append").parquet(d + "/requests")
        requests = spark.readStream.schema(asked.select(*REQUEST).schema).parquet(d + "/requests")
        start_job_lock(requests, d + "/jobs", d + "/_checkpoint", trigger={"availableNow": True}).awaitTermination()
    return spark.read.parquet(d + "/jobs")


@register("activity_sessions", with_ctes("fast AS (SELECT * REPLACE (local_timestamp // 60 AS local_timestamp) FROM local_t)") + """
, g AS (SELECT exchange_id, symbol, local_timestamp,
               CASE WHEN local_timestamp - lag(local_timestamp) OVER w > 20000 THEN 1 ELSE 0 END AS new_session
        FROM fast WINDOW w AS (PARTITION BY exchange_id, symbol ORDER BY local_timestamp)),
s AS (SELECT *, sum(new_session) OVER (PARTITION BY exchange_id, symbol ORDER BY local_timestamp
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sid FROM g),
ss AS (SELECT exchange_id, symbol, count(*) AS n_messages, min(local_timestamp) AS first_ms,
              max(local_timestamp) AS last_ms FROM s GROUP BY exchange_id, symbol, sid)
SELECT * FROM ss WHERE last_ms + 20000 <= (SELECT max(local_timestamp) FROM fast) - 60000
""")
def activity_sessions(spark, sf):
    """STR-5 streaming: event-time session windows (20 s gap, 1 min watermark) over the
    trade stream; sessions closed by the watermark are emitted (the still-open last ones
    wait for more data). Time runs sixty times as fast."""
    from tickweave.streaming.silence import activity_sessions as sessions
    t = fx.trades_from_events(_events_stream(spark, sf, *BY_ARRIVAL)).where(~F.col("is_lost")).drop("is_lost") \
        .withColumn("local_timestamp", F.expr("local_timestamp DIV 60"))
    out = _run_available_now(sessions(t), "sessions")
    return out.select("exchange_id", "symbol", "n_messages", "first_ms", "last_ms")


@register("trade_features_blocked", ORACLE["trade_features"])
def trade_features_blocked(spark, sf):
    """PIP-2 trades on the blocked layout (one range pass for WIN-1 and WIN-2)."""
    return pl.consolidate_trades(fx.versioned_trades(spark, sf), layout="blocked", block_rows=BLOCK)


@register("trade_features_scheduled", with_ctes() + f"""
, d AS (
  SELECT * FROM versioned
  WHERE (exchange_id <> 'okx' AND timestamp >= {NOW_MS} - 86400000 AND timestamp < {NOW_MS})
     OR (exchange_id = 'okx' AND timestamp >= {NOW_MS} - 2 * 86400000 AND timestamp < {NOW_MS} - 86400000)
  QUALIFY row_number() OVER (PARTITION BY exchange_id, symbol, mkt_type, timestamp, trade_id
                             ORDER BY local_timestamp DESC) = 1)
SELECT trade_id, symbol, exchange_id, CAST(epoch_ms(timestamp) AS DATE) AS date,
       row_number() OVER (PARTITION BY exchange_id, mkt_type, symbol ORDER BY trade_id) AS sub_ms_seq,
       avg(price) OVER (PARTITION BY exchange_id, mkt_type, symbol ORDER BY trade_id
                        ROWS BETWEEN 100 PRECEDING AND CURRENT ROW) AS ma_price_100
FROM d
""")
def trade_features_scheduled(spark, sf):
    """PIP-2 as scheduled without a date: yesterday, two days back for okx (at the fixed now)."""
    return pl.consolidate_trades(fx.versioned_trades(spark, sf), now_ms=NOW_MS).select(
        "trade_id", "symbol", "exchange_id", "date", "sub_ms_seq", "ma_price_100")


# ================================================================ rows that share key and order

VERSIONS_MA = """
SELECT exchange_id, symbol, trade_id, local_timestamp,
       avg(price) OVER (PARTITION BY exchange_id, mkt_type, symbol ORDER BY trade_id, local_timestamp
                        ROWS BETWEEN 100 PRECEDING AND CURRENT ROW) AS ma_price_100
FROM versioned
"""


def _ma_versions(spark, sf, **how):
    t = win.with_ma_price(fx.versioned_trades(spark, sf), order=("trade_id", "local_timestamp"), **how)
    return t.select("exchange_id", "symbol", "trade_id", "local_timestamp", "ma_price_100")


@register("ma_price_versions", with_ctes() + VERSIONS_MA)
def ma_price_versions(spark, sf):
    """WIN-2 over rows of which several share a trade id."""
    return _ma_versions(spark, sf)


@register("ma_price_versions_blocked", with_ctes() + VERSIONS_MA)
def ma_price_versions_blocked(spark, sf):
    """The same on the blocked layout."""
    return _ma_versions(spark, sf, layout="blocked", block_rows=BLOCK)


VERSIONS_BOOKS = """
vb AS (SELECT * FROM books UNION ALL SELECT * REPLACE (local_timestamp + 1000 AS local_timestamp) FROM books WHERE nonce % 4 = 0),
vx AS (SELECT exchange_id, mkt_type, symbol, nonce, timestamp, local_timestamp, bid_prices[1] AS pb, bid_volumes[1] AS vv, ask_prices[1] AS pa,
              ask_volumes[1] AS va FROM vb),
vs AS (SELECT *, (CASE WHEN pb > lag(pb) OVER w THEN vv WHEN pb = lag(pb) OVER w THEN vv - lag(vv) OVER w ELSE -lag(vv) OVER w END)
               - (CASE WHEN pa < lag(pa) OVER w THEN va WHEN pa = lag(pa) OVER w THEN va - lag(va) OVER w ELSE -lag(va) OVER w END) AS ofi_step
       FROM vx WINDOW w AS (PARTITION BY exchange_id, mkt_type, symbol ORDER BY timestamp, nonce, local_timestamp))
"""


@register("book_factors_versions", with_ctes(VERSIONS_BOOKS) + f"""
SELECT {KEY}, nonce, local_timestamp, ofi_step,
       CASE WHEN count(ofi_step) OVER w20 >= 20 THEN avg(ofi_step) OVER w20 END AS factor_ofi_smooth
FROM vs WINDOW w20 AS (PARTITION BY {KEY} ORDER BY timestamp, nonce, local_timestamp ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)
""")
def book_factors_versions(spark, sf):
    """WIN-3/4 on the blocked layout over books of which several share time and nonce."""
    f = win.with_ofi(fx.versioned_books(spark, sf), 20, order=("timestamp", "nonce", "local_timestamp"), keep_step=True, layout="blocked",
                     block_rows=BLOCK)
    return f.select(*INSTRUMENT, "nonce", "local_timestamp", "ofi_step", "factor_ofi_smooth")


@register("asof_join_versions", with_ctes() + """
, t AS (SELECT exchange_id, symbol, timestamp, trade_id, local_timestamp FROM versioned),
qq AS (SELECT exchange_id, symbol, timestamp AS q_ts, max(nonce) AS ob_nonce FROM quotes GROUP BY ALL)
SELECT t.*, qq.ob_nonce, t.timestamp - qq.q_ts AS data_lag_ms
FROM t ASOF LEFT JOIN qq ON t.exchange_id = qq.exchange_id AND t.symbol = qq.symbol AND t.timestamp >= qq.q_ts
""")
def asof_join_versions(spark, sf):
    """JON-4 on time bins with several versions of a trade: each comes out once."""
    t = fx.versioned_trades(spark, sf).select("exchange_id", "symbol", "timestamp", "trade_id", "local_timestamp")
    b = fx.quotes(spark, sf).select("exchange_id", "symbol", "timestamp", "nonce")
    return jn.asof_join(t, b, right_cols=["nonce"], left_tie=["trade_id"], layout="blocked")


# ================================================================ written and read again (SRC-3/6/7/8, SNK-1..3/5, AGG-10, STR-2)

def _scratch(spark, name):
    import uuid

    from tickweave.session import scratch_dir
    return scratch_dir(spark, f"{name}-{uuid.uuid4().hex}")


@register("append_table", with_ctes() + "SELECT * FROM local_t")
def append_table(spark, sf):
    """SNK-1: two appends make one table."""
    from tickweave.sources.sinks import append_table as append
    path, t = _scratch(spark, "append"), fx.local_trades(spark, sf)
    for odd in (0, 1):
        append(t.where(F.col("trade_id") % 2 == odd), path)
    return spark.read.parquet(path).select(*t.columns)


@register("write_table", with_ctes() + "SELECT *, CAST(epoch_ms(local_timestamp) AS DATE) AS date FROM local_t")
def write_table(spark, sf):
    """SNK-2: the daily-partitioned table; a second write replaces the first."""
    from tickweave.sources.sinks import write_table as write
    path, t = _scratch(spark, "table"), fx.local_trades(spark, sf)
    for _ in range(2):
        write(t, path, ["exchange_id", "symbol", "trade_id"], mode="overwrite")
    return spark.read.parquet(path).select(*t.columns, "date")


def _exported(spark, sf):
    """The processed lake of all books, exported twice."""
    from tickweave.sources.sinks import export_daily
    root = _scratch(spark, "processed")
    for _ in range(2):
        export_daily(pl.consolidate_books(fx.books(spark, sf)), root, "orderbook")
    return root


@register("processed_lake", with_ctes() + f"""
SELECT {KEY}, nonce, timestamp, CAST(epoch_ms(timestamp) AS DATE) AS orderbook_date, CAST(hour(epoch_ms(timestamp)) AS INTEGER) AS hour FROM books
""")
def processed_lake(spark, sf):
    """SNK-3 + SRC-3: the feature export, written twice, read by its partitions."""
    from tickweave.sources.lake import read_processed
    return read_processed(spark, _exported(spark, sf), "orderbook").select(*INSTRUMENT, "nonce", "timestamp", "orderbook_date", "hour")


@register("load_history", with_ctes() + f"""
, d AS (SELECT DISTINCT {KEY}, CAST(epoch_ms(timestamp) AS DATE) AS date FROM books),
n AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY {KEY} ORDER BY date DESC) <= 3)
SELECT b.exchange_id, b.symbol, b.nonce, b.timestamp, (b.bid_prices[1] + b.ask_prices[1]) / 2 AS mid_price
FROM books b JOIN n ON n.exchange_id = b.exchange_id AND n.symbol = b.symbol AND n.date = CAST(epoch_ms(b.timestamp) AS DATE)
""")
def load_history(spark, sf):
    """SRC-8: the three newest days of every instrument's processed books."""
    from tickweave.sources.lake import load_history as load
    root, out = _exported(spark, sf), None
    for e in fx.EXCHANGES:
        for s in fx.SYMBOLS:
            h = load(spark, root, e, "spot", s, days=3).select(F.lit(e).alias("exchange_id"), "symbol", "nonce", "timestamp", "mid_price")
            out = h if out is None else out.unionByName(h)
    return out


@register("weights_roundtrip", with_ctes() + f"""
SELECT DISTINCT {KEY}, {fx.W_VAMP!r}::DOUBLE AS w_vamp, {fx.W_OFI!r}::DOUBLE AS w_ofi, {fx.INTERCEPT!r}::DOUBLE AS intercept, {fx.BEST_LAG} AS best_lag
FROM archive WHERE exchange_id <> 'okx' OR symbol <> 'PEPE/USDT'
""")
def weights_roundtrip(spark, sf):
    """SNK-5: weight records written as JSON and read with their schema."""
    from tickweave.sources.sinks import load_weights, save_weights
    path = _scratch(spark, "weights")
    save_weights(fx.weights(spark, sf), path)
    return load_weights(spark, path)


ARCHIVE_SQL = f"""
SELECT trade_id, trade_id_raw, exchange_id, symbol, mkt_type, price, amount, timestamp, side, is_taker_buyer, {NOW_MS} AS local_timestamp
FROM archive WHERE exchange_id = '%s' AND trade_id %% 100 <> 0
"""


def _archive(spark, sf, exchange, row, read, **csv):
    """Each symbol's trades written as archive files, every hundredth row cut short, read back."""
    good = bad = None
    for s in fx.SYMBOLS:
        path = _scratch(spark, exchange)
        t = fx.archive_trades(spark, sf).where((F.col("exchange_id") == exchange) & (F.col("symbol") == s))
        cut = lambda c: F.when(F.col("trade_id") % 100 == 0, F.lit("?")).otherwise(c.cast("string"))
        t.select(*[(cut(c) if n == "price" else c.cast("string")).alias(n) for n, c in row.items()]).write.csv(path, **csv)
        a, b = read(spark, path, s, NOW_MS)
        good, bad = (a, b) if good is None else (good.unionByName(a), bad.unionByName(b))
    return good, bad


def _binance_files(spark, sf):
    from tickweave.sources.archive import split_binance_archive
    c = F.col
    row = {"trade_id": c("trade_id"), "price": c("price"), "amount": c("amount"), "cost": c("price") * c("amount"),
           "timestamp": c("timestamp") * 1000 + 7, "is_maker": ~c("is_taker_buyer"), "is_best": F.lit(True)}
    return _archive(spark, sf, "binance", row, split_binance_archive)


def _okx_files(spark, sf):
    from tickweave.sources.archive import split_okx_archive
    c = F.col
    row = {"trade_id": c("trade_id"), "side": c("side"), "price": c("price"), "size": c("amount"), "created_time": c("timestamp")}
    return _archive(spark, sf, "okx", row, split_okx_archive, header=True)


@register("binance_archive", with_ctes() + ARCHIVE_SQL % "binance")
def binance_archive(spark, sf):
    """SRC-6: headerless archive files of every symbol, without the rows that don't parse."""
    return _binance_files(spark, sf)[0]


@register("okx_archive", with_ctes() + ARCHIVE_SQL % "okx")
def okx_archive(spark, sf):
    """SRC-7: archive files with a header, without the rows that don't parse."""
    return _okx_files(spark, sf)[0]


@register("archive_quarantine", with_ctes() + """
SELECT exchange_id, symbol, CAST(trade_id AS VARCHAR) AS trade_id FROM archive WHERE trade_id % 100 = 0
""")
def archive_quarantine(spark, sf):
    """SRC-6/7: the archive rows that don't parse."""
    out = [bad.select(F.lit(e).alias("exchange_id"), "symbol", "trade_id")
           for e, (_, bad) in (("binance", _binance_files(spark, sf)), ("okx", _okx_files(spark, sf)))]
    return out[0].unionByName(out[1])


def _synced(spark, sf, metrics=False):
    """Messages of one venue, then of the other, through one resumed sync query."""
    from tickweave.sources.messages import encode_messages
    from tickweave.streaming.sync import start_sync
    d, local = _scratch(spark, "stream"), fx.local_trades(spark, sf)
    for e in fx.EXCHANGES:
        encode_messages(local.where(F.col("exchange_id") == e), "trades").unionByName(
            spark.range(3).select(F.lit("md:x").alias("stream_key"), F.lit("{broken").alias("data"))).write.mode("append").json(d + "/messages")
        start_sync(spark, d + "/messages", "trades", d + "/table", d + "/_checkpoint", quarantine_path=d + "/quarantine",
                   trigger={"availableNow": True}, metrics_path=d + "/metrics").awaitTermination()
    return d, local.columns


@register("stream_new_streams", with_ctes() + "SELECT * FROM local_t")
def stream_new_streams(spark, sf):
    """STR-2: streams that appear after the first run are picked up by the resumed query."""
    d, cols = _synced(spark, sf)
    return spark.read.parquet(d + "/table").select(*cols)


@register("stream_metrics", with_ctes() + """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(6 AS BIGINT) AS rows_quarantined FROM local_t
""")
def stream_metrics(spark, sf):
    """AGG-10: what the micro-batches observed adds up to the table and the quarantine."""
    d, _ = _synced(spark, sf)
    return spark.read.parquet(d + "/metrics").agg(F.sum("rows").alias("rows"), F.sum("rows_quarantined").alias("rows_quarantined"))


@register("replicate_books", with_ctes() + f"""
, mark AS (SELECT {KEY}, max(nonce) // 2 AS m FROM books WHERE symbol <> 'PEPE/USDT' GROUP BY ALL)
SELECT b.exchange_id, b.mkt_type, b.symbol, b.nonce FROM books b LEFT JOIN mark USING ({KEY}) WHERE b.symbol <> 'PEPE/USDT'
""")
def replicate_books(spark, sf):
    """PIP-5 for books: the rows above the local marks are appended to the local table."""
    from tickweave.sources.sinks import append_table as append
    b = fx.books(spark, sf)
    top = b.groupBy(*INSTRUMENT).agg(F.max("nonce").alias("top"))
    local = b.join(top, INSTRUMENT).where((F.col("symbol") != "PEPE/USDT") & (F.col("nonce") <= F.expr("top DIV 2"))).select(*b.columns)
    path, key = _scratch(spark, "replica"), [*INSTRUMENT, "timestamp", "nonce"]
    append(local, path, key)
    append(jn.incremental_rows(b, spark.read.parquet(path), INSTRUMENT, "nonce"), path, key)
    return spark.read.parquet(path).select(*INSTRUMENT, "nonce")
