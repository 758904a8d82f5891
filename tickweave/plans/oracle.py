"""DuckDB twins of the fixtures (FIXTURES.md §2), used as CTEs by the oracle queries."""

DUCK_TRADES = """
SELECT event_id // 8 + 1 AS trade_id,
       CAST(event_id // 8 + 1 AS VARCHAR) AS trade_id_raw,
       CASE event_id % 4 WHEN 0 THEN 'BTC/USDT' WHEN 1 THEN 'ETH/USDT' WHEN 2 THEN 'SOL/USDT' ELSE 'PEPE/USDT' END AS symbol,
       CASE (event_id // 4) % 2 WHEN 0 THEN 'binance' ELSE 'okx' END AS exchange_id,
       'spot' AS mkt_type,
       1000::DOUBLE + CAST(round(value * 100) AS BIGINT) / 64::DOUBLE AS price,
       0.25::DOUBLE * (1 + (event_id * 37) % 251) AS amount,
       CASE WHEN event_type IN ('purchase', 'click') THEN 'buy' ELSE 'sell' END AS side,
       event_type IN ('purchase', 'click') AS is_taker_buyer,
       epoch_us(ts) // 1000 AS timestamp,
       epoch_us(ts) // 1000 + user_id % 250 AS local_timestamp,
       event_type = 'error' AS is_lost
FROM events
"""

DUCK_BOOKS = """
WITH b AS (
  SELECT event_id, user_id, event_id // 8 + 1 AS nonce,
         CASE event_id % 4 WHEN 0 THEN 'BTC/USDT' WHEN 1 THEN 'ETH/USDT' WHEN 2 THEN 'SOL/USDT' ELSE 'PEPE/USDT' END AS symbol,
         CASE (event_id // 4) % 2 WHEN 0 THEN 'binance' ELSE 'okx' END AS exchange_id,
         1000::DOUBLE + CAST(round(value * 100) AS BIGINT) / 64::DOUBLE AS px,
         epoch_us(ts) // 1000 - user_id % 200 AS timestamp
  FROM events)
SELECT nonce, symbol, exchange_id, 'spot' AS mkt_type,
       list_transform(range(0, 25), lambda i: px - (i + 1) * 0.25::DOUBLE) AS bid_prices,
       list_transform(range(0, 25), lambda i: CAST(1 + (event_id * 7 + i * 3 + user_id) % 13 AS DOUBLE)) AS bid_volumes,
       list_transform(range(0, 25), lambda i: px + (i + 1) * 0.25::DOUBLE) AS ask_prices,
       list_transform(range(0, 25), lambda i: CAST(1 + (event_id * 5 + i * 2 + user_id) % 11 AS DOUBLE)) AS ask_volumes,
       timestamp, timestamp + user_id % 250 AS local_timestamp
FROM b
"""

# Common table expressions every oracle query may use.
BASE = f"""
trades AS ({DUCK_TRADES}),
archive AS (SELECT * EXCLUDE (is_lost) FROM trades),
local_t AS (SELECT * EXCLUDE (is_lost) FROM trades WHERE NOT is_lost),
versioned AS (
  SELECT * FROM local_t
  UNION ALL
  SELECT trade_id, trade_id_raw, symbol, exchange_id, mkt_type, price + 1.0 AS price, amount, side,
         is_taker_buyer, timestamp, local_timestamp + 1000 AS local_timestamp
  FROM local_t WHERE side = 'sell'),
books AS ({DUCK_BOOKS}),
quotes AS (SELECT * REPLACE (timestamp + CASE WHEN nonce <= 3 THEN 7200000 WHEN nonce % 5 = 0 THEN 150 ELSE 0 END AS timestamp) FROM books)
"""

# Book factors (FEA-5..7, WIN-3/4) over the books CTE; ``bf`` has the columns of
# ``windows.with_book_factors`` minus the arrays.
BOOK_FACTORS = """
bx AS (
  SELECT exchange_id, mkt_type, symbol, nonce, timestamp,
         bid_prices[1] AS pb, bid_volumes[1] AS vb, ask_prices[1] AS pa, ask_volumes[1] AS va,
         (bid_prices[1] + ask_prices[1]) / 2 AS mid_price,
         ((bid_prices[1]*bid_volumes[1] + bid_prices[2]*bid_volumes[2] + bid_prices[3]*bid_volumes[3]
           + bid_prices[4]*bid_volumes[4] + bid_prices[5]*bid_volumes[5])
          / nullif(bid_volumes[1] + bid_volumes[2] + bid_volumes[3] + bid_volumes[4] + bid_volumes[5], 0)
          + (ask_prices[1]*ask_volumes[1] + ask_prices[2]*ask_volumes[2] + ask_prices[3]*ask_volumes[3]
           + ask_prices[4]*ask_volumes[4] + ask_prices[5]*ask_volumes[5])
          / nullif(ask_volumes[1] + ask_volumes[2] + ask_volumes[3] + ask_volumes[4] + ask_volumes[5], 0)) / 2 AS vamp
  FROM books),
bs AS (
  SELECT *, (vamp - mid_price) / nullif(mid_price, 0) * 10000 AS vamp_bias_bp,
         (CASE WHEN pb > lag(pb) OVER w THEN vb WHEN pb = lag(pb) OVER w THEN vb - lag(vb) OVER w
               ELSE -lag(vb) OVER w END)
       - (CASE WHEN pa < lag(pa) OVER w THEN va WHEN pa = lag(pa) OVER w THEN va - lag(va) OVER w
               ELSE -lag(va) OVER w END) AS ofi_step
  FROM bx
  WINDOW w AS (PARTITION BY exchange_id, mkt_type, symbol ORDER BY timestamp, nonce)),
bf AS (
  SELECT exchange_id, mkt_type, symbol, nonce, timestamp, mid_price, vamp, vamp_bias_bp, ofi_step,
         CASE WHEN count(ofi_step) OVER w20 >= 20 THEN avg(ofi_step) OVER w20 END AS factor_ofi_smooth,
         (lead(mid_price, 5) OVER w - mid_price) / nullif(mid_price, 0) * 10000 AS target_5_tick,
         (lead(mid_price, 10) OVER w - mid_price) / nullif(mid_price, 0) * 10000 AS target_10_tick,
         (lead(mid_price, 20) OVER w - mid_price) / nullif(mid_price, 0) * 10000 AS target_20_tick,
         (lead(mid_price, 50) OVER w - mid_price) / nullif(mid_price, 0) * 10000 AS target_50_tick,
         (lead(mid_price, 100) OVER w - mid_price) / nullif(mid_price, 0) * 10000 AS target_100_tick
  FROM bs
  WINDOW w AS (PARTITION BY exchange_id, mkt_type, symbol ORDER BY timestamp, nonce),
         w20 AS (PARTITION BY exchange_id, mkt_type, symbol ORDER BY timestamp, nonce
                 ROWS BETWEEN 19 PRECEDING AND CURRENT ROW))
"""

# Local trade gaps (GAP-1) over local_t.
GAPS = """
gaps AS (
  SELECT exchange_id, symbol, prev + 1 AS start_id, trade_id - 1 AS end_id
  FROM (SELECT exchange_id, symbol, trade_id,
               lag(trade_id) OVER (PARTITION BY exchange_id, symbol ORDER BY trade_id) AS prev
        FROM local_t)
  WHERE trade_id - prev > 1)
"""


def with_ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in (BASE, *parts))
