"""Normalisers: exchange-specific raw rows -> unified trades and books (NRM-1..8).

The reference converts one message at a time in Python; here each rule is a column
expression applied to the whole frame, and rows no rule accepts go to a quarantine frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions import keys as fk

KNOWN_EXCHANGES = ("binance", "okx")


def _now(now_ms: int | None) -> Column:
    if now_ms is not None:
        return F.lit(int(now_ms)).cast("long")
    return F.unix_millis(F.current_timestamp())


def taker_buyer() -> Column:
    """NRM-1/2: taker side per exchange.

    binance: flag = info['m'], else whether info['isBuyerMaker'] reads 'true'; the flag is
    read as text 'true' (any case); taker buyer = NOT flag, so a missing flag means buyer.
    okx: taker buyer = side = 'buy'. Other exchanges: NULL (quarantined).
    """
    info = F.col("info")
    ibm = F.lower(F.coalesce(F.element_at(info, F.lit("isBuyerMaker")), F.lit(""))) == F.lit("true")
    flag = F.coalesce(F.element_at(info, F.lit("m")), ibm.cast("string"))
    is_m = F.lower(flag) == F.lit("true")
    ex = F.lower(F.col("exchange_id"))
    return (F.when(ex == F.lit("binance"), ~is_m)
            .when(ex == F.lit("okx"), F.col("side") == F.lit("buy")))


def normalize_trades(df: DataFrame, now_ms: int | None = None) -> tuple[DataFrame, DataFrame]:
    """NRM-1..3: live trade messages (symbol, id, timestamp, side, price, amount, info,
    exchange_id, mkt_type) -> (unified trades, quarantine).

    Integer id plus the raw text id; a zero or missing timestamp becomes the ingest time;
    ``local_timestamp`` is the ingest time. Rows of unknown exchanges or with an id that is
    not an integer are quarantined with a ``reason``.
    """
    now = _now(now_ms)
    x = df.select(
        F.col("id").cast("string").try_cast("long").alias("trade_id"),
        F.col("id").cast("string").alias("trade_id_raw"),
        "symbol", "exchange_id", "mkt_type",
        F.col("price").cast("double").alias("price"),
        F.col("amount").cast("double").alias("amount"),
        "side",
        taker_buyer().alias("is_taker_buyer"),
        F.coalesce(F.nullif(F.col("timestamp").cast("long"), F.lit(0).cast("long")), now).alias("timestamp"),
        now.alias("local_timestamp"),
    )
    known = F.coalesce(F.lower(F.col("exchange_id")).isin("binance", "okx"), F.lit(False))
    reason = (F.when(~known, F.lit("unknown exchange"))
              .when(F.col("trade_id").isNull(), F.lit("bad id"))
              .when(F.col("is_taker_buyer").isNull(), F.lit("no side")))
    x = x.withColumn("_reason", reason)
    good = x.where(F.col("_reason").isNull()).drop("_reason")
    bad = x.where(F.col("_reason").isNotNull()).withColumnRenamed("_reason", "reason")
    return good, bad


def normalize_books(df: DataFrame, now_ms: int | None = None, depth: int = 20) -> DataFrame:
    """NRM-4: raw books (``bids``/``asks`` arrays of [price, volume]) -> snapshots.

    Best level columns, the first ``depth`` levels split into price and volume arrays, a
    missing timestamp becomes the ingest time.
    """
    now = _now(now_ms)
    bids, asks = F.slice(F.col("bids"), 1, depth), F.slice(F.col("asks"), 1, depth)
    lv = lambda side, i, j: F.get(F.get(F.col(side), i), j)
    return df.select(
        F.col("nonce").cast("long").alias("nonce"), "symbol", "exchange_id", "mkt_type",
        lv("bids", 0, 1).alias("bid_volume"), lv("bids", 0, 0).alias("bid_price"),
        lv("asks", 0, 1).alias("ask_volume"), lv("asks", 0, 0).alias("ask_price"),
        F.transform(bids, lambda r: F.get(r, 0)).alias("bid_prices"),
        F.transform(bids, lambda r: F.get(r, 1)).alias("bid_volumes"),
        F.transform(asks, lambda r: F.get(r, 0)).alias("ask_prices"),
        F.transform(asks, lambda r: F.get(r, 1)).alias("ask_volumes"),
        F.coalesce(F.col("timestamp").cast("long"), now).alias("timestamp"),
        now.alias("local_timestamp"),
    )


def normalize_backfill(df: DataFrame, now_ms: int | None = None) -> DataFrame:
    """NRM-5: historical-trade REST rows -> unified trades.

    binance rows (id, time, price, qty, quoteQty, isBuyerMaker): side 'sell' when the buyer
    is maker, taker buyer = NOT isBuyerMaker. okx rows carry ``side`` (and ``timestamp``,
    ``amount``): passed through, taker buyer = side <> 'sell'. ``exchange_id``, ``symbol``,
    ``mkt_type`` columns must be present.
    """
    now = _now(now_ms)
    cols = set(df.columns)
    ibm = F.col("isBuyerMaker") if "isBuyerMaker" in cols else F.lit(None).cast("boolean")
    side_in = F.col("side") if "side" in cols else F.lit(None).cast("string")
    ts_in = F.col("time") if "time" in cols else F.col("timestamp")
    amt_in = F.col("qty") if "qty" in cols else F.col("amount")
    is_binance = F.lower(F.col("exchange_id")) == F.lit("binance")
    side = F.when(is_binance, F.when(ibm, F.lit("sell")).otherwise(F.lit("buy"))).otherwise(side_in)
    taker = F.when(is_binance, ~ibm).otherwise(side_in != F.lit("sell"))
    return df.select(
        F.col("id").cast("long").alias("trade_id"), F.col("id").cast("string").alias("trade_id_raw"),
        "symbol", "exchange_id", "mkt_type",
        F.col("price").cast("double").alias("price"), amt_in.cast("double").alias("amount"),
        side.alias("side"), taker.alias("is_taker_buyer"),
        ts_in.cast("long").alias("timestamp"), now.alias("local_timestamp"),
    )


def with_trade_derived(df: DataFrame, created_at: Column | None = None) -> DataFrame:
    """NRM-6: ``created_at`` (write time) and ``receive_latency = local_timestamp - timestamp``."""
    return (df.withColumn("created_at", created_at if created_at is not None else F.current_timestamp())
            .withColumn("receive_latency", F.col("local_timestamp") - F.col("timestamp")))


def symbol_forms(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """NRM-7: path (BTC-USDT), archive (BTCUSDT) and weight-file (btc_usdt) spellings."""
    return (df.withColumn("path_symbol", fk.path_symbol(symbol))
            .withColumn("archive_symbol", fk.archive_symbol(symbol))
            .withColumn("weight_symbol", fk.weight_symbol(symbol)))


def with_stream_key(df: DataFrame, data_type: str | Column = "trades", out: str = "stream_key") -> DataFrame:
    """NRM-8: ``md:<exchange>:<mkt>:<pair>:<tick|trades>``."""
    return df.withColumn(out, fk.stream_key(data_type))


def parse_stream_key(df: DataFrame, col: str = "stream_key") -> DataFrame:
    """NRM-8: split a stream key back into exchange, market, symbol (BTC/USDT) and type."""
    p = F.split(F.col(col), ":")
    suffix = F.get(p, 4)
    return (df.withColumn("key_exchange_id", F.get(p, 1))
            .withColumn("key_mkt_type", F.get(p, 2))
            .withColumn("key_symbol", F.translate(F.get(p, 3), "-", "/"))
            .withColumn("key_data_type", F.when(suffix == F.lit("tick"), F.lit("orderbook")).otherwise(suffix)))


def stream_registry(df: DataFrame, col: str = "stream_key") -> DataFrame:
    """NRM-8: the distinct stream keys seen (registry of active streams)."""
    return df.select(col).distinct()
