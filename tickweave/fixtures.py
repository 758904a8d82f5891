"""Trades, books and their variants derived from the ``events`` test table (FIXTURES.md §2).

The same expressions exist as DuckDB SQL in ``tickweave.oracle`` so both engines see
identical inputs. Prices sit on a 1/64 grid, volumes are integers and amounts quarter
steps, so sums are exact and the engines agree bit for bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: symbol by event_id % 4, exchange by (event_id div 4) % 2
SYMBOLS = ["BTC/USDT", "ETH/USDT", "SOL/USDT", "PEPE/USDT"]
EXCHANGES = ["binance", "okx"]
# a stored weight record (invented numbers)
W_VAMP = 0.8125
W_OFI = 0.75
INTERCEPT = -0.00390625
BEST_LAG = 100

# epoch milliseconds of the TIMESTAMP_NTZ column ``ts``, truncated, built from calendar
# fields so that no session time zone enters (timestampdiff would cast through it)
EPOCH_MS = ("(datediff(CAST(ts AS DATE), DATE'1970-01-01') * 86400000L + hour(ts) * 3600000L"
            " + minute(ts) * 60000L + CAST(floor(extract(SECOND FROM ts) * 1000) AS BIGINT))")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _symbol() -> Column:
    return F.expr("CASE event_id % 4 WHEN 0 THEN 'BTC/USDT' WHEN 1 THEN 'ETH/USDT' "
                  "WHEN 2 THEN 'SOL/USDT' ELSE 'PEPE/USDT' END")


def _exchange() -> Column:
    return F.expr("CASE (event_id DIV 4) % 2 WHEN 0 THEN 'binance' ELSE 'okx' END")


def _grid_price() -> Column:
    return F.expr("1000D + CAST(round(value * 100) AS BIGINT) / 64D")


def trades_from_events(ev: DataFrame, with_lost: bool = True) -> DataFrame:
    cols = [
        F.expr("event_id DIV 8 + 1").alias("trade_id"),
        F.expr("CAST(event_id DIV 8 + 1 AS STRING)").alias("trade_id_raw"),
        _symbol().alias("symbol"),
        _exchange().alias("exchange_id"),
        F.lit("spot").alias("mkt_type"),
        _grid_price().alias("price"),
        F.expr("0.25D * (1 + (event_id * 37) % 251)").alias("amount"),
        F.expr("CASE WHEN event_type IN ('purchase', 'click') THEN 'buy' ELSE 'sell' END").alias("side"),
        F.expr("event_type IN ('purchase', 'click')").alias("is_taker_buyer"),
        F.expr(EPOCH_MS).alias("timestamp"),
        F.expr(f"{EPOCH_MS} + user_id % 250").alias("local_timestamp"),
    ]
    if with_lost:
        cols.append(F.expr("event_type = 'error'").alias("is_lost"))
    return ev.select(*cols)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trades (the official archive); ``is_lost`` marks those the local table lacks."""
    return trades_from_events(events(spark, sf_dir))


def local_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The local table with holes: trades that were not lost."""
    return trades(spark, sf_dir).where(~F.col("is_lost")).drop("is_lost")


def archive_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trades(spark, sf_dir).drop("is_lost")


def versioned_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Local table plus a second, later version of every 'sell' row with price + 1."""
    local = local_trades(spark, sf_dir)
    newer = (local.where(F.col("side") == "sell")
             .withColumn("price", F.col("price") + F.lit(1.0))
             .withColumn("local_timestamp", F.col("local_timestamp") + F.lit(1000)))
    return local.unionByName(newer)


def books_from_events(ev: DataFrame) -> DataFrame:
    b = ev.select(
        "event_id", "user_id",
        F.expr("event_id DIV 8 + 1").alias("nonce"),
        _symbol().alias("symbol"),
        _exchange().alias("exchange_id"),
        _grid_price().alias("px"),
        F.expr(f"{EPOCH_MS} - user_id % 200").alias("timestamp"),
    )
    # 25 levels, written out level by level (same values as the transform(sequence) form,
    # but a plain array constructor stays inside whole-stage codegen)
    lv = range(25)
    ev_id, uid, px = F.col("event_id"), F.col("user_id"), F.col("px")
    return b.select(
        "nonce", "symbol", "exchange_id", F.lit("spot").alias("mkt_type"),
        F.array(*[px - F.lit((i + 1) * 0.25) for i in lv]).alias("bid_prices"),
        F.array(*[(F.lit(1) + (ev_id * 7 + F.lit(i * 3) + uid) % 13).cast("double") for i in lv]).alias("bid_volumes"),
        F.array(*[px + F.lit((i + 1) * 0.25) for i in lv]).alias("ask_prices"),
        F.array(*[(F.lit(1) + (ev_id * 5 + F.lit(i * 2) + uid) % 11).cast("double") for i in lv]).alias("ask_volumes"),
        "timestamp",
        F.expr("timestamp + user_id % 250").alias("local_timestamp"),
    )


def books(spark: SparkSession, sf_dir: str) -> DataFrame:
    return books_from_events(events(spark, sf_dir))


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All books, as quotes for the as-of join: some come later, so that some trades find a
    stale quote and the first ones of an instrument find none."""
    late = F.when(F.col("nonce") <= 3, F.lit(7200_000)).when(F.col("nonce") % 5 == 0, F.lit(150)).otherwise(F.lit(0))
    return books(spark, sf_dir).withColumn("timestamp", F.col("timestamp") + late)


def replication_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """remote = all trades; local = the older half of each instrument, PEPE/USDT left out."""
    remote = archive_trades(spark, sf_dir)
    top = remote.groupBy("exchange_id", "symbol").agg(F.max("trade_id").alias("top"))
    local = remote.where(F.col("symbol") != "PEPE/USDT").join(top, ["exchange_id", "symbol"]) \
        .where(F.col("trade_id") * 2 <= F.col("top")).select(*remote.columns)
    return remote, local


def audited_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The versioned local table, without holes for BTC/USDT."""
    whole = trades(spark, sf_dir).where(F.col("is_lost") & (F.col("symbol") == "BTC/USDT")).drop("is_lost")
    return versioned_trades(spark, sf_dir).unionByName(whole)


def patch_pair(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(archive, local): every 500th archive price is negated, and every third lost trade is
    held locally under the day before."""
    bad = F.when(F.col("trade_id") % 500 == 0, -F.col("price")).otherwise(F.col("price"))
    moved = trades(spark, sf_dir).where(F.col("is_lost") & (F.col("trade_id") % 3 == 0)).drop("is_lost") \
        .withColumn("timestamp", F.col("timestamp") - F.lit(86_400_000))
    return archive_trades(spark, sf_dir).withColumn("price", bad), versioned_trades(spark, sf_dir).unionByName(moved)


def versioned_books(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All books, and of every fourth a second, later version with the same time and nonce."""
    b = books(spark, sf_dir)
    return b.unionByName(b.where(F.col("nonce") % 4 == 0).withColumn("local_timestamp", F.col("local_timestamp") + F.lit(1000)))


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored weight record of every instrument seen in the data but one."""
    known = archive_trades(spark, sf_dir).select("exchange_id", "mkt_type", "symbol").distinct() \
        .where((F.col("exchange_id") != "okx") | (F.col("symbol") != "PEPE/USDT"))
    return known.select(
        "exchange_id", "mkt_type", "symbol",
        F.lit(W_VAMP).alias("w_vamp"),
        F.lit(W_OFI).alias("w_ofi"),
        F.lit(INTERCEPT).alias("intercept"),
        F.lit(BEST_LAG).alias("best_lag"),
    )
