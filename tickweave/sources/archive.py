"""Official daily trade archives (SRC-6, SRC-7) -> unified trade rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.schemas import BINANCE_ARCHIVE, OKX_ARCHIVE

UNIFIED = ["trade_id", "trade_id_raw", "exchange_id", "symbol", "mkt_type", "price", "amount", "timestamp",
           "side", "is_taker_buyer", "local_timestamp"]


def _read_csv(spark: SparkSession, path: str, schema: T.StructType, header: bool) -> DataFrame:
    """Text columns of ``schema`` and ``_ok``: all that are needed parse."""
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    df = (spark.read.csv(path, header=True, inferSchema=False).select(*schema.fieldNames()) if header
          else spark.read.csv(path, schema=text, header=False))
    ok = F.lit(True)
    for f in schema.fields:
        ok = ok & F.col(f.name).try_cast(f.dataType).isNotNull()
    return df.withColumn("_ok", ok)


def _typed(df: DataFrame, schema: T.StructType, *more: str) -> DataFrame:
    return df.where("_ok").select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema.fields], *more)


def _unify_binance(df: DataFrame, load_ms: int) -> DataFrame:
    """Time in microseconds -> ms (integer division); side 'buy' when the buyer is not maker."""
    return df.select(
        F.col("trade_id"), F.col("trade_id").cast("string").alias("trade_id_raw"), F.lit("binance").alias("exchange_id"), "symbol",
        F.lit("spot").alias("mkt_type"), "price", "amount", F.expr("timestamp DIV 1000").alias("timestamp"),
        F.when(~F.col("is_maker"), F.lit("buy")).otherwise(F.lit("sell")).alias("side"),
        (~F.col("is_maker")).alias("is_taker_buyer"), F.lit(int(load_ms)).cast("long").alias("local_timestamp")).select(*UNIFIED)


def _unify_okx(df: DataFrame, load_ms: int) -> DataFrame:
    return df.select(
        F.col("trade_id"), F.col("trade_id").cast("string").alias("trade_id_raw"), F.lit("okx").alias("exchange_id"), "symbol",
        F.lit("spot").alias("mkt_type"), "price", F.col("size").alias("amount"), F.col("created_time").alias("timestamp"), "side",
        (F.col("side") == F.lit("buy")).alias("is_taker_buyer"), F.lit(int(load_ms)).cast("long").alias("local_timestamp")).select(*UNIFIED)


def split_binance_archive(spark: SparkSession, path: str, symbol: str, load_ms: int) -> tuple[DataFrame, DataFrame]:
    """SRC-6: headerless 7-column CSV -> (unified trades, rows that don't parse, as text)."""
    df = _read_csv(spark, path, BINANCE_ARCHIVE, header=False).withColumn("symbol", F.lit(symbol))
    return _unify_binance(_typed(df, BINANCE_ARCHIVE, "symbol"), load_ms), df.where(~F.col("_ok")).drop("_ok")


def split_okx_archive(spark: SparkSession, path: str, symbol: str, load_ms: int) -> tuple[DataFrame, DataFrame]:
    """SRC-7: CSV with header; uses trade_id, side, price, size, created_time (ms) ->
    (unified trades, rows that don't parse, as text)."""
    df = _read_csv(spark, path, OKX_ARCHIVE, header=True).withColumn("symbol", F.lit(symbol))
    return _unify_okx(_typed(df, OKX_ARCHIVE, "symbol"), load_ms), df.where(~F.col("_ok")).drop("_ok")


def read_binance_archive(spark: SparkSession, path: str, symbol: str, load_ms: int) -> DataFrame:
    """SRC-6: the trades of ``split_binance_archive``."""
    return split_binance_archive(spark, path, symbol, load_ms)[0]


def read_okx_archive(spark: SparkSession, path: str, symbol: str, load_ms: int) -> DataFrame:
    """SRC-7: the trades of ``split_okx_archive``."""
    return split_okx_archive(spark, path, symbol, load_ms)[0]


def _file_name() -> Column:
    return F.col("_metadata.file_name")


def read_binance_archives(spark: SparkSession, path_glob: str, symbols: list[str], load_ms: int) -> DataFrame:
    """SRC-6 over many daily files at once (every symbol and day in one scan): the symbol
    comes from the file name ``<BTCUSDT>-trades-<date>.csv``, mapped back to the unified
    spelling through ``symbols`` (e.g. ``["BTC/USDT", ...]``); unknown names give NULL."""
    from tickweave.functions.keys import archive_symbol
    pairs = []
    for s in symbols:
        pairs += [archive_symbol(F.lit(s)), F.lit(s)]
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in BINANCE_ARCHIVE.fields])
    df = spark.read.csv(path_glob, schema=text, header=False).withColumn(
        "symbol", F.element_at(F.create_map(*pairs), F.regexp_extract(_file_name(), r"^([A-Za-z0-9]+)-trades-", 1)))
    ok = F.lit(True)
    for f in BINANCE_ARCHIVE.fields:
        ok = ok & F.col(f.name).try_cast(f.dataType).isNotNull()
    return _unify_binance(_typed(df.withColumn("_ok", ok), BINANCE_ARCHIVE, "symbol"), load_ms)


def read_okx_archives(spark: SparkSession, path_glob: str, load_ms: int) -> DataFrame:
    """SRC-7 over many daily files at once: the pair comes from the file name
    ``<BTC-USDT>-trades-<date>.csv`` and becomes ``BTC/USDT``."""
    pair = F.regexp_extract(_file_name(), r"^([A-Za-z0-9]+-[A-Za-z0-9]+)-trades-", 1)
    df = spark.read.csv(path_glob, header=True, inferSchema=False).select(*OKX_ARCHIVE.fieldNames(), F.translate(pair, "-", "/").alias("symbol"))
    ok = F.lit(True)
    for f in OKX_ARCHIVE.fields:
        ok = ok & F.col(f.name).try_cast(f.dataType).isNotNull()
    return _unify_okx(_typed(df.withColumn("_ok", ok), OKX_ARCHIVE, "symbol"), load_ms)
