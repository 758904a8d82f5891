"""Fixed schemas of the data model."""

from pyspark.sql import types as T

# Instrument key: every per-instrument operator partitions by these columns.
INSTRUMENT = ["exchange_id", "mkt_type", "symbol"]
# Exchange + symbol: the key the reference uses for trade-id sequences.
VENUE_SYMBOL = ["exchange_id", "symbol"]

D = T.DoubleType()
L = T.LongType()
S = T.StringType()
B = T.BooleanType()
ARR = T.ArrayType(T.DoubleType())

TRADE = T.StructType([
    T.StructField("trade_id", L), T.StructField("trade_id_raw", S),
    T.StructField("symbol", S), T.StructField("exchange_id", S), T.StructField("mkt_type", S),
    T.StructField("price", D), T.StructField("amount", D), T.StructField("side", S),
    T.StructField("is_taker_buyer", B), T.StructField("timestamp", L),
    T.StructField("local_timestamp", L),
])

BOOK = T.StructType([
    T.StructField("nonce", L), T.StructField("symbol", S), T.StructField("exchange_id", S),
    T.StructField("mkt_type", S),
    T.StructField("bid_prices", ARR), T.StructField("bid_volumes", ARR),
    T.StructField("ask_prices", ARR), T.StructField("ask_volumes", ARR),
    T.StructField("timestamp", L), T.StructField("local_timestamp", L),
])

# Raw lakes carry no mkt_type (it comes from the path) and no ingest columns.
RAW_TRADE = T.StructType([
    T.StructField("trade_id", S), T.StructField("symbol", S), T.StructField("exchange_id", S),
    T.StructField("price", D), T.StructField("amount", D), T.StructField("side", S),
    T.StructField("is_taker_buyer", B), T.StructField("timestamp", L),
])

RAW_BOOK = T.StructType([
    T.StructField("nonce", L), T.StructField("symbol", S), T.StructField("exchange_id", S),
    T.StructField("bid_volume", D), T.StructField("bid_price", D),
    T.StructField("ask_volume", D), T.StructField("ask_price", D),
    T.StructField("bid_prices", ARR), T.StructField("bid_volumes", ARR),
    T.StructField("ask_prices", ARR), T.StructField("ask_volumes", ARR),
    T.StructField("timestamp", L),
])

# Binance daily archive: CSV without header, timestamp in microseconds.
BINANCE_ARCHIVE = T.StructType([
    T.StructField("trade_id", L), T.StructField("price", D), T.StructField("amount", D),
    T.StructField("cost", D), T.StructField("timestamp", L), T.StructField("is_maker", B),
    T.StructField("is_best", B),
])

# OKX daily archive: CSV with header; only these columns are used.
OKX_ARCHIVE = T.StructType([
    T.StructField("trade_id", L), T.StructField("side", S), T.StructField("price", D),
    T.StructField("size", D), T.StructField("created_time", L),
])

# Live trade message as the exchange client delivers it.
LIVE_TRADE = T.StructType([
    T.StructField("symbol", S), T.StructField("id", S), T.StructField("timestamp", L),
    T.StructField("side", S), T.StructField("price", D), T.StructField("amount", D),
    T.StructField("info", T.MapType(S, S)),
    T.StructField("exchange_id", S), T.StructField("mkt_type", S),
])

LIVE_BOOK = T.StructType([
    T.StructField("symbol", S), T.StructField("exchange_id", S), T.StructField("mkt_type", S),
    T.StructField("bids", T.ArrayType(ARR)), T.StructField("asks", T.ArrayType(ARR)),
    T.StructField("nonce", L), T.StructField("timestamp", L),
])

# Historical-trade REST rows used for backfill.
BACKFILL = T.StructType([
    T.StructField("id", L), T.StructField("time", L), T.StructField("price", D),
    T.StructField("qty", D), T.StructField("quoteQty", D), T.StructField("isBuyerMaker", B),
])

GAP = T.StructType([
    T.StructField("exchange_id", S), T.StructField("symbol", S),
    T.StructField("start_id", L), T.StructField("end_id", L),
])

WEIGHTS = T.StructType([
    T.StructField("exchange_id", S), T.StructField("mkt_type", S), T.StructField("symbol", S), T.StructField("w_vamp", D), T.StructField("w_ofi", D),
    T.StructField("intercept", D), T.StructField("best_lag", T.IntegerType()),
])
