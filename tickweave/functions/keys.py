"""Symbol spellings, stream keys and job ids (NRM-7, NRM-8, FEA-15)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: stream key prefix and type suffixes
STREAM_PREFIX = "md"
TYPE_SUFFIX = {"orderbook": "tick", "trades": "trades"}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def path_symbol(symbol="symbol") -> Column:
    """BTC/USDT -> BTC-USDT (paths and stream keys)."""
    return F.translate(_c(symbol), "/", "-")


def archive_symbol(symbol="symbol") -> Column:
    """BTC/USDT -> BTCUSDT (daily archive file names)."""
    return F.replace(F.replace(_c(symbol), F.lit("/"), F.lit("")), F.lit("-"), F.lit(""))


def weight_symbol(symbol="symbol") -> Column:
    """BTC/USDT -> btc_usdt (weight file names)."""
    return F.lower(F.translate(_c(symbol), "/", "_"))


def stream_key(data_type: str | Column = "trades", exchange="exchange_id", mkt="mkt_type",
               symbol="symbol") -> Column:
    """md:<exchange>:<mkt>:<pair>:<suffix>; suffix is 'tick' for books, 'trades' for trades."""
    if isinstance(data_type, str):
        suffix = F.lit(TYPE_SUFFIX.get(data_type, data_type))
    else:
        suffix = F.when(data_type == F.lit("orderbook"), F.lit("tick")).otherwise(data_type)
    return F.concat_ws(":", F.lit(STREAM_PREFIX), _c(exchange), _c(mkt), path_symbol(symbol), suffix)


def gap_job_id(exchange="exchange_id", symbol="symbol", start="start_id", end="end_id") -> Column:
    """FEA-15: md5 hex of 'exchange:symbol:start:end'."""
    return F.md5(F.concat_ws(":", _c(exchange), _c(symbol), _c(start).cast("string"), _c(end).cast("string")))
