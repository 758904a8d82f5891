"""Trade column expressions (FEA-8..12, FEA-10 time conversion)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickweave.functions.book import safe_div

# fixed values: trader categories by notional, in USDT
RETAIL, PRO, WHALE = "Retail (<1k)", "Pro (1k-10k)", "Whale (>10k)"
RETAIL_BELOW, PRO_BELOW = 1000.0, 10000.0


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ms_to_utc(ms="timestamp") -> Column:
    """FEA-10: epoch milliseconds -> UTC wall-clock timestamp (TIMESTAMP_NTZ).

    An NTZ value keeps the UTC wall clock whatever the session time zone is.
    """
    return F.timestamp_add("MILLISECOND", _c(ms), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def utc_date(ms="timestamp") -> Column:
    """UTC calendar day of an epoch-millisecond column."""
    return F.to_date(ms_to_utc(ms))


def turnover(price="price", amount="amount") -> Column:
    """FEA-8: price * amount."""
    return _c(price) * _c(amount)


def is_high_impact(threshold: float = 50000.0, price="price", amount="amount") -> Column:
    """FEA-9: 1 when notional is strictly above ``threshold``, else 0."""
    return F.when(turnover(price, amount) > F.lit(threshold), F.lit(1)).otherwise(F.lit(0))


def slippage_buy(scale: float = 1000.0, price="trade_price", best_ask="best_ask") -> Column:
    """FEA-11: (best_ask - price) / best_ask * scale (the reference scales by 1000)."""
    return safe_div(_c(best_ask) - _c(price), _c(best_ask)) * F.lit(scale)


def slippage_sell(scale: float = 1000.0, price="trade_price", best_bid="best_bid") -> Column:
    """FEA-11: (price - best_bid) / best_bid * scale."""
    return safe_div(_c(price) - _c(best_bid), _c(best_bid)) * F.lit(scale)


def trader_category(notional="notional_usdt") -> Column:
    """FEA-12: notional < 1000 retail, < 10000 pro, otherwise whale."""
    n = _c(notional)
    return (F.when(n < F.lit(RETAIL_BELOW), F.lit(RETAIL))
            .when(n < F.lit(PRO_BELOW), F.lit(PRO))
            .otherwise(F.lit(WHALE)))
