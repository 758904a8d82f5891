"""Order-book column expressions (FEA-1..7). All are native Catalyst expressions.

Division by zero gives NULL everywhere (``nullif`` on the divisor): under ANSI mode a bare
``/ 0`` raises, and the reference's two engines disagree (inf/NaN vs NULL).
Best level = ``get(arr, 0)``, which is NULL for an empty array instead of raising.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def level(arr, i: int = 0) -> Column:
    """Level ``i`` (0-based) of a price or volume array; NULL when the book is shorter."""
    return F.get(_c(arr), i)


def safe_div(num: Column, den: Column) -> Column:
    return num / F.nullif(den, F.lit(0.0))


def best_bid() -> Column:
    return level("bid_prices")


def best_ask() -> Column:
    return level("ask_prices")


def micro_price() -> Column:
    """FEA-1: (bid1*askv1 + ask1*bidv1) / (bidv1 + askv1)."""
    b, a = level("bid_prices"), level("ask_prices")
    bv, av = level("bid_volumes"), level("ask_volumes")
    return safe_div(b * av + a * bv, bv + av)


def imbalance() -> Column:
    """FEA-2: (bidv1 - askv1) / (bidv1 + askv1)."""
    bv, av = level("bid_volumes"), level("ask_volumes")
    return safe_div(bv - av, bv + av)


def spread() -> Column:
    """FEA-3: ask1 - bid1."""
    return level("ask_prices") - level("bid_prices")


def top_levels(arr, n: int = 20) -> Column:
    """FEA-4: keep the first ``n`` levels (shorter books pass through)."""
    return F.slice(_c(arr), 1, n)


def mid_price() -> Column:
    """FEA-5: (bid1 + ask1) / 2."""
    return (level("bid_prices") + level("ask_prices")) / F.lit(2.0)


def _side_vwap(prices: str, volumes: str, depth: int) -> Column:
    # Unrolled over the fixed depth so the expression stays inside whole-stage codegen
    # (higher-order functions are interpreted). Missing levels contribute nothing.
    num = None
    den = None
    for i in range(depth):
        pv = F.coalesce(level(prices, i) * level(volumes, i), F.lit(0.0))
        v = F.coalesce(level(volumes, i), F.lit(0.0))
        num = pv if num is None else num + pv
        den = v if den is None else den + v
    return safe_div(num, den)


def vamp(depth: int = 5) -> Column:
    """FEA-6: mean of the two sides' volume-weighted prices over the first ``depth`` levels."""
    return (_side_vwap("bid_prices", "bid_volumes", depth)
            + _side_vwap("ask_prices", "ask_volumes", depth)) / F.lit(2.0)


def vamp_bias_bp(vamp_col="vamp", mid_col="mid_price") -> Column:
    """FEA-7: (vamp - mid) / mid * 10000."""
    mid = _c(mid_col)
    return safe_div(_c(vamp_col) - mid, mid) * F.lit(10000.0)
