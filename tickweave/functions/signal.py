"""Signal column expressions (FEA-13, FEA-14, FEA-16)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def combined_alpha(w_vamp="w_vamp", w_ofi="w_ofi", intercept="intercept",
                   bias="vamp_bias_bp", ofi="factor_ofi_smooth") -> Column:
    """FEA-13: vamp_bias_bp * w_vamp + ofi * w_ofi + intercept (weights may be columns or numbers)."""
    lit = lambda v: F.lit(float(v)) if isinstance(v, (int, float)) else _c(v)
    return _c(bias) * lit(w_vamp) + _c(ofi) * lit(w_ofi) + lit(intercept)


def trade_signal(score="combined_alpha", threshold: float = 0.05) -> Column:
    """FEA-14: 'buy' above +threshold, 'sell' below -threshold, else 'none' (strict); a NULL
    score has no signal (NULL), in batch and stream."""
    s = _c(score)
    return (F.when(s > F.lit(threshold), F.lit("buy"))
            .when(s < F.lit(-threshold), F.lit("sell"))
            .when(s.isNotNull(), F.lit("none")))


def blend(old, new, alpha: float = 0.2) -> Column:
    """FEA-16: old * (1 - alpha) + new * alpha."""
    return _c(old) * F.lit(1.0 - alpha) + _c(new) * F.lit(alpha)
