"""Factor research: IC, best horizon, two-factor OLS, honest evaluation, TCA, weights
(AGG-4..8, FEA-16, SET-1).

Everything is one or two aggregations of moments (counts, means, population
(co)variances) grouped by instrument; only these few numbers per instrument are ever
produced, never the rows. Correlation and OLS come from the moments:

    ic      = cov(x, y) / sqrt(var(x) var(y))          (NULL when a variance is 0)
    [b1 b2] = solve([[v1, c12], [c12, v2]], [c1y, c2y]),  a = my - b1 m1 - b2 m2
    corr(a + b1 x1 + b2 x2, y) = (b1 c1y + b2 c2y) / sqrt(var_pred * vy)
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions import signal as fs
from tickweave.functions import trade as ft
from tickweave.operators import series
from tickweave.operators.quality import fresh_quotes
from tickweave.operators.windows import BOOK_ORDER, DEFAULT_LAGS
from tickweave.schemas import INSTRUMENT

X_VAMP, X_OFI = "vamp_bias_bp", "factor_ofi_smooth"
IC_GATE = 0.02


def _nn(*cols: str) -> Column:
    c = F.lit(True)
    for x in cols:
        c = c & F.col(x).isNotNull()
    return c


def _cond(cond: Column, x) -> Column:
    return F.when(cond, F.col(x) if isinstance(x, str) else x)


def _corr_from(cov: Column, vx: Column, vy: Column) -> Column:
    den = F.sqrt(vx * vy)
    return cov / F.nullif(den, F.lit(0.0))


# ---------------------------------------------------------------- AGG-4 / PIP-7

def impact_by_category(df: DataFrame, by: Sequence[str] = ("trader_category",)) -> DataFrame:
    """AGG-4: mean buy and sell slippage and trade count per trader category."""
    return df.groupBy(*by).agg(F.avg("slippage_bps_buy").alias("avg_impact_cost_buy"),
                               F.avg("slippage_bps_sell").alias("avg_impact_cost_sell"),
                               F.count(F.lit(1)).alias("trade_count"))


def tca(trades: DataFrame, books: DataFrame, max_lag_ms: int = 100, scale: float = 1000.0,
        by: Sequence[str] = ("exchange_id", "symbol"), layout: str | None = None) -> tuple[DataFrame, DataFrame]:
    """PIP-7: trades as-of joined to the prevailing book, fresh quotes only, slippage and
    size category per trade, then AGG-4. Returns (per-trade frame, category report)."""
    from tickweave.functions import book as fb
    from tickweave.operators.joins import asof_join

    q = books.select(*by, "timestamp", "nonce",
                     fb.micro_price().alias("prev_micro_price"), fb.imbalance().alias("imbalance"),
                     fb.best_bid().alias("best_bid"), fb.best_ask().alias("best_ask"))
    t = trades.select(*by, "timestamp", "trade_id", F.col("price").alias("trade_price"), "amount")
    j = asof_join(t, q, by=by, right_cols=["prev_micro_price", "imbalance", "best_bid", "best_ask"],
                  prefix="", left_tie=["trade_id"], layout=layout)
    fresh = fresh_quotes(j, max_lag_ms)
    per_trade = (fresh.withColumn("slippage_bps_buy", ft.slippage_buy(scale))
                 .withColumn("slippage_bps_sell", ft.slippage_sell(scale))
                 .withColumn("notional_usdt", ft.turnover("trade_price", "amount"))
                 .withColumn("trader_category", ft.trader_category()))
    return per_trade, impact_by_category(per_trade)


# ---------------------------------------------------------------- AGG-5

def ic(df: DataFrame, x: str, y: str, by: Sequence[str] | None = None, out: str = "ic") -> DataFrame:
    """AGG-5: Pearson correlation of ``x`` and ``y`` over rows where both are non-null;
    NULL for a constant input (``corr`` would raise under ANSI)."""
    ok = _nn(x, y)
    aggs = [_corr_from(F.covar_pop(_cond(ok, x), _cond(ok, y)), F.var_pop(_cond(ok, x)),
                       F.var_pop(_cond(ok, y))).alias(out),
            F.count(_cond(ok, F.lit(1))).alias("n")]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


# ---------------------------------------------------------------- AGG-6

def best_lag(df: DataFrame, lags: Sequence[int] = DEFAULT_LAGS, split: float = 0.7,
             by: Sequence[str] = INSTRUMENT, x: str = X_VAMP, mid: str = "mid_price",
             base_cols: Sequence[str] = (X_VAMP, X_OFI, "vamp", "mid_price"),
             order: Sequence[str] = BOOK_ORDER) -> DataFrame:
    """AGG-6: |IC| of ``x`` against the forward return at each lag on the first
    ``floor(n * split)`` rows, with labels recomputed inside that slice, and the best lag
    (largest |IC|, first on ties) per instrument.

    Input: book factors with ``target_{lag}_tick`` for every lag (full-frame labels).
    Row rule of the reference (a NULL in any column drops the row; at lag L the labels of
    lags <= L were recomputed inside the slice, those of later lags are full-frame):
    a row with index i counts at lag L when its base columns are non-null, i + l < split
    for every lag l <= L, and target_l is non-null for every lag l > L.
    """
    by = list(by)
    lags = sorted(lags)
    x_ = df if {"_i", "_cnt"} <= set(df.columns) else series.dense_index(df, by, order, idx_col="_i",
                                                                          count_col="_cnt")
    split_n = F.floor(F.col("_cnt") * F.lit(float(split)))
    base = _nn(*base_cols)
    aggs = []
    for L in lags:
        cond = base & (F.col("_i") + F.lit(L) < split_n) & _nn(*[f"target_{l}_tick" for l in lags if l > L])
        # a label inside the slice equals the full-frame label whenever i + L < split
        yv = f"target_{L}_tick"
        cond = cond & F.col(yv).isNotNull()
        aggs.append(F.abs(_corr_from(F.covar_pop(_cond(cond, x), _cond(cond, yv)),
                                     F.var_pop(_cond(cond, x)), F.var_pop(_cond(cond, yv)))).alias(f"ic_{L}"))
    g = x_.groupBy(*by).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(L).alias("lag"), F.col(f"ic_{L}").alias("ic")) for L in lags])
    g = g.select(*by, F.explode(rows).alias("_r")).select(*by, "_r.lag", "_r.ic")
    best = (g.where(F.col("ic").isNotNull()).groupBy(*by)
            .agg(F.max_by("lag", F.struct(F.col("ic"), -F.col("lag"))).alias("best_lag")))
    return (g.join(best, by, "left")
            .withColumn("is_best", F.coalesce(F.col("lag") == F.col("best_lag"), F.lit(False)))
            .drop("best_lag"))


# ---------------------------------------------------------------- AGG-7 / AGG-8

def _moments(cond: Column, y: str, xs: Sequence[str], tag: str) -> list[Column]:
    x1, x2 = xs
    c = lambda v: _cond(cond, v)
    return [
        F.count(c(F.lit(1))).alias(f"n_{tag}"),
        F.avg(c(x1)).alias(f"m1_{tag}"), F.avg(c(x2)).alias(f"m2_{tag}"), F.avg(c(y)).alias(f"my_{tag}"),
        F.var_pop(c(x1)).alias(f"v1_{tag}"), F.var_pop(c(x2)).alias(f"v2_{tag}"),
        F.var_pop(c(y)).alias(f"vy_{tag}"),
        F.covar_pop(c(x1), c(x2)).alias(f"c12_{tag}"),
        F.covar_pop(c(x1), c(y)).alias(f"c1y_{tag}"), F.covar_pop(c(x2), c(y)).alias(f"c2y_{tag}"),
    ]


def _ols_cols(tag: str) -> dict[str, Column]:
    v1, v2, c12 = F.col(f"v1_{tag}"), F.col(f"v2_{tag}"), F.col(f"c12_{tag}")
    c1y, c2y = F.col(f"c1y_{tag}"), F.col(f"c2y_{tag}")
    det = F.nullif(v1 * v2 - c12 * c12, F.lit(0.0))
    b1 = (v2 * c1y - c12 * c2y) / det
    b2 = (v1 * c2y - c12 * c1y) / det
    a = F.col(f"my_{tag}") - b1 * F.col(f"m1_{tag}") - b2 * F.col(f"m2_{tag}")
    return {"b1": b1, "b2": b2, "a": a}


def _pred_ic(b1: Column, b2: Column, tag: str) -> Column:
    v1, v2, c12 = F.col(f"v1_{tag}"), F.col(f"v2_{tag}"), F.col(f"c12_{tag}")
    cov = b1 * F.col(f"c1y_{tag}") + b2 * F.col(f"c2y_{tag}")
    var_pred = b1 * b1 * v1 + F.lit(2.0) * b1 * b2 * c12 + b2 * b2 * v2
    return _corr_from(cov, var_pred, F.col(f"vy_{tag}"))


def fit_ols(df: DataFrame, y: str, xs: Sequence[str] = (X_VAMP, X_OFI),
            by: Sequence[str] | None = None) -> DataFrame:
    """AGG-7: OLS of ``y`` on two regressors with intercept over rows with no NULL among
    them; returns ``w_1, w_2, intercept, n`` (named after the regressors: w_vamp, w_ofi
    for the default factors)."""
    ok = _nn(y, *xs)
    m = _moments(ok, y, xs, "all")
    g = df.groupBy(*by).agg(*m) if by else df.agg(*m)
    o = _ols_cols("all")
    names = _weight_names(xs)
    return g.select(*(by or []), o["b1"].alias(names[0]), o["b2"].alias(names[1]),
                    o["a"].alias("intercept"), F.col("n_all").alias("n"))


def _weight_names(xs: Sequence[str]) -> tuple[str, str]:
    if tuple(xs) == (X_VAMP, X_OFI):
        return "w_vamp", "w_ofi"
    return f"w_{xs[0]}", f"w_{xs[1]}"


def evaluate(df: DataFrame, target: str | None = None, best: DataFrame | None = None,
             lags: Sequence[int] = DEFAULT_LAGS, split: float = 0.7, by: Sequence[str] = INSTRUMENT,
             xs: Sequence[str] = (X_VAMP, X_OFI), order: Sequence[str] = BOOK_ORDER,
             gate: float = IC_GATE) -> DataFrame:
    """AGG-8: honest evaluation of the two-factor signal per instrument.

    Rows with the factors and the target non-null are split by position (first
    ``floor(n * split)`` train). Fit on train; IC of the prediction on train and on the
    held-out tail; ``decay = (train - valid) / train``. When ``valid_ic > gate`` the model
    is refit on all those rows (weights, intercept) and the in-sample ``final_ic`` is taken
    over rows with no NULL in any factor or label column; otherwise weights stay 0.

    The target is ``target`` for all instruments, or per instrument the best lag from
    ``best`` (output of ``best_lag``).
    """
    by = list(by)
    if target is None and best is None:
        raise ValueError("give target or best")
    x1, x2 = xs
    if best is not None:
        chosen = best.where("is_best").select(*by, F.col("lag").alias("best_lag"))
        d = df.join(chosen, by, "inner")
        tgt = F.col("target_100_tick")
        for L in sorted(lags, reverse=True):
            tgt = F.when(F.col("best_lag") == F.lit(L), F.col(f"target_{L}_tick")).otherwise(tgt)
        d = d.withColumn("_y", tgt)
    else:
        d = df.withColumn("_y", F.col(target)).withColumn("best_lag", F.lit(int(target.split("_")[1])))
    ok = _nn(x1, x2, "_y")
    # the positional split over the usable rows: from the factor pass's row index when
    # present, only the first validation row per instrument is located (one block ranked);
    # otherwise a fresh dense index over the usable rows
    if "_i" in d.columns:
        cut = series.subset_cutoff(d, by, "_i", ok, split)
        idx = d.where(ok).join(cut, by, "left")
        train = F.col("_cut").isNull() | (F.col("_i") < F.col("_cut"))
    else:
        idx = series.dense_index(d.where(ok), by, list(order), idx_col="_j", count_col="_m")
        train = F.col("_j") < F.floor(F.col("_m") * F.lit(float(split)))
    all_labels = _nn(x1, x2, *[f"target_{L}_tick" for L in lags])
    aggs = (_moments(train, "_y", xs, "tr") + _moments(~train, "_y", xs, "va")
            + _moments(F.lit(True), "_y", xs, "all") + _moments(all_labels, "_y", xs, "fin")
            + [F.first("best_lag").alias("best_lag")])
    g = idx.groupBy(*by).agg(*aggs)
    tr, al = _ols_cols("tr"), _ols_cols("all")
    g = (g.withColumn("train_ic", _pred_ic(tr["b1"], tr["b2"], "tr"))
         .withColumn("valid_ic", _pred_ic(tr["b1"], tr["b2"], "va"))
         .withColumn("decay", (F.col("train_ic") - F.col("valid_ic")) / F.nullif(F.col("train_ic"), F.lit(0.0)))
         .withColumn("passed", F.coalesce(F.col("valid_ic") > F.lit(gate), F.lit(False))))
    passed = F.col("passed")
    w_names = _weight_names(xs)
    g = (g.withColumn(w_names[0], F.when(passed, al["b1"]).otherwise(F.lit(0.0)))
         .withColumn(w_names[1], F.when(passed, al["b2"]).otherwise(F.lit(0.0)))
         .withColumn("intercept", F.when(passed, al["a"]).otherwise(F.lit(0.0)))
         .withColumn("final_ic", F.when(passed, _pred_ic(al["b1"], al["b2"], "fin"))))
    return g.select(*by, "best_lag", F.col("n_tr").alias("n_train"), F.col("n_va").alias("n_valid"),
                    "train_ic", "valid_ic", "decay", "passed", *w_names, "intercept", "final_ic")


# ---------------------------------------------------------------- FEA-16, SET-1

def blend_weights(old: DataFrame | None, new: DataFrame, alpha: float = 0.2,
                  by: Sequence[str] = INSTRUMENT) -> DataFrame:
    """FEA-16: w = old * (1 - alpha) + new * alpha for both weights; intercept and best_lag
    come from the new record. No old record -> the new one unchanged."""
    by = list(by)
    if old is None:
        return new.select(*by, "w_vamp", "w_ofi", "intercept", "best_lag")
    o = old.select(*by, F.col("w_vamp").alias("_ov"), F.col("w_ofi").alias("_oo"))
    j = new.join(o, by, "left")
    return j.select(*by,
                    F.coalesce(fs.blend("_ov", "w_vamp", alpha), F.col("w_vamp")).alias("w_vamp"),
                    F.coalesce(fs.blend("_oo", "w_ofi", alpha), F.col("w_ofi")).alias("w_ofi"),
                    "intercept", "best_lag")


def concat_history(history: DataFrame, today: DataFrame) -> DataFrame:
    """SET-1: history and today's rows as one frame (strict by-name union).

    The reference then sorts by timestamp; here order is applied where it matters, by the
    ordered windows downstream (timestamp, nonce), instead of a global sort.
    """
    return history.unionByName(today.select(*history.columns))
