"""Window operators (WIN-1..6) and sorts/limits/splits (RNK-1..5).

Per-instrument windows run through ``series.blocked_window``: above a small size bound no
instrument is one task; ``layout='key'`` gives the plain ``partitionBy(key)`` form.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tickweave.functions import book as fb
from tickweave.operators import series
from tickweave.schemas import INSTRUMENT

DEFAULT_LAGS = (5, 10, 20, 50, 100)
TRADE_ORDER = ("trade_id",)
BOOK_ORDER = ("timestamp", "nonce")


# ---------------------------------------------------------------- WIN-1 / WIN-2 (trades)

def with_trade_seq(df: DataFrame, by: Sequence[str] = INSTRUMENT, order: Sequence = TRADE_ORDER,
                   out: str = "sub_ms_seq", layout: str | None = None) -> DataFrame:
    """WIN-1: 1-based sequence number by trade id inside each group (``row_number``)."""
    by = list(by)
    if series.layout(df, layout) == "key":
        w = Window.partitionBy(*by).orderBy(*order, "_tie")
        return df.withColumn("_tie", series.tie_break(df)).withColumn(out, F.row_number().over(w).cast("long")).drop("_tie")
    x = series.dense_index(df, by, order, idx_col="_idx")
    return x.withColumn(out, F.col("_idx") + F.lit(1)).drop("_idx")


def with_ma_price(df: DataFrame, n: int = 100, by: Sequence[str] = INSTRUMENT,
                  order: Sequence = TRADE_ORDER, price: str = "price", out: str | None = None,
                  layout: str | None = None, block_rows: int | None = None,
                  keep_index: tuple[str, str] | None = None) -> DataFrame:
    """WIN-2: mean price over the current and up to ``n`` preceding rows (short frames allowed).

    ``keep_index=(idx, count)`` also returns the 0-based row position and row count per group
    (WIN-1 for free: ``sub_ms_seq = idx + 1``)."""
    out = out or f"ma_price_{n}"

    def build(x: DataFrame, w: WindowSpec) -> DataFrame:
        return x.withColumn(out, F.avg(price).over(w.rowsBetween(-n, 0)))

    return series.blocked_window(df, by, order, build, lookback=n, layout_=layout, block_rows=block_rows,
                                 keep_index=keep_index)


# ---------------------------------------------------------------- WIN-3 / WIN-4 (books)

BEST_LEVELS = {"_pb": ("bid_prices", 0), "_vb": ("bid_volumes", 0), "_pa": ("ask_prices", 0), "_va": ("ask_volumes", 0)}


def _best_levels(df: DataFrame, by: Sequence[str], order: Sequence[str], build, lookback: int, lookahead: int,
                 layout: str | None, block_rows: int | None, keep_index: tuple[str, str] | None = None) -> DataFrame:
    """Run a book window with the best levels as columns beside the rows."""
    x = df.select("*", *[fb.level(a, i).alias(n) for n, (a, i) in BEST_LEVELS.items()])
    y = series.blocked_window(x, by, order, build, lookback=lookback, lookahead=lookahead, layout_=layout,
                              block_rows=block_rows, keep_index=keep_index)
    return y.drop(*BEST_LEVELS)


def _ofi_step_expr(w: WindowSpec):
    pb, vb, pa, va = F.col("_pb"), F.col("_vb"), F.col("_pa"), F.col("_va")
    pb0, vb0 = F.lag(pb, 1).over(w), F.lag(vb, 1).over(w)
    pa0, va0 = F.lag(pa, 1).over(w), F.lag(va, 1).over(w)
    db = F.when(pb > pb0, vb).when(pb == pb0, vb - vb0).otherwise(-vb0)
    da = F.when(pa < pa0, va).when(pa == pa0, va - va0).otherwise(-va0)
    return db - da


def _add_ofi(x: DataFrame, w: WindowSpec, window: int, step: str, out: str | None) -> DataFrame:
    x = x.withColumn(step, _ofi_step_expr(w))
    if out:
        fr = w.rowsBetween(-(window - 1), 0)
        x = x.withColumn(out, F.when(F.count(step).over(fr) >= F.lit(window), F.avg(step).over(fr)))
    return x


def with_ofi_step(df: DataFrame, by: Sequence[str] = INSTRUMENT, order: Sequence = BOOK_ORDER,
                  out: str = "ofi_step", layout: str | None = None, block_rows: int | None = None) -> DataFrame:
    """WIN-3: order-flow imbalance step e = db - da from the best levels; first row NULL."""
    return _best_levels(df, by, order, lambda x, w: _add_ofi(x, w, 1, out, None), 1, 0, layout, block_rows)


def with_ofi(df: DataFrame, window: int = 20, by: Sequence[str] = INSTRUMENT, order: Sequence = BOOK_ORDER,
             out: str = "factor_ofi_smooth", keep_step: bool = False, layout: str | None = None,
             block_rows: int | None = None) -> DataFrame:
    """WIN-4: rolling mean of ``window`` OFI steps, NULL until ``window`` non-null steps exist."""
    step = "ofi_step" if keep_step else "_ofi_step"
    y = _best_levels(df, by, order, lambda x, w: _add_ofi(x, w, window, step, out), window, 0, layout, block_rows)
    return y if keep_step else y.drop(step)


# ---------------------------------------------------------------- WIN-5 (labels)

def target_expr(w: WindowSpec, lag: int, mid: str = "mid_price"):
    m = F.col(mid)
    return fb.safe_div(F.lead(m, lag).over(w) - m, m) * F.lit(10000.0)


def with_targets(df: DataFrame, lags: Sequence[int] = DEFAULT_LAGS, by: Sequence[str] = INSTRUMENT,
                 order: Sequence = BOOK_ORDER, mid: str = "mid_price", layout: str | None = None,
                 block_rows: int | None = None) -> DataFrame:
    """WIN-5: forward return labels ``target_{lag}_tick`` in basis points."""
    def build(x: DataFrame, w: WindowSpec) -> DataFrame:
        return x.select("*", *[target_expr(w, lag, mid).alias(f"target_{lag}_tick") for lag in lags])

    return series.blocked_window(df, by, order, build, lookahead=max(lags), layout_=layout,
                                 block_rows=block_rows)


def with_book_factors(df: DataFrame, depth: int = 5, window: int = 20, lags: Sequence[int] = (),
                      by: Sequence[str] = INSTRUMENT, order: Sequence = BOOK_ORDER,
                      layout: str | None = None, block_rows: int | None = None,
                      keep_index: tuple[str, str] | None = None) -> DataFrame:
    """FEA-5..7 + WIN-3/4 (+ WIN-5 when ``lags``) in one ordered pass over the books.

    ``keep_index=("_i", "_cnt")`` keeps the row position and row count per instrument, which
    ``best_lag`` and ``evaluate`` then use instead of ordering the books again."""
    x = (df.withColumn("mid_price", fb.mid_price())
         .withColumn("vamp", fb.vamp(depth))
         .withColumn("vamp_bias_bp", fb.vamp_bias_bp()))

    def build(y: DataFrame, w: WindowSpec) -> DataFrame:
        y = _add_ofi(y, w, window, "_ofi_step", "factor_ofi_smooth")
        if lags:
            y = y.select("*", *[target_expr(w, lag).alias(f"target_{lag}_tick") for lag in lags])
        return y.drop("_ofi_step")

    return _best_levels(x, by, order, build, window, max(lags) if lags else 0, layout, block_rows,
                        keep_index=keep_index)


# ---------------------------------------------------------------- WIN-6 (previous id)

def with_prev(df: DataFrame, col: str, by: Sequence[str], order: Sequence, out: str = "prev_id",
              layout: str | None = None, block_rows: int | None = None) -> DataFrame:
    """WIN-6: previous value of ``col`` in order (NULL on the first row of each group)."""
    return series.blocked_window(df, by, order, lambda x, w: x.withColumn(out, F.lag(col, 1).over(w)),
                                 lookback=1, layout_=layout, block_rows=block_rows)


# ---------------------------------------------------------------- RNK-*

def _top_rows(df: DataFrame, by: Sequence[str], order: Sequence[str], descending: bool, n: int, layout: str | None,
              rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group in order (of all rows when ``by`` is empty).

    Key layout: ``row_number <= n``, which Catalyst plans with a partial WindowGroupLimit
    before the shuffle (or a TakeOrdered when ungrouped).
    Blocked layout: the histogram of (group, bin of the first order column) gives the last bin
    that can hold one of the first ``n`` rows, one row a group, which is broadcast. Rows behind
    it are left out where they are read, before anything is shuffled, hashed or sorted; the
    others - ``n`` and one bin a group - are ranked, after a limit on each of some salts of a
    group.
    """
    by, order = list(by or []), list(order)
    cols = [F.col(c).desc() if descending else F.col(c) for c in [*order, "_tie"]]
    blocked = series.layout(df, layout) != "key"
    x = series.upto_rows(df, by, order[0], n, descending) if blocked else df
    x = x.withColumn("_tie", series.tie_break(df))
    if blocked:
        p = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salts = max(2, math.isqrt(max(p, 1)) + 1)
        x = x.withColumn("_salt", F.pmod(F.col("_tie"), F.lit(salts)))
        w1 = Window.partitionBy(*by, "_salt").orderBy(*cols)
        x = x.withColumn("_rn", F.row_number().over(w1)).where(F.col("_rn") <= n).drop("_rn", "_salt")
    if not by and not rank_col:
        return x.orderBy(*cols).limit(n).drop("_tie")
    w = Window.partitionBy(*by).orderBy(*cols)
    out = x.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_tie")
    return out.withColumnRenamed("_rn", rank_col) if rank_col else out.drop("_rn")


def first_n(df: DataFrame, order: Sequence, n: int, by: Sequence[str] | None = None,
            layout: str | None = None) -> DataFrame:
    """RNK-1: the first ``n`` rows by ``order`` (per group when ``by``)."""
    return _top_rows(df, by or [], order, False, n, layout)


def latest_n(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int, rank_col: str | None = None,
             layout: str | None = None) -> DataFrame:
    """RNK-2: newest ``n`` rows per group (descending ``order``)."""
    return _top_rows(df, by, order, True, n, layout, rank_col)


def cap_stream(df: DataFrame, n: int, by: Sequence[str] = ("stream_key",),
               order: Sequence[str] = ("timestamp", "nonce"), layout: str | None = None) -> DataFrame:
    """RNK-3: keep only the newest ``n`` messages of each stream (exact, unlike the reference)."""
    return latest_n(df, list(by), list(order), n, layout=layout)


def latest_row(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """RNK-4: the row with the greatest ``order`` per group, as a partial+final ``max_by``."""
    rest = [c for c in df.columns if c not in by]
    agg = df.groupBy(*by).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return agg.select(*by, *[F.col("_r." + c).alias(c) for c in rest])


def positional_split(df: DataFrame, by: Sequence[str], order: Sequence, ratio: float = 0.7,
                     out: str = "is_train", layout: str | None = None) -> DataFrame:
    """RNK-5: the first ``floor(n * ratio)`` rows of each group in order are train."""
    by = list(by)
    if series.layout(df, layout) == "key":
        w = Window.partitionBy(*by).orderBy(*order, "_tie")
        x = (df.withColumn("_tie", series.tie_break(df)).withColumn("_idx", F.row_number().over(w) - F.lit(1))
             .withColumn("_cnt", F.count(F.lit(1)).over(Window.partitionBy(*by))).drop("_tie"))
    else:
        x = series.dense_index(df, by, order, idx_col="_idx", count_col="_cnt")
    split = F.floor(F.col("_cnt") * F.lit(float(ratio)))
    return x.withColumn(out, F.col("_idx") < split).drop("_idx", "_cnt")
