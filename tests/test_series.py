"""Blocked (range + halo) layout equals the plain per-key window, including a hot key."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, rows
from tickweave import fixtures as fx
from tickweave.operators import gaps as gp
from tickweave.operators import joins as jn
from tickweave.operators import series
from tickweave.operators import windows as win


@pytest.fixture(scope="module")
def skewed(spark):
    """Trades where BTC/USDT on binance holds most rows (a hot instrument)."""
    t = fx.local_trades(spark, SF_MID)
    hot = t.withColumn("symbol", F.when(F.col("trade_id") % 5 != 0, F.lit("BTC/USDT")).otherwise(F.col("symbol")))
    hot = hot.withColumn("exchange_id", F.when(F.col("symbol") == "BTC/USDT", F.lit("binance"))
                         .otherwise(F.col("exchange_id")))
    return hot.dropDuplicates(["exchange_id", "symbol", "trade_id"])


@pytest.mark.parametrize("block", [101, 128, 1000])
def test_ma_price_blocked_equals_key(spark, skewed, block):
    a = win.with_ma_price(skewed, layout="key")
    b = win.with_ma_price(skewed, layout="blocked", block_rows=block)
    cols = ["exchange_id", "symbol", "trade_id", "ma_price_100"]
    assert rows(a, cols) == rows(b, cols)


def test_dense_index_is_exact(spark, skewed):
    x = series.dense_index(skewed, ["exchange_id", "symbol"], ["trade_id"], count_col="n", bin_width=13)
    bad = x.groupBy("exchange_id", "symbol").agg(F.min("_idx").alias("lo"), F.max("_idx").alias("hi"),
                                                  F.count("*").alias("c"), F.countDistinct("_idx").alias("d"),
                                                  F.first("n").alias("n"))
    for r in bad.collect():
        assert r.lo == 0 and r.hi == r.c - 1 and r.d == r.c == r.n
    # a hot key spans many bins
    hot = skewed.withColumn("_bin", series.bin_of(skewed, "trade_id", 13)).where("symbol = 'BTC/USDT'")
    assert hot.select("_bin").distinct().count() > 5


def test_book_factors_blocked_equals_key(spark):
    b = fx.books(spark, SF_MID)
    cols = ["exchange_id", "symbol", "nonce", "factor_ofi_smooth", "target_5_tick", "target_100_tick"]
    a = win.with_book_factors(b, lags=(5, 100), layout="key")
    c = win.with_book_factors(b, lags=(5, 100), layout="blocked", block_rows=100)
    assert rows(a, cols) == rows(c, cols)


def test_block_shorter_than_reach_is_rejected(spark, skewed):
    with pytest.raises(ValueError):
        win.with_ma_price(skewed, layout="blocked", block_rows=50).count()


def test_gaps_and_seq_blocked_equals_key(spark, skewed):
    a = gp.detect_gaps(skewed, layout="key")
    b = gp.detect_gaps(skewed, layout="blocked", block_rows=64)
    assert rows(a) == rows(b)
    s1 = win.with_trade_seq(skewed, by=["exchange_id", "symbol"], layout="key")
    s2 = win.with_trade_seq(skewed, by=["exchange_id", "symbol"], layout="blocked")
    assert rows(s1, ["symbol", "trade_id", "sub_ms_seq"]) == rows(s2, ["symbol", "trade_id", "sub_ms_seq"])


def test_positional_split_blocked_equals_key(spark):
    b = fx.books(spark, SF_MID)
    a = win.positional_split(b, ["exchange_id", "symbol"], ["timestamp", "nonce"], layout="key")
    c = win.positional_split(b, ["exchange_id", "symbol"], ["timestamp", "nonce"], layout="blocked")
    assert rows(a, ["nonce", "symbol", "is_train"]) == rows(c, ["nonce", "symbol", "is_train"])


@pytest.mark.parametrize("bin_ms", [50, 3000, 10**9])
def test_asof_blocked_equals_key(spark, bin_ms):
    t = fx.archive_trades(spark, SF_MID).select("exchange_id", "symbol", "timestamp", "trade_id", "price")
    q = fx.quotes(spark, SF_MID).select("exchange_id", "symbol", "timestamp", "nonce")
    a = jn.asof_join(t, q, right_cols=["nonce"], left_tie=["trade_id"], layout="key")
    b = jn.asof_join(t, q, right_cols=["nonce"], left_tie=["trade_id"], bin_ms=bin_ms, layout='blocked')
    assert rows(a) == rows(b)
    assert a.count() == t.count()


@pytest.mark.parametrize("n", [1, 37, 777, 1500])
def test_top_rows_blocked_equals_key(spark, skewed, n):
    order = ["timestamp", "trade_id"]
    a = win.first_n(skewed, order, n, layout="key")
    b = win.first_n(skewed, order, n, layout="blocked")
    assert rows(a) == rows(b) and a.count() == n
    c = win.latest_n(skewed, ["exchange_id", "symbol"], order, n, rank_col="rk", layout="key")
    d = win.latest_n(skewed, ["exchange_id", "symbol"], order, n, rank_col="rk", layout="blocked")
    assert rows(c) == rows(d)


def test_asof_wide_left_blocked_equals_key(spark):
    t = fx.archive_trades(spark, SF_MID)          # 11 columns: identity + payload
    q = fx.quotes(spark, SF_MID).select("exchange_id", "symbol", "timestamp", "nonce")
    a = jn.asof_join(t, q, right_cols=["nonce"], left_tie=["trade_id"], layout="key")
    b = jn.asof_join(t, q, right_cols=["nonce"], left_tie=["trade_id"], layout="blocked")
    assert sorted(a.columns) == sorted(b.columns)
    assert rows(a.select(*sorted(a.columns))) == rows(b.select(*sorted(a.columns)))
