"""Hand-made edge tables (FIXTURES.md §3): nulls, ties, empty books, duplicates, limits."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from conftest import rows
from tickweave.functions import book as fb
from tickweave.functions import signal as fs
from tickweave.functions import trade as ft
from tickweave.operators import gaps as gp
from tickweave.operators import joins as jn
from tickweave.operators import normalize as nm
from tickweave.operators import quality as q
from tickweave.operators import research as rs
from tickweave.operators import windows as win
from tickweave.schemas import BOOK, LIVE_TRADE
from tickweave.streaming.silence import silence_events

INST = dict(exchange_id="binance", mkt_type="spot", symbol="BTC/USDT")


def book(nonce, ts, bp, bv, ap, av, **kw):
    d = dict(INST, nonce=nonce, timestamp=ts, local_timestamp=ts, bid_prices=bp, bid_volumes=bv,
             ask_prices=ap, ask_volumes=av)
    d.update(kw)
    return d


def books_df(spark, items):
    return spark.createDataFrame(items, BOOK)


@pytest.mark.parametrize("n", [19, 20, 21])
def test_ofi_needs_20_steps(spark, n):
    items = [book(i, 1000 + i, [100.0 + (i % 3)], [1.0 + i], [101.0 + (i % 2)], [2.0 + i]) for i in range(n + 1)]
    for layout in ("key", "blocked"):
        out = win.with_ofi(books_df(spark, items), 20, keep_step=True, layout=layout, block_rows=32).orderBy("nonce")
        got = out.select("ofi_step", "factor_ofi_smooth").collect()
        assert got[0].ofi_step is None
        assert all(r.factor_ofi_smooth is None for r in got[:20])
        if n + 1 > 20:
            steps = [r.ofi_step for r in got[1:21]]
            assert got[20].factor_ofi_smooth == pytest.approx(sum(steps) / 20)


def test_ofi_step_rules(spark):
    items = [book(1, 1, [100.0], [5.0], [101.0], [7.0]),
             book(2, 2, [100.5], [3.0], [100.75], [4.0]),   # bid up -> +v ; ask down -> +v
             book(3, 3, [100.5], [6.0], [100.75], [1.0]),   # same -> v - v_prev
             book(4, 4, [100.0], [9.0], [101.0], [8.0])]    # bid down -> -v_prev ; ask up -> -v_prev
    out = win.with_ofi_step(books_df(spark, items), layout="key").orderBy("nonce").collect()
    assert [r.ofi_step for r in out] == [None, 3.0 - 4.0, (6.0 - 3.0) - (1.0 - 4.0), -6.0 - (-1.0)]


def test_equal_timestamps_order_by_nonce(spark):
    items = [book(2, 5, [100.0], [1.0], [101.0], [1.0]), book(1, 5, [100.0], [2.0], [101.0], [2.0])]
    out = win.with_ofi_step(books_df(spark, items), layout="key").orderBy("nonce").collect()
    assert out[0].ofi_step is None and out[1].ofi_step == (1.0 - 2.0) - (1.0 - 2.0)


def test_empty_and_short_books(spark):
    items = [book(1, 1, [], [], [], []), book(2, 2, [100.0], [0.0], [101.0], [0.0]),
             book(3, 3, [100.0, 99.0], [1.0, 3.0], [101.0], [2.0])]
    df = books_df(spark, items).select(
        "nonce", fb.micro_price().alias("mp"), fb.imbalance().alias("imb"), fb.spread().alias("sp"),
        fb.vamp(5).alias("vamp"), fb.top_levels("bid_prices", 20).alias("top"))
    r = {x.nonce: x for x in df.collect()}
    assert r[1].mp is None and r[1].imb is None and r[1].sp is None and r[1].vamp is None and r[1].top == []
    assert r[2].mp is None and r[2].imb is None and r[2].vamp is None        # zero total volume
    assert r[3].vamp == pytest.approx(((100 * 1 + 99 * 3) / 4 + 101.0) / 2)  # sides of different depth


def _trades(spark, ids, sym="BTC/USDT"):
    return spark.createDataFrame([Row(exchange_id="binance", symbol=sym, trade_id=i) for i in ids])


def test_gap_edges(spark):
    df = _trades(spark, [1, 2, 2, 4, 5, 1006, 20000]).unionByName(_trades(spark, [7], "ETH/USDT"))
    for layout in ("key", "blocked"):
        g = sorted(tuple(r) for r in gp.detect_gaps(df, layout=layout, block_rows=2)
                   .select("start_id", "end_id").collect())
        assert g == [(3, 3), (6, 1005), (1007, 19999)]
    pages = gp.gap_pages(gp.detect_gaps(df, layout="key"))
    p = pages.where("start_id = 1007").orderBy("page_start").collect()
    assert len(p) == 19 and p[0].page_end == 2006 and p[-1].page_end == 19999


def test_fill_gaps_never_past_end(spark):
    gaps = spark.createDataFrame([Row(exchange_id="binance", symbol="BTC/USDT", start_id=999, end_id=2001)])
    bf = _trades(spark, range(990, 2010))
    rec, rep = gp.fill_gaps(gaps, bf)
    ids = sorted(r.trade_id for r in rec.collect())
    assert ids[0] == 999 and ids[-1] == 2001 and len(ids) == 1003
    assert rep.first().n_missing == 0


def test_validator_edges(spark):
    df = spark.createDataFrame([Row(**INST, price=p) for p in (100.0, 110.0, None, 0.0)], "exchange_id string, "
                               "mkt_type string, symbol string, price double")
    bad, rep = q.validate_trades(df)
    assert bad.count() == 1                        # NULL price is not an error, 0 is
    r = q.validate_trades(df.where("price > 0"))[1].first()
    assert r.range_ratio == pytest.approx(0.1) and r.warn is False   # exactly 10 % is not a warning
    with pytest.raises(ValueError):
        q.validate_trades(df, strict=True)


def test_notional_edges(spark):
    df = spark.createDataFrame([(1000.0,), (10000.0,), (50000.0,), (999.99,)], "n double")
    out = df.select("n", ft.trader_category("n").alias("c"),
                    ft.is_high_impact(50000.0, F.col("n"), F.lit(1.0)).alias("hi")).orderBy("n").collect()
    assert [r.c for r in out] == ["Retail (<1k)", "Pro (1k-10k)", "Whale (>10k)", "Whale (>10k)"]
    assert [r.hi for r in out] == [0, 0, 0, 0]


def test_signal_edges(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0500001,), (-0.0500001,)], "s double")
    assert [r.x for r in df.select(fs.trade_signal("s").alias("x")).collect()] == ["none", "none", "buy", "sell"]


def test_asof_tie_and_no_quote(spark):
    t = spark.createDataFrame([Row(exchange_id="binance", symbol="X", timestamp=t, trade_id=i)
                               for i, t in enumerate([5, 10, 20])])
    qt = spark.createDataFrame([Row(exchange_id="binance", symbol="X", timestamp=10, nonce=n, px=float(n))
                                for n in (1, 2)])
    for layout in ("key", "blocked"):
        out = {r.trade_id: r for r in jn.asof_join(t, qt, right_cols=["px"], left_tie=["trade_id"],
                                                   layout=layout).collect()}
        assert out[0].ob_px is None and out[0].data_lag_ms is None       # no earlier quote
        assert out[1].ob_px == 2.0 and out[1].data_lag_ms == 0           # equal time counts, latest nonce
        assert out[2].ob_px == 2.0 and out[2].data_lag_ms == 10


def test_constant_factor_ic_is_null(spark):
    df = spark.createDataFrame([(1.0, float(i)) for i in range(10)], "x double, y double")
    assert rs.ic(df, "x", "y").first().ic is None


def test_ols_recovers_planted_weights(spark):
    import random
    rnd = random.Random(7)
    data = []
    for _ in range(2000):
        a, b = rnd.gauss(0, 1), rnd.gauss(0, 1)
        data.append((a, b, 0.5 * a - 2.0 * b + 3.0 + rnd.gauss(0, 0.01)))
    df = spark.createDataFrame(data, "vamp_bias_bp double, factor_ofi_smooth double, y double")
    r = rs.fit_ols(df, "y").first()
    assert r.w_vamp == pytest.approx(0.5, abs=1e-2) and r.w_ofi == pytest.approx(-2.0, abs=1e-2)
    assert r.intercept == pytest.approx(3.0, abs=1e-2)


def test_silence_edges(spark):
    ts = [0, 20000, 40001, 100001, 160002]   # gaps: 20 s (no event), 20.001 s, 60 s (reconnect), 60.001 s (dead)
    df = spark.createDataFrame([Row(exchange_id="binance", symbol="X", local_timestamp=t) for t in ts])
    ev = silence_events(df, layout="key").orderBy("silence_start").collect()
    assert [(e.silence_ms, e.kind) for e in ev] == [(20001, "reconnect"), (60000, "reconnect"), (60001, "dead")]


def test_normalize_trade_flags(spark):
    rows_ = [
        dict(symbol="BTC/USDT", id="1", timestamp=5, side="sell", price=1.0, amount=1.0, info={"m": "True"},
             exchange_id="binance", mkt_type="spot"),
        dict(symbol="BTC/USDT", id="2", timestamp=0, side="buy", price=1.0, amount=1.0,
             info={"isBuyerMaker": "false"}, exchange_id="binance", mkt_type="spot"),
        dict(symbol="BTC/USDT", id="3", timestamp=5, side="buy", price=1.0, amount=1.0, info={},
             exchange_id="binance", mkt_type="spot"),
        dict(symbol="BTC/USDT", id="4", timestamp=5, side="sell", price=1.0, amount=1.0, info=None,
             exchange_id="okx", mkt_type="spot"),
        dict(symbol="BTC/USDT", id="5", timestamp=5, side="buy", price=1.0, amount=1.0, info={},
             exchange_id="kraken", mkt_type="spot"),
    ]
    df = spark.createDataFrame(rows_, LIVE_TRADE)
    good, bad = nm.normalize_trades(df, now_ms=99)
    g = {r.trade_id: r for r in good.collect()}
    assert g[1].is_taker_buyer is False and g[2].is_taker_buyer is True and g[3].is_taker_buyer is True
    assert g[4].is_taker_buyer is False and g[2].timestamp == 99 and g[1].local_timestamp == 99
    assert [r.reason for r in bad.collect()] == ["unknown exchange"]


def test_latest_by_key_keeps_newest(spark):
    df = spark.createDataFrame([Row(k=1, v="old", local_timestamp=1), Row(k=1, v="new", local_timestamp=2),
                                Row(k=2, v="only", local_timestamp=1)])
    assert rows(q.latest_by_key(df, ["k"])) == [(1, "new", 2), (2, "only", 1)]


def test_drop_nulls_keeps_nan(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (1.0,)], "x double")
    assert q.drop_nulls(df).count() == 2


def test_blend_without_old(spark):
    key = dict(exchange_id="okx", mkt_type="spot", symbol="BTC/USDT")
    new = spark.createDataFrame([Row(**key, w_vamp=1.0, w_ofi=2.0, intercept=0.5, best_lag=20)])
    old = spark.createDataFrame([Row(**key, w_vamp=0.0, w_ofi=1.0, intercept=9.0, best_lag=5),
                                 Row(**(key | {"exchange_id": "binance"}), w_vamp=5.0, w_ofi=5.0, intercept=5.0, best_lag=5)])
    assert rows(rs.blend_weights(None, new)) == [("okx", "spot", "BTC/USDT", 1.0, 2.0, 0.5, 20)]
    assert rs.blend_weights(old, new).count() == 1
    r = rs.blend_weights(old, new).first()
    assert (r.w_vamp, r.w_ofi, r.intercept, r.best_lag) == (pytest.approx(0.2), pytest.approx(1.2), 0.5, 20)


def test_one_row_instrument_and_empty_input(spark):
    one = books_df(spark, [book(1, 1, [100.0], [1.0], [101.0], [2.0])])
    for layout in ("key", "blocked"):
        f = win.with_book_factors(one, lags=(5,), layout=layout, block_rows=32).collect()
        assert len(f) == 1 and f[0].factor_ofi_smooth is None and f[0].target_5_tick is None
        assert f[0].mid_price == 100.5
        empty = one.where("nonce < 0")
        assert win.with_book_factors(empty, lags=(5,), layout=layout, block_rows=32).count() == 0
        assert gp.detect_gaps(_trades(spark, [5]), layout=layout).count() == 0
        assert win.positional_split(one, ["symbol"], ["timestamp", "nonce"], layout=layout).first().is_train is False


def test_null_order_rows_survive_the_blocked_layout(spark):
    items = [book(i, None if i == 3 else 1000 + i, [100.0], [1.0 + i], [101.0], [2.0]) for i in range(6)]
    df = books_df(spark, items)
    a = rows(win.with_ofi(df, 2, keep_step=True, layout="key"), ["nonce", "ofi_step", "factor_ofi_smooth"])
    b = rows(win.with_ofi(df, 2, keep_step=True, layout="blocked", block_rows=4),
             ["nonce", "ofi_step", "factor_ofi_smooth"])
    assert len(b) == 6 and a == b


def test_fill_gaps_with_a_huge_gap_stays_bounded(spark):
    gaps = spark.createDataFrame([Row(exchange_id="binance", symbol="BTC/USDT", start_id=10, end_id=5_000_000_010),
                                  Row(exchange_id="binance", symbol="BTC/USDT", start_id=6_000_000_000,
                                      end_id=6_000_000_002)])
    bf = _trades(spark, [5, 11, 2_500_000_000, 5_000_000_010, 5_000_000_011, 6_000_000_001])
    rec, rep = gp.fill_gaps(gaps, bf)
    assert sorted(r.trade_id for r in rec.collect()) == [11, 2_500_000_000, 5_000_000_010, 6_000_000_001]
    r = {x.start_id: x for x in rep.collect()}
    assert r[10].n_recovered == 3 and r[6_000_000_000].n_missing == 2
