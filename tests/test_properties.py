"""Property tests: gap accounting, layout equivalence, planted signals."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickweave.operators import gaps as gp
from tickweave.operators import research as rs
from tickweave.operators import windows as win

SETTINGS = dict(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(n=st.integers(20, 400), drop=st.floats(0.0, 0.6), seed=st.integers(0, 10_000))
def test_gap_lengths_equal_deleted_interior_ids(spark, n, drop, seed):
    rnd = random.Random(seed)
    kept = [i for i in range(1, n + 1) if rnd.random() >= drop] or [1]
    lo, hi = min(kept), max(kept)
    interior_deleted = (hi - lo + 1) - len(set(kept))
    df = spark.createDataFrame([("binance", "X", i) for i in kept + kept[: len(kept) // 5]],
                               "exchange_id string, symbol string, trade_id long")
    for layout, block in (("key", None), ("blocked", rnd.choice([1, 2, 7, 64]))):
        g = gp.detect_gaps(df, layout=layout, block_rows=block)
        total = g.agg(F.sum(F.col("end_id") - F.col("start_id") + 1)).first()[0] or 0
        assert total == interior_deleted


@settings(**SETTINGS)
@given(sizes=st.lists(st.integers(1, 300), min_size=1, max_size=5), block=st.integers(30, 200),
       ranges=st.integers(1, 17), seed=st.integers(0, 10_000))
def test_blocked_windows_equal_key_windows(spark, sizes, block, ranges, seed):
    rnd = random.Random(seed)
    data = []
    for k, n in enumerate(sizes):
        ids = rnd.sample(range(1, 10 * n + 1), n)
        data += [(f"S{k}", i, float(rnd.randint(0, 640)) / 64) for i in ids]
    df = spark.createDataFrame(data, "symbol string, trade_id long, price double")
    by = ["symbol"]

    def ma(layout):
        return win.with_ma_price(df, n=25, by=by, layout=layout, block_rows=block)

    def seq(layout):
        return win.with_trade_seq(df, by=by, layout=layout)

    def top(layout):
        return win.latest_n(df, by, ["trade_id"], 13, layout=layout)

    for fn in (ma, seq, top):
        a = sorted(tuple(r) for r in fn("key").collect())
        spark.conf.set("tickweave.window.ranges", str(ranges))
        try:
            b = sorted(tuple(r) for r in fn("blocked").collect())
        finally:
            spark.conf.unset("tickweave.window.ranges")
        assert a == b


def test_evaluate_recovers_a_planted_signal(spark):
    rnd = random.Random(3)
    rows = []
    for i in range(3000):
        x1, x2 = rnd.gauss(0, 1), rnd.gauss(0, 1)
        y = 0.8 * x1 - 0.3 * x2 + 0.1 + rnd.gauss(0, 0.05)
        t = {f"target_{L}_tick": y + rnd.gauss(0, 0.5) for L in (5, 10, 50, 100)}
        rows.append(dict(exchange_id="binance", mkt_type="spot", symbol="BTC/USDT", timestamp=i, nonce=i,
                         vamp_bias_bp=x1, factor_ofi_smooth=x2, target_20_tick=y, **t))
    df = spark.createDataFrame(rows)
    r = rs.evaluate(df, target="target_20_tick").first()
    assert r.passed and r.valid_ic > 0.9 and abs(r.decay) < 0.05
    assert r.w_vamp == pytest.approx(0.8, abs=0.01) and r.w_ofi == pytest.approx(-0.3, abs=0.01)
    assert r.intercept == pytest.approx(0.1, abs=0.01)
    assert r.n_train == 2100 and r.n_valid == 900
    best = rs.best_lag(df.withColumn("vamp", F.lit(1.0)).withColumn("mid_price", F.lit(1.0)))
    assert best.where("is_best").first().lag == 20


@settings(**SETTINGS)
@given(n=st.integers(1, 300), keep=st.floats(0.0, 1.0), ratio=st.sampled_from([0.0, 0.3, 0.7, 1.0]),
       block=st.integers(1, 50), seed=st.integers(0, 10_000))
def test_subset_cutoff_equals_brute_force(spark, n, keep, ratio, block, seed):
    from tickweave.operators import series
    rnd = random.Random(seed)
    rows = [("A" if i % 3 else "B", i, rnd.random() < keep) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i long, ok boolean")
    got = {r.k: r._cut for r in series.subset_cutoff(df, ["k"], "i", F.col("ok"), ratio,
                                                     block_rows=block).collect()}
    for key in {r[0] for r in rows}:
        usable = sorted(r[1] for r in rows if r[0] == key and r[2])
        k = int(len(usable) * ratio)
        assert got.get(key) == (usable[k] if k < len(usable) else None)


@settings(**SETTINGS)
@given(n_t=st.integers(1, 60), n_q=st.integers(0, 60), span=st.integers(1, 200), ranges=st.integers(1, 9),
       seed=st.integers(0, 10_000))
def test_asof_join_equals_brute_force(spark, n_t, n_q, span, ranges, seed):
    from tickweave.operators import joins as jn
    rnd = random.Random(seed)
    syms = ["A", "B"]
    trades = [(rnd.choice(syms), rnd.randint(0, span), i) for i in range(n_t)]
    quotes = [(rnd.choice(syms), rnd.randint(0, span), j) for j in range(n_q)]
    t = spark.createDataFrame(trades, "symbol string, timestamp long, trade_id long")
    q = spark.createDataFrame(quotes, "symbol string, timestamp long, nonce long") if quotes else \
        spark.createDataFrame([], "symbol string, timestamp long, nonce long")
    want = {}
    for s, ts, i in trades:
        cands = [(qts, n) for qs, qts, n in quotes if qs == s and qts <= ts]
        best = max(cands) if cands else None
        want[i] = (best[1] if best else None, ts - best[0] if best else None)
    for layout in ("key", "blocked"):
        got = {r.trade_id: (r.ob_nonce, r.data_lag_ms) for r in
               jn.asof_join(t, q, by=["symbol"], right_cols=["nonce"], left_tie=["trade_id"],
                            layout=layout, bin_ms=ranges * 7).collect()}
        assert got == want


@settings(**SETTINGS)
@given(n=st.integers(5, 300), drop=st.floats(0.05, 0.7), have=st.floats(0.0, 1.0), bucket=st.integers(2, 40),
       seed=st.integers(0, 10_000))
def test_fill_gaps_equals_brute_force(spark, n, drop, have, bucket, seed):
    rnd = random.Random(seed)
    kept = sorted({1, n} | {i for i in range(2, n) if rnd.random() >= drop})
    backfill = sorted(i for i in range(1, n + 1) if rnd.random() < have)
    local = spark.createDataFrame([("binance", "X", i) for i in kept], "exchange_id string, symbol string, trade_id long")
    bf = spark.createDataFrame([("binance", "X", i) for i in backfill] or [("binance", "Y", 0)],
                               "exchange_id string, symbol string, trade_id long")
    gaps = gp.detect_gaps(local, layout="key")
    rec, rep = gp.fill_gaps(gaps, bf, bucket=bucket, coarse=bucket * 5)
    missing = set(range(1, n + 1)) - set(kept)
    assert sorted(r.trade_id for r in rec.collect()) == sorted(set(backfill) & missing)
    assert (rep.agg(F.sum("n_missing")).first()[0] or 0) == len(missing - set(backfill))


@settings(**SETTINGS)
@given(n=st.integers(1, 120), block=st.integers(21, 60), seed=st.integers(0, 10_000))
def test_book_factors_blocked_equals_key_on_random_books(spark, n, block, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        bp = 100 + rnd.randint(-2, 2) * 0.25
        rows.append(dict(exchange_id="binance", mkt_type="spot", symbol=rnd.choice(["X", "Y"]), nonce=i,
                         timestamp=rnd.randint(0, 50), local_timestamp=0,
                         bid_prices=[bp, bp - 0.25], bid_volumes=[float(rnd.randint(0, 5)), 1.0],
                         ask_prices=[bp + 0.5, bp + 0.75], ask_volumes=[float(rnd.randint(0, 5)), 2.0]))
    from tickweave.schemas import BOOK
    df = spark.createDataFrame(rows, BOOK)
    cols = ["symbol", "nonce", "factor_ofi_smooth", "target_5_tick", "target_20_tick"]
    a = win.with_book_factors(df, lags=(5, 20), layout="key").select(*cols).collect()
    b = win.with_book_factors(df, lags=(5, 20), layout="blocked", block_rows=block).select(*cols).collect()
    assert sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr)


@settings(**SETTINGS)
@given(n=st.integers(1, 80), span=st.integers(1, 30), block=st.integers(5, 40), width=st.integers(1, 12), seed=st.integers(0, 10_000))
def test_layouts_agree_on_duplicates(spark, n, span, block, width, seed):
    """Rows that share key and order, some of them equal in every column, keep their number
    and values on both layouts."""
    from tickweave.operators import series
    from tickweave.operators import windows as win
    rnd = random.Random(seed)
    rows = [(rnd.choice(["A", "B", None]), rnd.choice([None, rnd.randint(0, span)]), float(rnd.randint(0, 3))) for _ in range(n)]
    rows += rows[: n // 3]
    df = spark.createDataFrame(rows, "symbol string, trade_id long, price double")

    def out(layout):
        x = win.with_ma_price(df, 4, ["symbol"], ["trade_id"], layout=layout, block_rows=block, keep_index=("i", "c"))
        return sorted(map(tuple, x.collect()), key=str)

    assert out("key") == out("blocked") and len(out("key")) == len(rows)
    idx = series.dense_index(df, ["symbol"], ["trade_id"], count_col="c", bin_width=width).collect()
    for s in {r.symbol for r in idx}:
        own = [r for r in idx if r.symbol == s]
        assert sorted(r._idx for r in own) == list(range(len(own))) and {r.c for r in own} == {len(own)}
        assert [r.trade_id for r in sorted(own, key=lambda r: r._idx)] == sorted((r.trade_id for r in own), key=lambda v: (v is not None, v or 0))
