"""Pipelines end to end (PIP-1..7) and their properties."""

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL, rows
from tickweave import fixtures as fx
from tickweave.operators import gaps as gp
from tickweave.operators import joins as jn
from tickweave.operators import quality as q
from tickweave.plans import workflows as pl

DAY = "2024-01-15"
NOW = 1706745600000


def test_patch_then_audit_passes(spark):
    off, loc = fx.archive_trades(spark, SF_MID), fx.local_trades(spark, SF_MID)
    expected = jn.expected_work(off)
    before = q.audit(q.on_day(off, DAY), q.on_day(loc, DAY))
    assert before.where("passed").count() < before.count()
    out = pl.patch_day(off, loc, expected, DAY, NOW)
    assert out["audit"].where("NOT passed").count() == 0
    assert out["attributes"].count() == 0
    assert out["health"].where("integrity_score = 100").count() == out["health"].count()
    assert rows(out["coverage"].select("action").distinct()) == [("partial",)]


def test_patch_full_day_when_nothing_local(spark):
    off = fx.archive_trades(spark, SF_SMALL)
    loc = fx.local_trades(spark, SF_SMALL).where("symbol <> 'ETH/USDT'")
    out = pl.patch_day(off, loc, jn.expected_work(off), "2024-01-03", NOW)
    cov = {(r.exchange_id, r.symbol): r.action for r in out["coverage"].collect()}
    assert cov[("binance", "ETH/USDT")] == "full"
    eth = q.on_day(off, "2024-01-03").where("symbol = 'ETH/USDT'").count()
    assert out["to_insert"].where("symbol = 'ETH/USDT'").count() == eth


def test_heal_recovers_every_deleted_id(spark):
    loc, arc = fx.local_trades(spark, SF_MID), fx.archive_trades(spark, SF_MID)
    g = gp.detect_gaps(loc)
    interior = g.agg(F.sum(F.col("end_id") - F.col("start_id") + 1)).first()[0]
    out = pl.heal(loc, arc, None, NOW)
    assert out["recovered"].count() == interior
    assert gp.detect_gaps(out["merged"]).count() == 0


def test_replicate_copies_only_known_instruments(spark):
    remote, local = fx.replication_pair(spark, SF_SMALL)
    r = pl.replicate(remote, local)["trades"]
    assert r.where("symbol = 'PEPE/USDT'").count() == 0
    # the local half of each known instrument stays, the rest is copied
    known = remote.where("symbol <> 'PEPE/USDT'")
    assert r.join(local, ["exchange_id", "symbol", "trade_id"], "left_semi").count() == 0
    assert 0 < local.count() and r.count() == known.count() - local.count()


def test_train_alpha_produces_weights(spark):
    old = fx.weights(spark, SF_MID)
    out = pl.train_alpha(fx.books(spark, SF_MID).where("exchange_id = 'binance'"), old)
    w = out["weights"].collect()
    assert len(w) == 4 and all(r.best_lag in (5, 10, 20, 50, 100) for r in w)
    ev = out["evaluation"].collect()
    assert all(r.n_train > r.n_valid > 0 for r in ev)


def test_daily_pipeline_writes(spark, tmp_path):
    off, loc = fx.archive_trades(spark, SF_SMALL), fx.local_trades(spark, SF_SMALL)
    pl.daily_pipeline(off, loc, fx.books(spark, SF_SMALL), jn.expected_work(off), "2024-01-03", NOW,
                      str(tmp_path / "processed"))
    from tickweave.sources.lake import read_processed
    t = read_processed(spark, str(tmp_path / "processed"), "trades")
    assert t.count() == q.on_day(off, "2024-01-03").count()
    assert set(pl.TRADE_EXPORT_COLS) <= set(t.columns)


def test_tca_report(spark):
    per_trade, rep = pl.tca(fx.archive_trades(spark, SF_SMALL), fx.quotes(spark, SF_SMALL))
    assert per_trade.where("abs(data_lag_ms) > 100").count() == 0
    assert rep.agg(F.sum("trade_count")).first()[0] == per_trade.count()


def test_automated_days_per_exchange(spark):
    t = fx.archive_trades(spark, SF_SMALL)
    now = 1704672000000 + 3_600_000          # 2024-01-08 01:00 UTC
    got = q.on_automated_day(t, now).withColumn("d", F.to_date(F.timestamp_millis("timestamp")))
    days = {(r.exchange_id, str(r.d)) for r in got.select("exchange_id", "d").distinct().collect()}
    assert days == {("binance", "2024-01-07"), ("okx", "2024-01-06")}
    out = pl.consolidate_trades(t, now_ms=now)
    assert {str(r.date) for r in out.select("date").distinct().collect()} == {"2024-01-06", "2024-01-07"}
