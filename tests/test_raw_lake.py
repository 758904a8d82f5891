"""Raw lake: hour files written and read again, files chosen by instrument and time."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tickweave import fixtures as fx
from tickweave.sources import lake

H = lake.HOUR_MS


def test_hour_pattern():
    assert lake.hour_pattern("trades", None, None) == "*/*/*/*.parquet"
    assert lake.hour_pattern("trades", 0, H) == "{1970/01/01/trades_19700101_00.parquet}"
    got = lake.hour_pattern("trades", 23 * H + 5, 49 * H + 1)
    assert got == "{1970/01/01/trades_19700101_23.parquet,1970/01/02/*.parquet,1970/01/03/trades_19700103_00.parquet,1970/01/03/trades_19700103_01.parquet}"


def test_bounds_choose_the_files(spark, tmp_path):
    root = str(tmp_path / "raw")
    t = fx.archive_trades(spark, SF_SMALL).where("symbol IN ('BTC/USDT', 'ETH/USDT')")
    one = t.where("exchange_id = 'binance' AND symbol = 'BTC/USDT'").orderBy("timestamp").first()
    odd = t.limit(1).withColumn("timestamp", F.lit(None).cast("long"))
    left = lake.write_raw(t.unionByName(odd), root, "trades")
    assert left.count() == 1  # has no place in the lake
    cols = ["trade_id", "symbol", "timestamp", "price"]
    whole, bad = lake.read_raw_trades(spark, root)
    assert rows(whole, cols) == rows(t, cols) and bad.count() == 0
    start = one.timestamp // H * H
    hour, _ = lake.read_raw_trades(spark, root, "binance", one.mkt_type, "BTC/USDT", start, start + H)
    assert len(hour.inputFiles()) == 1
    in_hour = t.where(f"exchange_id = 'binance' AND symbol = 'BTC/USDT' AND timestamp >= {start} AND timestamp < {start + H}")
    assert rows(hour, cols) == rows(in_hour, cols) != []
    # a bound inside an hour, over a day and more
    span, _ = lake.read_raw_trades(spark, root, start_ms=one.timestamp, end_ms=one.timestamp + 30 * H)
    assert rows(span, cols) == rows(t.where(f"timestamp >= {one.timestamp} AND timestamp < {one.timestamp + 30 * H}"), cols)
    for lo, hi in ((0, H), (H, H), (5 * H, 0)):
        none, _ = lake.read_raw_trades(spark, root, start_ms=lo, end_ms=hi)
        assert none.count() == 0 and none.columns == whole.columns
    # written again: hours are replaced, nothing is left aside
    lake.write_raw(in_hour, root, "trades")
    assert rows(lake.read_raw_trades(spark, root)[0], cols) == rows(t, cols)
    assert not [p for p in (tmp_path / "raw").iterdir() if p.name.startswith("_")]
