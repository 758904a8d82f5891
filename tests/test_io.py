"""Sources and sinks on small files written to a fresh temporary folder."""

from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tickweave import fixtures as fx
from tickweave.sources import archive, lake, sinks
from tickweave.sources.messages import decode_messages, encode_messages
from tickweave.schemas import TRADE


def test_binance_and_okx_archives(spark, tmp_path):
    b = tmp_path / "BTCUSDT-trades.csv"
    b.write_text("11,100.5,2.0,201.0,1704067200123456,true,true\n12,100.25,1.0,100.25,1704067200999999,false,true\n")
    o = tmp_path / "BTC-USDT-trades.csv"
    o.write_text("instrument_name,trade_id,side,price,size,created_time\n"
                 "BTC-USDT,21,buy,100.0,0.5,1704067201000\nBTC-USDT,22,sell,99.5,1.5,1704067202000\n")
    bn = {r.trade_id: r for r in archive.read_binance_archive(spark, str(b), "BTC/USDT", 7).collect()}
    assert bn[11].timestamp == 1704067200123 and bn[11].side == "sell" and bn[11].is_taker_buyer is False
    assert bn[12].side == "buy" and bn[12].is_taker_buyer is True and bn[12].local_timestamp == 7
    ok = {r.trade_id: r for r in archive.read_okx_archive(spark, str(o), "BTC/USDT", 7).collect()}
    assert ok[21].amount == 0.5 and ok[21].is_taker_buyer is True and ok[22].timestamp == 1704067202000
    assert list(bn[11].asDict()) == archive.UNIFIED


def test_raw_lake_roundtrip(spark, tmp_path):
    t = fx.archive_trades(spark, SF_SMALL).where("exchange_id = 'binance' AND symbol = 'BTC/USDT'")
    root = tmp_path / "raw"
    # write one hourly file per (day, hour) in the raw layout
    pdf = t.withColumn("file_path", lake.lake_path("trades", str(root))).toPandas()
    import pyarrow as pa
    import pyarrow.parquet as pq
    import os
    for path, g in list(pdf.groupby("file_path"))[:5]:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        g = g.assign(trade_id=g["trade_id"].astype(str))
        pq.write_table(pa.Table.from_pandas(g[["trade_id", "symbol", "exchange_id", "price", "amount", "side",
                                               "is_taker_buyer", "timestamp"]], preserve_index=False), path)
    good, bad = lake.read_raw_trades(spark, str(root))
    r = good.select("exchange", "mkt_type", "pair", "trade_date", "hour").distinct().collect()
    assert {x.exchange for x in r} == {"binance"} and {x.pair for x in r} == {"BTC-USDT"}
    assert bad.count() == 0 and good.count() > 0
    assert good.schema["trade_id"].dataType.typeName() == "long"


def test_export_daily_is_rerun_safe(spark, tmp_path):
    from tickweave.plans.workflows import consolidate_books
    b = consolidate_books(fx.books(spark, SF_SMALL))
    root = str(tmp_path / "processed")
    sinks.export_daily(b, root, "orderbook")
    sinks.export_daily(b.where("date = DATE'2024-01-03'"), root, "orderbook")   # re-run one day
    back = lake.read_processed(spark, root, "orderbook")
    assert back.count() == b.count()
    hist = lake.load_history(spark, root, "binance", "spot", "BTC/USDT", days=3)
    days = hist.select(F.to_date(F.timestamp_millis("timestamp")).alias("d")).distinct().count()
    assert days == 3 and "mid_price" in hist.columns


def test_table_write_and_weights(spark, tmp_path):
    t = fx.local_trades(spark, SF_SMALL)
    sinks.append_table(t, str(tmp_path / "trades"))
    sinks.append_table(t, str(tmp_path / "trades"))          # replayed batch
    from tickweave.operators.quality import latest_by_key
    back = spark.read.parquet(str(tmp_path / "trades")).drop("date")
    assert latest_by_key(back).count() == t.count()
    w = fx.weights(spark, SF_SMALL)
    sinks.save_weights(w, str(tmp_path / "w"))
    assert rows(sinks.load_weights(spark, str(tmp_path / "w"))) == rows(w)


def test_messages_roundtrip_and_quarantine(spark):
    t = fx.local_trades(spark, SF_SMALL)
    msgs = encode_messages(t, "trades")
    broken = spark.createDataFrame([("md:x:spot:BTC-USDT:trades", "{not json"),
                                    ("md:x:spot:BTC-USDT:trades", '{"symbol": "X"}')], "stream_key string, data string")
    good, bad = decode_messages(msgs.unionByName(broken), "data", TRADE, keep=["stream_key"],
                                required=["trade_id", "symbol"])
    assert good.count() == t.count() and bad.count() == 2
    assert rows(good.drop("stream_key")) == rows(t)


def test_raw_book_lake(spark, tmp_path):
    b = fx.books(spark, SF_SMALL).where("exchange_id = 'okx' AND symbol = 'ETH/USDT'")
    root = tmp_path / "raw"
    pdf = b.withColumn("file_path", lake.lake_path("orderbook", str(root))).toPandas()
    import os
    import pyarrow as pa
    import pyarrow.parquet as pq
    for path, g in list(pdf.groupby("file_path"))[:4]:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        g = g.assign(bid_price=g["bid_prices"].str[0], bid_volume=g["bid_volumes"].str[0],
                     ask_price=g["ask_prices"].str[0], ask_volume=g["ask_volumes"].str[0])
        cols = ["nonce", "symbol", "exchange_id", "bid_volume", "bid_price", "ask_volume", "ask_price",
                "bid_prices", "bid_volumes", "ask_prices", "ask_volumes", "timestamp"]
        pq.write_table(pa.Table.from_pandas(g[cols], preserve_index=False), path)
    df = lake.read_raw_books(spark, str(root))
    r = df.select("exchange", "mkt_type", "pair", "orderbook_date", "hour", "spread").collect()
    assert {x.pair for x in r} == {"ETH-USDT"} and all(x.spread == 0.5 for x in r)
    assert all(x.hour is not None and x.orderbook_date is not None for x in r)


def test_instrument_matrix_and_metrics(spark):
    from tickweave.operators.joins import instrument_matrix
    from tickweave.operators.quality import batch_metrics
    from pyspark.sql import Observation
    m = instrument_matrix(spark, fx.EXCHANGES, ["spot"], fx.SYMBOLS)
    assert m.count() == 2 * 1 * 4 * 2 and m.distinct().count() == 16
    obs = Observation("batch")
    t = fx.local_trades(spark, SF_SMALL)
    t.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == t.count()
    named = batch_metrics(t, "b1")
    named.write.format("noop").mode("overwrite").save()


def test_many_archive_files_in_one_scan(spark, tmp_path):
    d = tmp_path / "arch"
    d.mkdir()
    (d / "BTCUSDT-trades-2024-01-01.csv").write_text("1,100.0,1.0,100.0,1704067200000000,true,true\n")
    (d / "ETHUSDT-trades-2024-01-02.csv").write_text("7,50.0,2.0,100.0,1704153600000000,false,true\n")
    (d / "BTC-USDT-trades-2024-01-01.csv").write_text(
        "instrument_name,trade_id,side,price,size,created_time\nBTC-USDT,3,sell,99.0,1.0,1704067200500\n")
    bn = archive.read_binance_archives(spark, str(d / "*USDT-trades-*.csv").replace("*USDT", "[A-Z]*USDT"),
                                       ["BTC/USDT", "ETH/USDT"], 9)
    got = {(r.symbol, r.trade_id, r.side) for r in bn.where("symbol IS NOT NULL").collect()}
    assert got == {("BTC/USDT", 1, "sell"), ("ETH/USDT", 7, "buy")}
    ok = archive.read_okx_archives(spark, str(d / "*-USDT-trades-*.csv"), 9).collect()
    assert [(r.symbol, r.trade_id, r.is_taker_buyer) for r in ok] == [("BTC/USDT", 3, False)]
