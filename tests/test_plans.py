"""Physical-plan properties: pushdown, pruning, shuffle counts."""

import re


from conftest import SF_SMALL
from tickweave import fixtures as fx
from tickweave.operators import quality as q
from tickweave.operators import windows as win
from tickweave.plans import catalog


def plan(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def test_flagship_uses_one_exchange(spark):
    df = catalog.QUERIES["trade_features"](spark, SF_SMALL)
    p = df._jdf.queryExecution().sparkPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 1


def test_day_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "trades")
    fx.local_trades(spark, SF_SMALL).write.parquet(path)
    df = q.on_day(spark.read.parquet(path), "2024-01-03").select("trade_id", "price")
    p = plan(df)
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp,1704240000000)" in p
    assert "LessThan(timestamp,1704326400000)" in p
    assert re.search(r"ReadSchema: struct<trade_id:bigint,price:double,timestamp:bigint>", p)


def test_instrument_and_id_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "trades2")
    fx.local_trades(spark, SF_SMALL).write.parquet(path)
    df = q.id_between(q.for_instrument(spark.read.parquet(path), "binance", "BTC/USDT"), 10, 20)
    p = plan(df)
    assert "EqualTo(exchange_id,binance)" in p and "EqualTo(symbol,BTC/USDT)" in p
    assert "GreaterThanOrEqual(trade_id,10)" in p and "LessThanOrEqual(trade_id,20)" in p


def test_blocked_layout_range_partitions(spark):
    t = fx.local_trades(spark, SF_SMALL)
    df = win.with_ma_price(t, layout="blocked", block_rows=200)
    p = df._jdf.queryExecution().toString()
    # two shuffles of the rows, nothing checkpointed or joined back to itself
    assert "_bin" in p and "_blk" in p and "ExistingRDD" not in p


def test_auto_layout_is_size_checked(spark):
    from tickweave.operators import series
    t = fx.local_trades(spark, SF_SMALL)
    assert series.layout(t) == "key"
    spark.conf.set(series.KEY_MAX_BYTES_CONF, "1")
    try:
        assert series.layout(t) == "blocked"
    finally:
        spark.conf.unset(series.KEY_MAX_BYTES_CONF)


def test_tune_partitions_scales_with_input(spark):
    from tickweave.session import tune_partitions
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        t = fx.local_trades(spark, SF_SMALL)
        assert tune_partitions(spark, t, minimum=1) == 1
        assert tune_partitions(spark, t, target_bytes=1024, minimum=1) > 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_day_filter_prunes_partitions_when_latency_is_bounded(spark, tmp_path):
    from tickweave.sources.sinks import write_table
    path = str(tmp_path / "tbl")
    write_table(fx.local_trades(spark, SF_SMALL), path, ["exchange_id", "symbol", "trade_id"], mode="overwrite")
    t = spark.read.parquet(path)
    df = q.on_day(t, "2024-01-03", max_latency_days=1)
    p = plan(df)
    assert "PartitionFilters: [isnotnull(date" in p and "2024-01-03" in p and "2024-01-04" in p
    assert df.count() == q.on_day(t, "2024-01-03").count()


def test_bucketed_local_table_shuffles_only_the_archive(spark, tmp_path):
    from tickweave.sources.sinks import write_bucketed_table
    name = "local_trades_bucketed"
    write_bucketed_table(fx.local_trades(spark, SF_SMALL), name, n_buckets=8, path=str(tmp_path / "b"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        local = spark.table(name)
        miss = q.missing_trades(fx.archive_trades(spark, SF_SMALL), local)
        lines = miss._jdf.queryExecution().sparkPlan().toString().split("\n")
        scan = next(i for i, ln in enumerate(lines) if f"default.{name}" in ln)
        assert "Bucketed: true" in lines[scan]

        def depth(ln):
            return len(ln) - len(ln.lstrip(" :+-"))

        # walk up from the bucketed scan to the anti join: no exchange on the way
        d, i, path = depth(lines[scan]), scan, []
        while i > 0 and "LeftAnti" not in lines[i]:
            i -= 1
            if depth(lines[i]) < d:
                d = depth(lines[i])
                path.append(lines[i])
        assert "LeftAnti" in lines[i] and not any("Exchange" in ln for ln in path)
        assert miss.count() == fx.trades(spark, SF_SMALL).where("is_lost").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql(f"DROP TABLE IF EXISTS {name}")
