"""Streaming operators on file streams with availableNow triggers."""



from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tickweave import fixtures as fx
from tickweave.operators import gaps as gp
from tickweave.operators.quality import last_ids
from tickweave.sources.messages import encode_messages
from tickweave.streaming.gaps import stream_gaps
from tickweave.streaming.silence import activity_sessions
from tickweave.streaming.sync import start_sync


def _stream_of(spark, df, tmp_path, name):
    p = str(tmp_path / name)
    df.write.parquet(p)
    return spark.readStream.schema(df.schema).parquet(p)


def _run(df, tmp_path, name, mode="append"):
    out, ck = str(tmp_path / (name + "_out")), str(tmp_path / (name + "_ck"))
    q = df.writeStream.format("parquet").option("checkpointLocation", ck).outputMode(mode) \
        .trigger(availableNow=True).start(out)
    q.awaitTermination()
    return df.sparkSession.read.parquet(out)


def test_gap_watch_with_initial_state_and_dedup(spark, tmp_path):
    local = fx.local_trades(spark, SF_SMALL)
    early, late = local.where("trade_id <= 60"), local.where("trade_id > 60")
    init = last_ids(early)
    s = _stream_of(spark, late, tmp_path, "late")
    got = _run(stream_gaps(s, init), tmp_path, "g")
    want = gp.detect_gaps(local, layout="key").where("end_id >= 60")
    assert rows(got.select("exchange_id", "symbol", "start_id", "end_id")) == rows(want)


def test_gap_watch_sorts_within_batch_and_ignores_late_ids(spark, tmp_path):
    d = spark.createDataFrame([("binance", "X", i, 1000 + i) for i in (1, 5, 3, 9, 9, 2)],
                              "exchange_id string, symbol string, trade_id long, local_timestamp long")
    s = _stream_of(spark, d, tmp_path, "dup")
    got = _run(stream_gaps(s), tmp_path, "gd")
    assert sorted((r.start_id, r.end_id) for r in got.collect()) == [(4, 4), (6, 8)]


def test_stream_sync_quarantines_bad_messages(spark, tmp_path):
    t = fx.local_trades(spark, SF_SMALL)
    src = str(tmp_path / "msgs")
    encode_messages(t, "trades").write.json(src)
    spark.createDataFrame([("k", "{broken")], "stream_key string, data string").write.mode("append").json(src)
    q = start_sync(spark, src, "trades", str(tmp_path / "tbl"), str(tmp_path / "ck"),
                   quarantine_path=str(tmp_path / "bad"), trigger={"availableNow": True}, max_files_per_trigger=1,
                   metrics_path=str(tmp_path / "metrics"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "tbl")).count() == t.count()
    assert spark.read.parquet(str(tmp_path / "bad")).count() == 1
    m = spark.read.parquet(str(tmp_path / "metrics"))
    assert m.agg(F.sum("rows")).first()[0] == t.count() and m.agg(F.sum("rows_quarantined")).first()[0] == 1
    assert m.count() > 1 and m.where("write_ms IS NULL").count() == 0


def test_activity_sessions(spark, tmp_path):
    ts = [0, 10_000, 30_000, 100_000, 110_000, 500_000]   # 20 s gap stays in one session
    d = spark.createDataFrame([("binance", "X", t) for t in ts], "exchange_id string, symbol string, local_timestamp long")
    s = _stream_of(spark, d, tmp_path, "sess")
    got = _run(activity_sessions(s), tmp_path, "sess")
    # the open session at the end is still waiting for the watermark
    assert sorted(r.n_messages for r in got.collect()) == [2, 3]


def _files_by_time(spark, df, tmp_path, name, cuts):
    """Write ``df`` as one folder of files, one file per time slice, oldest first."""
    import os
    import time as _t
    p = str(tmp_path / name)
    bounds = [None, *cuts, None]
    for i in range(len(bounds) - 1):
        part = df
        if bounds[i] is not None:
            part = part.where(F.col("timestamp") >= bounds[i])
        if bounds[i + 1] is not None:
            part = part.where(F.col("timestamp") < bounds[i + 1])
        part.coalesce(1).write.mode("append").parquet(p)
        _t.sleep(0.05)
    assert len([f for f in os.listdir(p) if f.endswith(".parquet")]) == len(bounds) - 1
    return p


def test_scoring_state_across_micro_batches(spark, tmp_path):
    from tickweave.operators import windows as win
    from tickweave.streaming.scoring import score_stream
    books = fx.books(spark, SF_SMALL)
    ts = sorted(r.timestamp for r in books.select("timestamp").collect())
    path = _files_by_time(spark, books, tmp_path, "books", [ts[len(ts) // 3], ts[2 * len(ts) // 3]])
    s = spark.readStream.schema(books.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = _run(score_stream(s, fx.weights(spark, SF_SMALL)), tmp_path, "scores")
    want = win.with_book_factors(books, layout="key")
    cols = ["exchange_id", "symbol", "nonce", "factor_ofi_smooth"]
    assert rows(got.select(*cols)) == rows(want.select(*cols))


def test_gap_watch_across_micro_batches(spark, tmp_path):
    local = fx.local_trades(spark, SF_SMALL)
    ts = sorted(r.timestamp for r in local.select("timestamp").collect())
    path = _files_by_time(spark, local, tmp_path, "trades", [ts[len(ts) // 2]])
    s = spark.readStream.schema(local.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = _run(stream_gaps(s), tmp_path, "gaps2")
    want = gp.detect_gaps(local, layout="key")
    assert rows(got.select("exchange_id", "symbol", "start_id", "end_id")) == rows(want)


def test_new_streams_are_picked_up_after_restart(spark, tmp_path):
    t = fx.local_trades(spark, SF_SMALL)
    src = str(tmp_path / "msgs")
    encode_messages(t.where("symbol = 'BTC/USDT'"), "trades").write.json(src)
    table, ck = str(tmp_path / "tbl"), str(tmp_path / "ck")
    start_sync(spark, src, "trades", table, ck, trigger={"availableNow": True}).awaitTermination()
    first = spark.read.parquet(table).count()
    # a new instrument's stream appears; the same query (same checkpoint) picks it up
    encode_messages(t.where("symbol = 'ETH/USDT'"), "trades").write.mode("append").json(src)
    start_sync(spark, src, "trades", table, ck, trigger={"availableNow": True}).awaitTermination()
    back = spark.read.parquet(table)
    assert first == t.where("symbol = 'BTC/USDT'").count()
    assert back.count() == t.where("symbol IN ('BTC/USDT', 'ETH/USDT')").count()   # nothing read twice


def test_registered_streams_run_in_bounded_ordered_micro_batches(spark, duck, tmp_path, monkeypatch):
    from tickweave.plans import catalog
    monkeypatch.setattr(catalog, "EVENTS_PER_TRIGGER", 130)
    seen = []
    for by in (catalog.BY_TRADE, catalog.BY_ARRIVAL, catalog.BY_BOOK):
        s = catalog._events_stream(spark, SF_SMALL, *by).withColumn("_by", F.struct(*[F.expr(e).alias(f"k{i}") for i, e in enumerate(by)]))
        batches = []
        s.writeStream.foreachBatch(lambda df, _: batches.append(df.agg(F.count("*"), F.min("_by"), F.max("_by")).first())) \
            .option("checkpointLocation", str(tmp_path / f"ck{len(seen)}")).trigger(availableNow=True).start().awaitTermination()
        batches = [b for b in batches if b[0]]
        assert len(batches) > 4 and max(b[0] for b in batches) <= 130
        assert sum(b[0] for b in batches) == fx.events(spark, SF_SMALL).count()
        assert all(tuple(a[2]) < tuple(b[1]) for a, b in zip(batches, batches[1:]))
        seen.append(len(batches))
    for name in ("stream_gaps", "stream_scores", "silence_alarms"):
        cur = duck.execute(catalog.ORACLE[name])
        names = [c[0] for c in cur.description]
        got = catalog.QUERIES[name](spark, SF_SMALL).select(*names)
        assert len(rows(got)) == len(want := cur.fetchall()), name
        keys = [c for c in names if c not in ("mid_price", "vamp_bias_bp", "factor_ofi_smooth", "combined_alpha")]
        at = [names.index(c) for c in keys]
        assert rows(got, keys) == sorted((tuple(r[i] for i in at) for r in want), key=repr), name


def test_registered_streams_keep_a_state_store_a_core(spark, monkeypatch):
    import glob

    from tickweave.plans import catalog
    before = spark.conf.get("spark.sql.shuffle.partitions")
    made = []
    monkeypatch.setattr("tickweave.session.scratch_dir", lambda s, name, f=__import__("tickweave.session").session.scratch_dir: made.append(f(s, name)) or made[-1])
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        for name in ("stream_gaps", "silence_alarms", "activity_sessions"):
            catalog.QUERIES[name](spark, SF_SMALL)
            assert spark.conf.get("spark.sql.shuffle.partitions") == "40"
            stores = glob.glob(made[-1].removeprefix("file:") + "/_checkpoint/state/0/[0-9]*")
            assert len(stores) == spark.sparkContext.defaultParallelism < 40, name
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_static_sides_of_registered_streams_are_worked_out_once(spark, monkeypatch):
    from tickweave.plans import catalog
    from tickweave.streaming import gaps, scoring
    sides = []

    def spy(fn):
        def run(stream, *side, **more):
            sides.extend([*side, *more.values()])
            return fn(stream, *side, **more)
        return run

    monkeypatch.setattr(scoring, "score_stream", spy(scoring.score_stream))
    monkeypatch.setattr(gaps, "stream_gaps", spy(gaps.stream_gaps))
    for name in ("stream_scores", "stream_gap_jobs"):
        assert catalog.QUERIES[name](spark, SF_SMALL).count() > 0
    assert len(sides) == 2
    for side in sides:
        assert side.count() > 0 and not any("events.parquet" in f for f in side.inputFiles())


def test_jobs_dispatched_within_the_hour_are_left_out(spark, tmp_path):
    from tickweave.functions import keys as fk
    d = spark.createDataFrame([("binance", "X", i, 10_000_000) for i in (1, 3, 5, 7, 9)],
                              "exchange_id string, symbol string, trade_id long, local_timestamp long")
    job = spark.range(2, 9, 2).select(F.lit("binance").alias("exchange_id"), F.lit("X").alias("symbol"), F.col("id").alias("start_id"),
                                      F.col("id").alias("end_id")).withColumn("job_id", fk.gap_job_id())
    ids = {r.start_id: r.job_id for r in job.collect()}
    active = spark.createDataFrame([(ids[2], 9_000_000), (ids[2], 1_000), (ids[4], 10_000_000 - gaps_ttl()), (ids[6], None), (None, 10_000_000),
                                    (ids[8], None), (ids[8], 10_000_001)], "job_id string, dispatched_ms long")
    got = _run(stream_gaps(_stream_of(spark, d, tmp_path, "held"), active=active), tmp_path, "held")
    assert sorted(r.start_id for r in got.collect()) == [4, 6]


def gaps_ttl():
    from tickweave.streaming.gaps import TTL_MS
    return TTL_MS
