"""The shared job lock: an hour of event time, over micro-batches and restarts."""

from tickweave.streaming.locks import PROVIDER, REQUEST, start_job_lock

SCHEMA = "exchange_id string, symbol string, start_id long, end_id long, job_id string, seen_ms long"
MINUTE = 60_000
BEGIN = 28_000_000  # minutes since the epoch


def run(spark, folder, asked, per_trigger=1, late="1 day"):
    df = spark.createDataFrame([("binance", "X", i, i + 1, None if i < 0 else f"job{i}", (BEGIN + m) * MINUTE) for i, m in asked], SCHEMA)
    df.repartition(2).write.mode("append").parquet(folder + "/asked")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", per_trigger).parquet(folder + "/asked").select(*REQUEST)
    start_job_lock(stream, folder + "/jobs", folder + "/ck", late=late, trigger={"availableNow": True}).awaitTermination()
    return sorted((r["start_id"], r["dispatched_ms"] // MINUTE - BEGIN) for r in spark.read.parquet(folder + "/jobs").collect())


def test_ten_and_seventy_minutes_apart(spark, tmp_path):
    d, before = str(tmp_path), spark.conf.get(PROVIDER, None)
    assert run(spark, d, [(1, 0)]) == [(1, 0)]
    assert run(spark, d, [(1, 10), (2, 10), (-1, 10)]) == [(1, 0), (2, 10)]
    # a new query each time: the state comes back from the checkpoint
    assert run(spark, d, [(1, 70), (2, 69), (1, 71)], per_trigger=9) == [(1, 0), (1, 70), (2, 10)]
    assert run(spark, d, [(2, 70), (1, 5), (3, 1)]) == [(1, 0), (1, 70), (2, 10), (2, 70), (3, 1)]
    assert spark.conf.get(PROVIDER, None) == before


def test_one_batch_in_any_order(spark, tmp_path):
    asked = [(i, m) for i in range(40) for m in (130, 0, 61, 59, 60, 119)]
    assert run(spark, str(tmp_path), asked, per_trigger=99) == sorted((i, m) for i in range(40) for m in (0, 60, 130))


def test_entries_leave_the_state(spark, tmp_path):
    d = str(tmp_path)
    run(spark, d, [(i, i) for i in range(20)], per_trigger=99, late="5 minutes")
    run(spark, d, [(90, 70)], late="5 minutes")
    run(spark, d, [(91, 71)], late="5 minutes")
    left = spark.read.format("statestore").option("stateVarName", "sent").load(d + "/ck")
    held = sorted(r[0] for r in left.select("user_map_key.job_id").collect()) if "user_map_key" in left.columns else \
        sorted(k["job_id"] for r in left.collect() for k in r["map_value"])
    assert held == sorted([f"job{i}" for i in range(7, 20)] + ["job90", "job91"])
