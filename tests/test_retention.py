"""Partition drop against the row predicate, with runs killed half-way."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import rows
from tickweave.operators.quality import DAY_MS, apply_retention
from tickweave.sources import retention, sinks

DAY0 = int(dt.datetime(2024, 1, 1, tzinfo=dt.UTC).timestamp() * 1000)
NOW = DAY0 + 12 * DAY_MS + DAY_MS // 3  # the cut is a third into day 5
KEY = ("exchange_id", "trade_id")


@pytest.fixture
def table(spark, tmp_path):
    t = spark.range(2000).select(F.lit("x").alias("exchange_id"), F.col("id").alias("trade_id"),
                                 (F.lit(DAY0) + F.col("id") * 10 * DAY_MS / 2000).cast("long").alias("local_timestamp"))
    t = t.unionByName(t.where("trade_id in (1000, 1066, 1067)"))
    sinks.write_table(t, str(tmp_path / "t"), KEY)
    return t, str(tmp_path / "t")


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


def test_drops_rewrites_and_rests(spark, table):
    t, path = table
    before = files(path)
    want = rows(apply_retention(t, NOW))
    assert rows(retention.read_retained(spark, path, NOW).select(t.columns)) == want
    assert retention.expire_partitions(spark, path, NOW) == {"dropped": [f"2024-01-0{d}" for d in range(1, 6)], "rewritten": ["2024-01-06"]}
    assert rows(spark.read.parquet(path).select(t.columns)) == want
    after = files(path)
    assert {f for f in before if int(f.split("date=")[1][8:10]) > 6} == set(before) & set(after)
    assert all(before[f] == after[f] for f in set(before) & set(after))
    assert retention.expire_partitions(spark, path, NOW) == {"dropped": [], "rewritten": []}
    assert files(path) == after
    scan = retention.read_retained(spark, path, NOW)
    assert "PartitionFilters: [" in scan._jdf.queryExecution().toString() and all("date=2024-01-0" in f and int(f.split("date=")[1][8:10]) >= 6 or "date=2024-01-1" in f for f in scan.inputFiles())


def test_cut_at_midnight_and_all_gone(spark, table):
    t, path = table
    at_midnight = DAY0 + 9 * DAY_MS  # rows of day 2's first millisecond expire with it
    done = retention.expire_partitions(spark, path, at_midnight)
    assert done["dropped"] == ["2024-01-01", "2024-01-02"] and done["rewritten"] == ["2024-01-03"]
    assert rows(spark.read.parquet(path).select(t.columns)) == rows(apply_retention(t, at_midnight))
    retention.expire_partitions(spark, path, DAY0 + 60 * DAY_MS)
    assert not files(path)
    assert retention.expire_partitions(spark, path + "-none", NOW) == {"dropped": [], "rewritten": []}


@pytest.mark.parametrize("killed_at", ["before the mark", "before the swap", "inside the swap"])
def test_a_killed_run_is_finished_by_the_next(spark, table, monkeypatch, killed_at):
    t, path = table
    swap = retention._swap

    def die(fs, at, stage):
        if killed_at == "before the mark":
            fs.delete(at(stage, retention._MARK), False)
        elif killed_at == "inside the swap":
            fs.delete(at("date=2024-01-06"), True)
        raise KeyboardInterrupt

    monkeypatch.setattr(retention, "_swap", die)
    with pytest.raises(KeyboardInterrupt):
        retention.expire_partitions(spark, path, NOW)
    monkeypatch.setattr(retention, "_swap", swap)
    retention.expire_partitions(spark, path, NOW)
    assert rows(spark.read.parquet(path).select(t.columns)) == rows(apply_retention(t, NOW))
    assert not [x for x in os.listdir(path) if x.startswith(retention._STAGE)]
